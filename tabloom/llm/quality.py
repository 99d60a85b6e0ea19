"""Quality rules whose cutoffs limit the false rejection of good documents, per stratum.

Each rule rejects a document whose measure exceeds a cutoff. For every stratum (the language) and rule, the
cutoff is chosen on labelled holdout documents: a cutoff is admissible if an exact binomial test shows, at
a corrected level, that it rejects less than the allowed share of good documents. Among the admissible ones
the one that rejects most bad documents is taken, and of several such the most lenient.

* Guarantee: with probability 1 - ``confidence_loss`` no stratum loses more than the share ``risk`` of its good
  documents to these rules. ``risk`` is divided among the rules (union bound). Within a stratum and rule
  the cutoffs are tested from lenient to strict (fixed sequence, no further correction); across strata and
  rules the level is divided by their number (Bonferroni).
* Exact copies of a text are not independent, so each distinct text counts once in the holdout.
* A stratum with too few labels gets no cutoff: nothing can be guaranteed, so nothing is rejected.

Defined cases: a null text counts as empty; a null stratum is a stratum of its own; several labels for a
document count as good if any is good; repeated rows are judged alike; an empty table gives an empty
result, an empty label table no cutoffs; columns named like a count or ``kept`` are replaced. Helper columns carry the prefix ``_q_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize

# White space, symbols, window length and limits of the base rules.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Cutoffs from lenient to strict, the same for all rules, which are shares or counts per word.
CUTOFFS = [4.0 * 0.8**step for step in range(28)]
RISK = 0.02
CONFIDENCE_LOSS = 0.05


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use)[0]


def _covered(hashes: Column) -> Column:
    """Number of words in windows whose hash occurs twice or more; ``hashes`` is in text order."""
    sorted_pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(pairs: Column) -> Column:
        same = lambda x, i, d: x["h"].eqNullSafe(F.get(pairs, i + d)["h"])
        twice = F.filter(pairs, lambda x, i: same(x, i, 1) | same(x, i, -1))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def length(at: Column) -> Column:
        spans = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(spans, F.lit(0), lambda total, x: total + x)

    return _bound(_bound(sorted_pairs, starts), length)


def _word_counts(words: Column) -> Column:
    n = F.size(words)
    windows = F.transform(
        F.slice(words, 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + d) for d in range(1, WINDOW)]),
    )
    repeated = _bound(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(0)
    )
    return F.struct(n.cast("long").alias("n_words"), repeated.cast("long").alias("n_repeat_words"))


def _line_counts(lines: Column) -> Column:
    n = F.size(lines)
    return F.struct(n.alias("n_lines"), (n - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts, ``base_failed`` and the measures of the rules (``_q_`` columns)."""
    body = F.coalesce(F.col(text), F.lit(""))
    count = lambda chars: (F.length(body) - F.length(F.translate(body, chars, ""))).cast("long")
    plain = F.translate(body, WHITE, " " * len(WHITE))
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    counted = df.withColumns(
        {
            "_q_words": _bound(words, _word_counts),
            "_q_lines": _bound(lines, _line_counts),
            "word_chars": F.length(F.translate(plain, " ", "")).cast("long"),
            "n_symbols": count(SYMBOLS),
            "_q_capitals": count(CAPITALS),
            "_q_hash": F.xxhash64(body),
        }
    )
    flat = counted.withColumns(
        {
            "n_words": F.col("_q_words.n_words"),
            "n_repeat_words": F.col("_q_words.n_repeat_words"),
            "n_dup_lines": F.col("_q_lines.n_dup_lines"),
        }
    )
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return flat.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
            "_q_measures": F.array(
                share("n_symbols", "n_words"),
                share("_q_capitals", "word_chars"),
                share("n_dup_lines", "_q_lines.n_lines"),
                share("n_repeat_words", "n_words"),
            ),
        }
    ).drop("_q_words", "_q_lines", "_q_capitals")


#: Names of the entries of ``_q_measures``.
RULES = ("symbols_per_word", "capitals_share", "repeated_lines_share", "repeated_words_share")


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """Natural logarithm of P(X <= k) for X ~ Binomial(n, p), summed exactly, term by term, in logarithms."""
    odds = p / (1 - p)
    first = n * math.log1p(-p)

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i * odds)
        high, low = F.greatest(term, acc["total"]), F.least(term, acc["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    start = F.struct(first.alias("term"), first.alias("total"))
    return F.aggregate(steps, start, add, lambda acc: acc["total"])


def thresholds(
    measured: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    stratum: str = "lang",
    quality: str = "quality",
    risk: float = RISK,
    confidence_loss: float = CONFIDENCE_LOSS,
) -> DataFrame:
    """One row per stratum with the array ``_q_cutoffs`` in the order of ``RULES``; null: no cutoff.

    The labels are counted over all labelled documents; what follows is a few rows per stratum.
    """
    good = labels.groupBy(F.col(key)).agg(F.max(quality).alias("_q_good"))
    holdout = (
        measured.select(key, F.col(stratum).alias("_q_stratum"), "_q_hash", "_q_measures")
        .join(good.where("_q_good is not null"), key)
        .groupBy("_q_stratum", "_q_hash")
        .agg(F.max("_q_good").alias("_q_good"), F.first("_q_measures").alias("_q_measures"))
    )
    cutoffs = F.array(*[F.lit(c) for c in CUTOFFS])
    exceeded = holdout.select(
        "_q_stratum",
        "_q_good",
        F.posexplode("_q_measures").alias("rule", "value"),
    ).withColumn("level", F.size(F.filter(cutoffs, lambda c: F.col("value") > c)))
    per_level = materialize(exceeded.groupBy("_q_stratum", "_q_good", "rule", "level").count())
    strata = max(1, per_level.select("_q_stratum").distinct().count())

    # A document at level v exceeds the last v cutoffs, those at the strict end.
    each = per_level.select(
        "_q_stratum", "_q_good", "rule", "count",
        F.posexplode(F.transform(cutoffs, lambda c, j: j >= len(CUTOFFS) - F.col("level"))).alias("at", "over"),
    )
    counts = each.groupBy("_q_stratum", "rule", "at").agg(
        F.coalesce(F.sum(F.when(F.col("_q_good") == 1, F.col("count"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when((F.col("_q_good") == 1) & F.col("over"), F.col("count"))), F.lit(0)).alias("k"),
        F.coalesce(F.sum(F.when((F.col("_q_good") != 1) & F.col("over"), F.col("count"))), F.lit(0)).alias("bad"),
    )
    allowed = risk / len(RULES)
    level = math.log(confidence_loss / (len(RULES) * strata))
    # From k = n * allowed on the probability is above a half, so the sum need not be formed.
    admissible = F.when(
        F.col("k") < F.col("n") * allowed, log_binomial_cdf(F.col("k"), F.col("n"), allowed) <= level
    ).otherwise(False)
    best = (
        counts.where(admissible)
        .groupBy("_q_stratum", "rule")
        .agg(F.min_by("at", F.struct(-F.col("bad"), F.col("at"))).alias("at"))
    )
    chosen = best.groupBy("_q_stratum").agg(
        F.array(
            *[F.max(F.when(F.col("rule") == r, F.element_at(cutoffs, F.col("at") + 1))) for r in range(len(RULES))]
        ).alias("_q_cutoffs")
    )
    return materialize(chosen)


def judge(measured: DataFrame, chosen: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``kept``: no base rule failed and no measure exceeds its stratum's cutoff.

    ``chosen`` is a stored table, so Spark knows its size and broadcasts it only if it is small.
    """
    over = F.exists(
        F.zip_with("_q_measures", "_q_cutoffs", lambda value, cutoff: F.coalesce(value > cutoff, F.lit(False))),
        lambda x: x,
    )
    joined = measured.join(chosen, measured[stratum].eqNullSafe(chosen["_q_stratum"]), "left")
    verdict = ~F.col("base_failed") & ~F.coalesce(over, F.lit(False))
    return joined.withColumn("kept", verdict).drop("_q_stratum", "_q_cutoffs", "_q_hash")


def assess(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """All columns of ``df`` with the counts, the rules' values in ``measures``, and ``kept``."""
    measured = materialize(measure(df, text))
    judged = judge(measured, thresholds(measured, labels, key, stratum), stratum)
    return judged.withColumnRenamed("_q_measures", "measures")

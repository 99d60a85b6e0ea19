"""Line dedup by a log-template tree: recurring templates are dropped from documents.

A line is parsed to a leaf of a tree of fixed depth by its number of tokens and its leading tokens. Tokens with a
digit are variable fields from the start. Within a leaf, a token that occurs often enough at its position is a
constant of a template, any other a variable field. A template with enough constants that occurs in enough
different texts is recurring, and its lines are dropped.

* Documents count by distinct texts, so exact copies of a document make no template. A document that would lose
  more than half of its characters is left whole: it is a copy of others rather than a carrier of
  boilerplate, and is for document dedup to judge.
* The text is scanned for hashes first. Only leaves that enough texts share are generalised, and only their
  lines are read as tokens. A line on a third of all documents is one row per task before the shuffle.

Defined cases: a null text stays null and has no lines; lines of fewer than ``min_tokens`` tokens and blank lines
are always kept; repeated rows are treated alike; an empty table gives an empty result; columns named
``n_lines`` or ``n_dropped`` are replaced; helper columns carry the prefix ``_t_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize

LEADING = 3
MIN_TOKENS = 3
MIN_TEXTS = 5
#: Least share of constant tokens in a template.
CONSTANT = 0.7
#: A document that would lose a greater share of its characters is left whole.
MOST_DROPPED = 0.5
FIELD = "<*>"
BLANK = " \t\x0b\x0c\r"


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def _masked(part: Column) -> Column:
    """``part`` with every token that has a digit as a variable field."""
    return F.when(part.rlike("[0-9]"), F.regexp_replace(part, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(part)


def _tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _solid(masked: Column, constant: float) -> Column:
    """Whether enough tokens of a masked line are constants."""
    fields = (F.length(masked) - F.length(F.replace(masked, F.lit(FIELD), F.lit("")))) / len(FIELD)
    return _tokens(masked) - fields >= constant * _tokens(masked)


def _leaf(line: Column) -> Column:
    return F.xxhash64(_tokens(line), _masked(F.substring_index(line, " ", LEADING)))


def _text_key(text: str) -> Column:
    return F.xxhash64(text)


def _lines(df: DataFrame, text: str, min_tokens: int) -> DataFrame:
    """Every text's distinct lines of ``min_tokens`` tokens or more, stripped."""
    stripped = F.transform(F.split(F.col(text), "\n"), _stripped)
    each = df.where(F.col(text).isNotNull()).select(
        _text_key(text).alias("_t_text"), F.explode(F.array_distinct(stripped)).alias("_t_line")
    )
    return each.where(_tokens(F.col("_t_line")) >= min_tokens)


def recurring_lines(
    df: DataFrame,
    text: str = "text",
    min_tokens: int = MIN_TOKENS,
    min_texts: int = MIN_TEXTS,
    constant: float = CONSTANT,
) -> tuple[DataFrame, DataFrame]:
    """Stored tables: (text, leaf, line) hashes of all lines, and the hashes of the recurring ones."""
    lines = _lines(df, text, min_tokens)
    hashed = materialize(
        lines.select(
            "_t_text", _leaf(F.col("_t_line")).alias("_t_leaf"), F.xxhash64(_masked(F.col("_t_line"))).alias("_t_hash"),
            _solid(_masked(F.col("_t_line")), constant).alias("_t_solid"),
        ).distinct()
    )
    counts = hashed.groupBy("_t_leaf", "_t_hash", "_t_solid").agg(F.count(F.lit(1)).alias("texts"))
    per_leaf = counts.groupBy("_t_leaf").agg(
        F.sum("texts").alias("texts"),
        F.sum(F.when(F.col("texts") < min_texts, F.col("texts"))).alias("rare"),
    )
    # Leaves in which several rare lines may share a template.
    live = materialize(per_leaf.where((F.col("texts") >= min_texts) & F.col("rare").isNotNull()).select("_t_leaf"))
    # Lines that are alike only as they are nearly all variable fields are no template.
    often = counts.where((F.col("texts") >= min_texts) & F.col("_t_solid")).select("_t_hash")

    # Distinct masked lines of those leaves, with their number of texts.
    parsed = (
        lines.withColumn("_t_leaf", _leaf(F.col("_t_line")))
        .join(live, "_t_leaf", "left_semi")
        .select("_t_leaf", _masked(F.col("_t_line")).alias("_t_line"), "_t_text")
        .groupBy("_t_leaf", "_t_line", "_t_text").agg(F.lit(1).alias("one"))
        .groupBy("_t_leaf", "_t_line").agg(F.count(F.lit(1)).alias("texts"))
    )
    parsed = materialize(parsed)
    placed = parsed.select(
        "_t_leaf", F.xxhash64("_t_line").alias("_t_hash"), "texts",
        F.posexplode(F.split("_t_line", " ")).alias("at", "token"),
    )
    at = ["_t_leaf", "at", "token"]
    constants = placed.groupBy(*at).agg(F.sum("texts").alias("n")).where(F.col("n") >= min_texts).drop("n")
    constants = constants.where(F.col("token") != FIELD).withColumn("constant", F.lit(1))
    template = (
        placed.join(materialize(constants), at, "left")
        .groupBy("_t_leaf", "_t_hash", "texts")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("constant") == 1, F.struct("at", "token")))).alias("pattern"),
            F.count(F.lit(1)).alias("tokens"),
        )
        .where(F.size("pattern") >= constant * F.col("tokens"))
        .withColumn("pattern", F.xxhash64("pattern"))
    )
    template = materialize(template)
    shared = template.groupBy("_t_leaf", "pattern").agg(F.sum("texts").alias("n")).where(F.col("n") >= min_texts)
    generalised = template.join(shared.drop("n"), ["_t_leaf", "pattern"]).select("_t_hash")
    return hashed, materialize(often.unionByName(generalised).distinct())


def drop_templates(df: DataFrame, text: str = "text", most_dropped: float = MOST_DROPPED, **options) -> DataFrame:
    """``df`` without the lines of recurring templates, with ``n_lines`` and ``n_dropped``."""
    hashed, recurring = recurring_lines(df, text, **options)
    min_tokens = options.get("min_tokens", MIN_TOKENS)
    drops = (
        hashed.join(recurring, "_t_hash").groupBy("_t_text").agg(F.collect_set("_t_hash").alias("_t_drops"))
    )
    # Sorted on both sides at any size, so that the work grows evenly; a frequent text is split as skewed.
    joined = df.withColumn("_t_text", _text_key(text)).join(materialize(drops).hint("merge"), "_t_text", "left")

    def dropped(line: Column) -> Column:
        bare = _stripped(line)
        return (_tokens(bare) >= min_tokens) & F.array_contains("_t_drops", F.xxhash64(_masked(bare)))

    lines = F.split(F.col(text), "\n")
    kept = F.when(F.col("_t_drops").isNull(), lines).otherwise(F.filter(lines, lambda line: ~dropped(line)))
    cut = joined.withColumns({"_t_kept": kept, "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long")})
    cut = cut.withColumn("_t_cut", F.array_join("_t_kept", "\n"))
    whole = F.length("_t_cut") < (1 - most_dropped) * F.length(text)
    return cut.withColumns(
        {
            "n_dropped": F.when(whole | F.col(text).isNull(), 0).otherwise(F.col("n_lines") - F.size("_t_kept")).cast("long"),
            text: F.when(whole, F.col(text)).otherwise(F.col("_t_cut")),
        }
    ).drop("_t_text", "_t_drops", "_t_kept", "_t_cut")

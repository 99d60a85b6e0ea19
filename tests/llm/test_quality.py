import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tabloom.llm import quality
from tabloom.llm.queries import op6_risk_controlled_rules

from .common import CHECKED, ODD, documents, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered |= set(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_of_the_query_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "text").collect()}
    for row in op6_risk_controlled_rules(spark, CHECKED).collect():
        assert tuple(row[c] for c in BASE) == brute(texts[row.doc_id])
        assert not (row.base_failed and row.kept)


def test_odd_and_repeating_texts(spark):
    line = "one two three four five six seven"
    repeats = ["\n".join([line] * 3), "a b c d e f a b c d e g a b c d e", "x " * 40, "a b c d e a b c d e"]
    docs = documents(spark, [*ODD, *enumerate(repeats, 100)])
    for row in quality.measure(docs).collect():
        assert tuple(row[c] for c in BASE) == brute(row.text)
        assert row["count"] == "theirs"
    assert quality.measure(docs.limit(0)).count() == 0


def test_binomial_bound_is_exact(spark):
    for k, n, p in [(0, 10, 0.1), (3, 40, 0.2), (25, 900, 0.05), (0, 100_000, 0.01), (120, 20_000, 0.01)]:
        log_term = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)  # noqa: B023, E731
        terms = [log_term(i) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        top = max(terms)
        expected = top + math.log(sum(math.exp(t - top) for t in terms))
        cdf = quality.log_binomial_cdf(F.col("k"), F.col("n"), p)
        found = spark.createDataFrame([(k, n)], "k long, n long").select(cdf.alias("x")).first().x
        assert math.isclose(found, expected, rel_tol=1e-9)


def test_cutoffs_reject_junk_and_keep_the_good_of_each_stratum(spark):
    rows, labels = [], []
    for i in range(6000):
        junk = i % 4 == 0
        words = prose(i, 20).split()
        rows.append((i, " ".join(w + "%%%" for w in words) if junk else " ".join(words), ("en", None)[i % 2]))
        labels.append((i, int(not junk), "x"))
    docs = documents(spark, rows)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, lang string")
    found = quality.assess(docs, labelled, "doc_id").collect()
    assert all(row.kept == (row.doc_id % 4 != 0) for row in found if row.lang == "en")
    # The junk is all in one stratum; the other has no bad documents and loses no good one.
    assert all(row.kept for row in found if row.lang is None)


def test_too_few_labels_reject_nothing(spark):
    docs = documents(spark, [(i, " ".join(["a%%", *prose(i, 30).split()])) for i in range(50)])
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    assert quality.assess(docs, labels).where("kept").count() == 50
    assert quality.assess(docs, labels.limit(0)).where("kept").count() == 50

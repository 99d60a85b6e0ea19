import random
import re
from collections import Counter

import pytest

from tabloom.llm import divergence
from tabloom.llm.queries import OP12_SQL, op12_source_divergence
from tests.conftest import CHECKED
from tools.check_queries import compare, duckdb_on

from .common import ODD, documents, prose

CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least, top):
    """Every source against every other over all kept terms; rows of (text, lang, source)."""
    found = [
        (re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(CAPITALS)), lang or "", source or "")
        for text, lang, source in rows
    ]
    result = set()
    for lang in {x[1] for x in found}:
        own = [x for x in found if x[1] == lang]
        documents_of = Counter(term for words, _, _ in own for term in set(words))
        kept = sorted(term for term, n in documents_of.items() if n >= least)
        counts = {s: Counter() for _, _, s in own}
        for words, _, s in own:
            counts[s].update(w for w in words if documents_of[w] >= least)
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        shares, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            others = [(-sum(abs(p[t] - shares[o][t]) for t in kept), o) for o in shares if o != s]
            result |= {(lang, s, "pair", o, -f, i) for i, (f, o) in enumerate(sorted(others, key=lambda x: (x[0], x[1].encode())), 1)}
            more = sorted((q[t] - p[t], t.encode()) for t in kept if counts[s][t] and p[t] > q[t])[:top]
            result |= {(lang, s, "term", t.decode(), -f, i) for i, (f, t) in enumerate(more, 1)}
    return result


def rows_of(found):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_sql(spark):
    problem, rows = compare(spark, duckdb_on(CHECKED), CHECKED, "op12", op12_source_divergence, OP12_SQL)
    assert problem is None and rows > 5000


@pytest.mark.parametrize("sizes", [{}, {"slice_terms": 60, "block_sources": 3, "block_sums": 100}])
def test_slices_and_blocks_give_all_pairs(spark, sizes):
    draw = random.Random(4)
    rows = [(i, prose(i, draw.randint(0, 40)), draw.choice("ab"), f"s{draw.randint(0, 7)}") for i in range(300)]
    rows += [(400 + i, f"É Été {'x' * i}", "c", f"s{i}") for i in range(4)]
    want = brute([row[1:] for row in rows], 6, 10)
    got = rows_of(divergence.audit(documents(spark, rows), min_documents=6, top_terms=10, **sizes))
    assert got == want and {part for _, _, part, _, _, _ in got} == {"pair", "term"}


def test_odd_rows(spark):
    rows = [(i, text, lang, source) for i, (_, text) in enumerate(ODD) for lang in (None, "x\x00y") for source in (None, "s", "漢")]
    rows += [(0, None, "empty", source) for source in ("b", "a")] + [(1, "tie Tie É é É word", "ties", s) for s in "ab" * 2]
    df = documents(spark, rows).withColumn("terms", divergence.F.lit("theirs"))
    for least in (1, 3):
        assert rows_of(divergence.audit(df, min_documents=least)) == brute([row[1:] for row in rows], least, 50)
    assert divergence.audit(df.limit(0)).count() == 0


def test_document_vectors_equal_those_of_the_count_vectorizer(spark):
    from pyspark.ml.feature import CountVectorizer

    rows = [(i, prose(i, 30) + " Ÿ ÿ", "en", "s") for i in range(40)] + [(50, "", "en", "s")]
    docs = documents(spark, rows).select("lang", "source", "text")
    split = docs.select("text", divergence.F.expr("filter(split(lower(text), '[^a-zÿŸ]+'), x -> x <> '')").alias("words"))
    model = CountVectorizer(inputCol="words", outputCol="v", minDF=6.0, vocabSize=2**31 - 1).fit(
        split.selectExpr("transform(words, x -> replace(x, 'Ÿ', 'ÿ')) AS words").select("words")
    )
    kept = {row.term for row in divergence.vocabulary(docs, 6).collect()}
    assert {term.replace("Ÿ", "ÿ") for term in kept} == set(model.vocabulary)
    words = sorted("en" + divergence.MARK + term for term in kept)
    for text, row in zip([text for _, text, _, _ in rows], divergence.document_vectors(docs.coalesce(1), words).collect()):
        counts = Counter("en" + divergence.MARK + t for t in re.findall("[a-zÿŸ]+", text.translate(CAPITALS)))
        assert {words[i]: n for i, n in zip(row.indices, row.counts)} == {t: n for t, n in counts.items() if t in words}


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, size = 4 * 10**17 + 1, 9 * 10**17, 10**9
    row = spark.range(1).selectExpr(f"{n}L AS n", f"{total}L AS total", f"{size}L AS size")
    found = row.select(divergence.shares("n", "total", "size")).first()[0]
    assert found == 1 + 10**9 * (n + 5) // (total + 5 * size)


def test_a_very_long_text(spark):
    text = " ".join(["wort", "Word"] * 400_000)
    rows = [(1, text, "en", "a"), (2, "word only", "en", "b")]
    assert rows_of(divergence.audit(documents(spark, rows), min_documents=1)) == brute([r[1:] for r in rows], 1, 50)

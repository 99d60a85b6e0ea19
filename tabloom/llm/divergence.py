"""Divergence of sources: term shares of every source against the other sources of its language and the language.

The vocabulary is that of a ``CountVectorizer`` with a least document frequency and the greatest size there is, for
each language by itself: its terms carry their language. Every document gets its exact sparse count vector over it.
(Both steps work on whole Arrow columns of terms. MLlib's class gives the same, but its fit holds all terms on the
driver, and fit and transform took 667 of the 1018 CPU seconds a GB that the query came to with it.) The vectors'
entries are summed by group (language and source) within each task and then across tasks, as a summariser would, but
never as dense vectors. Sums become integer shares in parts of ``UNIT``, smoothed by ``SMOOTHING``, in exact decimal
arithmetic. The absolute differences of all pairs of sources are then added up over the sparse sums: a term that
neither source has differs by the same amount everywhere, so only terms that one of them has are looked at, in
blocks of terms and sources.

Bounds: a vocabulary is held by the driver and sent to every task. Kept terms are dealt by their hash into slices of
about ``SLICE_TERMS``, worked on one after the other; their number follows from the number of kept terms. Everything
else about terms stays in tables. Texts are worked on in portions of ``PORTION_BYTES``, at least one text. A pair
block holds at most ``BLOCK_SOURCES`` sources on either side and about ``BLOCK_SUMS`` sums. Per language, sources x
sources rows are returned, as the result asks for every pair.

Defined cases: null text, language and source count as ''; a text without terms (or none that is kept) still makes
its group occur; groups of a language without kept terms differ by 0 from each other and have no terms of
their own; a single source has no pairs; equal values are ranked by their item's bytes; repeated rows count as
often as they occur; texts may have any length, their terms are read at once; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize

MIN_DOCUMENTS = 30
UNIT = 1_000_000_000
SMOOTHING = 5
TOP_TERMS = 50
MOST_TERMS = 2**31 - 1
SLICE_TERMS = 2_000_000
BLOCK_SOURCES = 256
BLOCK_SUMS = 200_000
PORTION_BYTES = 4_000_000
TASK_SUMS = 1_000_000
#: Bytes of terms as they are counted: A-Z in lower case, other ASCII characters a blank.
TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: Between language and term; no term has it.
MARK = "\x00"


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts, one after the other, and how many each has. The bytes of UTF-8 tell terms apart."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    plain = bytes(memoryview(data)[ends[0] : ends[-1]]).translate(TABLE) if data else b""
    cleaned = pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(plain))
    trimmed = pc.ascii_trim_whitespace(cleaned)
    found = pc.ascii_split_whitespace(trimmed)
    # A text without terms is split to one that is empty.
    counts = pc.list_value_length(found).to_numpy() * (pc.binary_length(trimmed).to_numpy() > 0)
    flat = pc.list_flatten(found)
    return flat.filter(pc.greater(pc.binary_length(flat), 0)), counts


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Language and rows of slices of ``batch`` that have about ``PORTION_BYTES`` bytes of text, one row at least."""
    total = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + PORTION_BYTES, side="right")))
        part = batch.slice(start, end - start)
        for lang in part.column("lang").unique().to_pylist():
            yield lang, part.filter(pc.equal(part.column("lang"), lang))
        start = end


def _plain(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in columns.items()])


def vocabulary(docs: DataFrame, min_documents: int) -> DataFrame:
    """Stored (lang, term, n): the terms in ``min_documents`` or more of a language's documents (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, part in _portions(batch):
                flat, counts = _terms(part.column("text"))
                coded = flat.dictionary_encode()
                size = len(coded.dictionary)
                owner = np.repeat(np.arange(part.num_rows), counts)
                once = np.unique(owner * max(size, 1) + coded.indices.to_numpy())
                n = np.bincount(once % max(size, 1), minlength=size)[:size]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), coded.dictionary, pa.array(n)], ["lang", "term", "n"]
                )

    partial = docs.select("lang", "text").mapInArrow(run, "lang string, term string, n long")
    return materialize(partial.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_documents))


def _vectors(lang: str, texts: pa.Array, index: pd.Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse count vectors of texts of one language: text, place in ``index`` and count of every entry, in order."""
    flat, counts = _terms(texts)
    coded = flat.dictionary_encode()
    place = index.get_indexer([lang + MARK + term for term in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
    owner = np.repeat(np.arange(len(texts)), counts)
    keys, n = np.unique((owner << 31 | place)[place >= 0], return_counts=True)
    return keys >> 31, keys & MOST_TERMS, n


def document_vectors(docs: DataFrame, words: list[str]) -> DataFrame:
    """(lang, source, indices, counts) of every document (lang, source, text): its vector over ``words``.

    Words are language, ``MARK`` and term; a document's vector has the words of its language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pd.Index(words, dtype=object)
        for batch in batches:
            for lang, part in _portions(batch):
                text, place, n = _vectors(lang, part.column("text"), index)
                starts = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(starts, pa.array(x)) for x in (place, n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("source"), *lists], ["lang", "source", "indices", "counts"]
                )

    return docs.mapInArrow(run, "lang string, source string, indices array<long>, counts array<long>")


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def vector_sums(docs: DataFrame, words: list[str]) -> DataFrame:
    """(lang, source, i, n): the entries of the documents' vectors over ``words``, summed by group."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pd.Index(shared.value, dtype=object)
        groups: dict[tuple[str, str], int] = {}
        keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def rows() -> pa.RecordBatch:
            group = pa.array(keys >> 31)
            names = [pa.array([name[i] for name in groups], pa.string()).take(group) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(
                [*names, pa.array((keys & MOST_TERMS).astype(np.int32)), pa.array(counts)], ["lang", "source", "i", "n"]
            )

        for batch in batches:
            for lang, part in _portions(batch):
                text, place, n = _vectors(lang, part.column("text"), index)
                own = [groups.setdefault((lang, name), len(groups)) for name in part.column("source").to_pylist()]
                more = _summed(np.asarray(own, dtype=np.int64)[text] << 31 | place, n)
                keys, counts = _summed(np.concatenate([keys, more[0]]), np.concatenate([counts, more[1]]))
                if len(keys) > TASK_SUMS:
                    yield rows()
                    groups, keys, counts = {}, keys[:0], counts[:0]
        yield rows()

    partial = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, i int, n long")
    return partial.groupBy("lang", "source", "i").agg(F.sum("n").alias("n"))


def group_sums(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """(lang, source, term, n): occurrences of every kept term in every group that has it."""
    spark = docs.sparkSession
    kept = vocabulary(docs, min_documents).select(F.concat("lang", F.lit(MARK), "term").alias("word"))
    slices = max(1, math.ceil(kept.count() / slice_terms))
    found = []
    for at in range(slices):
        # About ``slice_terms`` words come to the driver and go to every task.
        words = [row["word"] for row in kept.where(F.pmod(F.xxhash64("word"), F.lit(slices)) == at).collect()]
        names = spark.createDataFrame(list(enumerate(words)), "i int, word string")
        sums = vector_sums(docs, words).join(F.broadcast(names), "i")
        term = F.substring_index("word", MARK, -1).alias("term")
        found.append(materialize(sums.select("lang", "source", term, "n")))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def shares(n: str, total: str, size: str) -> Column:
    """1 + floor(UNIT * (n + SMOOTHING) / (total + SMOOTHING * size)), exactly."""
    whole = f"cast({UNIT} as decimal(20,0)) * cast({n} + {SMOOTHING} as decimal(18,0))"
    return F.expr(f"1 + (({whole}) div cast({total} + {SMOOTHING} * {size} as decimal(20,0)))")


def _differences(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums over a block's terms of |p - q| - |rest of p - rest of q|, for all pairs of its sources.

    A source's rest is its share of a term that it doesn't have, so terms that neither has give nothing.
    """
    names, row = np.unique(frame["source"].to_numpy(dtype=object), return_inverse=True)
    terms_of, column = np.unique(frame["term"].to_numpy(dtype=object), return_inverse=True)
    rest, side = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
    rest[row], side[row] = frame["rest"], frame["block"]
    one, two = int(frame["first"].iat[0]), int(frame["second"].iat[0])
    left, right = np.flatnonzero(side == one), np.flatnonzero(side == two)
    apart = np.abs(rest[left][:, None] - rest[right][None, :])
    # The first slice also has what the terms of the whole language differ by at least.
    total = apart * (int(frame["size"].iat[0]) if int(frame["slice"].iat[0]) == 0 else 0)
    order = np.argsort(column, kind="stable")
    ordered, shares_of = column[order], frame["p"].to_numpy()
    step = max(1, 2_000_000 // max(len(left) * len(right), 1))
    for start in range(0, len(terms_of), step):
        a, b = np.searchsorted(ordered, [start, start + step])
        inside = order[a:b]
        dense = np.repeat(rest[None, :], min(step, len(terms_of) - start), axis=0)
        dense[column[inside] - start, row[inside]] = shares_of[inside]
        total += (np.abs(dense[:, left, None] - dense[:, None, right]) - apart).sum(axis=0)
    i, j = np.nonzero(left[:, None] < right[None, :])  # sources are numbered in the order of their bytes
    lang = np.full(len(i), frame["lang"].iat[0], dtype=object)
    return pd.DataFrame({"lang": lang, "a": names[left[i]], "b": names[right[j]], "f": total[i, j]})


def _pairs(scored: DataFrame, totals: DataFrame, block_sums: int) -> DataFrame:
    """(lang, a, b, f) of every two sources of a language, each pair once."""
    blocks = totals.groupBy("lang").agg(F.max("block").alias("last"))
    counts = scored.groupBy("lang").agg(F.count(F.lit(1)).alias("sums"))
    dealt = blocks.join(counts, "lang", "left").select(
        "lang", "last", F.greatest(F.ceil(F.col("sums") / (block_sums * (F.col("last") + 1))), F.lit(1)).alias("slices")
    )
    dealt = materialize(dealt)  # one row for each language
    own = ["lang", "source", "block", "rest", "size"]
    slice_of = F.pmod(F.xxhash64("term"), F.col("slices"))
    present = scored.join(dealt, "lang").select(*own, "term", "p", "last", slice_of.alias("slice"))
    # Every source stands in every slice, with a share of no term that is its rest.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    absent = totals.join(dealt, "lang").select(*own, F.lit("").alias("term"), F.col("rest").alias("p"), "last", every)
    blocked = (
        present.unionByName(absent)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
        .drop("other", "last")
    )
    gaps = blocked.groupBy("lang", "slice", "first", "second").applyInPandas(
        _differences, "lang string, a string, b string, f long"
    )
    return gaps.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))


def audit(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    slice_terms: int = SLICE_TERMS,
    block_sources: int = BLOCK_SOURCES,
    block_sums: int = BLOCK_SUMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part ``pair``: every other source of the language and the sum of the shares' absolute differences. Part
    ``term``: the ``top_terms`` terms whose share in the source exceeds that in the language most, and by what.
    """
    docs = _plain(df, lang=lang, source=source, text=text)
    sums = group_sums(docs, min_documents, slice_terms)
    per_term = materialize(sums.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")))
    sizes = per_term.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("lang_n").alias("lang_total"))
    groups = docs.select("lang", "source", F.lit(0).cast("long").alias("n"))
    totals = (
        groups.unionByName(sums.select("lang", "source", "n"))
        .groupBy("lang", "source").agg(F.sum("n").alias("total"))
        .join(sizes, "lang", "left").na.fill(0, ["size", "lang_total"])
    )
    rest = F.when(F.col("size") > 0, shares("0L", "total", "size")).otherwise(0).cast("long")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    block = F.floor(place / F.lit(block_sources)).cast("long")
    totals = materialize(totals.withColumns({"rest": rest, "block": block}))
    scored = materialize(
        sums.join(totals, ["lang", "source"]).withColumn("p", shares("n", "total", "size")).drop("n", "total")
    )

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    more = (
        scored.join(per_term, ["lang", "term"])
        .withColumn("value", F.col("p") - shares("lang_n", "lang_total", "size"))
        .where("value > 0")
        .withColumn("item", F.col("term"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top_terms)
        .withColumn("part", F.lit("term"))
    )
    pairs = materialize(_pairs(scored, totals, block_sums))
    turned = pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "f")
    others = (
        pairs.unionByName(turned)
        .select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), F.col("f").alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
    )
    return others.select(*columns).unionByName(more.select(*columns))

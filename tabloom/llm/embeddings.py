"""Near-duplicate embeddings: randomised-rotation binary codes with stored correction factors.

Unit vectors are turned by random rotations; a vector's code is the signs of its turned coordinates, and a
rotation's correction factor the inner product of the code, as a unit vector, and the vector. Code and factors are
worked out once a vector and stored. A code divided by its factor is the vector plus an error that is orthogonal
to it and has a random direction, so the product of two such estimates from different rotations is an unbiased
estimate of the inner product of the vectors. It is averaged over all pairs of different rotations. Its standard
deviation for a pair at the threshold follows from the factors, and that of a closer pair is smaller.

1. Candidates: parts of the code (``bits`` signs each) put every vector into one cell of each of several tables. Codes,
   not vectors, are sent to the cells. A pair is looked at in the first table in which it meets.
2. A pair whose estimate lies more than ``BOUND`` deviations below the threshold is no link. Vectors that have any other
   pair are fetched to the cell, and all its undecided pairs are recomputed exactly, by one formula in double
   precision. Those that reach the threshold (equal counts) are links, no others.

The number of tables follows from the wanted recall of pairs right at the threshold (closer pairs are found more
surely); bits grow with the logarithm of the number of vectors, so cells keep their size. A code takes
``ROTATIONS`` bits a dimension, or as many as the tables use if that is more.

* Exact copies are collapsed first and weigh as many as they are.
* A large cell is cut into blocks, and every pair of blocks is a task of bounded size. Tasks return vectors with
  undecided pairs, then sums per vector and the edges of a spanning forest, never pairs.

Defined cases: a vector that is null, empty, zero or has null or non-finite components, or whose id is null,
links with nothing; vectors of different length are not compared; rows that repeat id and vector count
as separate vectors; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.components import components
from tabloom.sources.shared import materialize

THRESHOLD = 0.9
RECALL = 0.99
CELL_ROWS = 400
BLOCK_ROWS = 2048
#: Estimates are averaged over the pairs of so many rotations.
ROTATIONS = 4
#: Width of the bound in standard deviations of the estimate.
BOUND = 4.0
#: Exact products are taken of so many pairs at a time.
EXACT_PAIRS = 65_536
SEED = 7


@lru_cache(maxsize=16)
def rotations(dim: int, count: int) -> np.ndarray:
    """``count`` random rotations, one below the other (count * dim rows)."""
    draws = np.random.default_rng([SEED, dim]).standard_normal((count, dim, dim))
    return np.concatenate([np.linalg.qr(draw)[0] for draw in draws])


def tables_for(bits: int, threshold: float, recall: float) -> int:
    """How many tables of ``bits`` signs find a pair at the threshold with probability ``recall``."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - same))) if same < 1 else 1


def _unit(raw: list[bytes], dtype: str) -> np.ndarray:
    vectors = np.stack([np.frombuffer(x, dtype=dtype) for x in raw]).astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def code_bits(dim: int, bits: int, tables: int) -> int:
    return max(ROTATIONS * dim, bits * tables)


def encode(vectors: np.ndarray, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed codes of unit vectors, and their correction factors in the first ``ROTATIONS`` rotations."""
    dim = vectors.shape[1]
    width = code_bits(dim, bits, tables)
    turned = vectors @ rotations(dim, math.ceil(width / dim)).T
    along = np.abs(turned[:, : ROTATIONS * dim]).reshape(len(vectors), ROTATIONS, dim)
    factors = (along.sum(axis=2) / math.sqrt(dim)).astype(np.float32)
    return np.packbits(turned[:, :width] > 0, axis=1), factors


def _cells(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Cell of every vector (row) in every table (column)."""
    parts = signs[:, : bits * tables].reshape(len(signs), tables, bits)
    return parts @ (1 << np.arange(bits, dtype=np.int64))


class Codes:
    """Codes of vectors of one length, ready for estimates of their inner products."""

    def __init__(self, codes: np.ndarray, factors: np.ndarray, dim: int, bits: int, tables: int, threshold: float):
        signs = np.unpackbits(codes, axis=1, count=code_bits(dim, bits, tables))
        self.cells = _cells(signs, bits, tables)
        unit = signs[:, : ROTATIONS * dim].astype(np.float32) * 2 - 1
        scaled = unit.reshape(len(codes), ROTATIONS, dim) / (factors[:, :, None] * np.float32(math.sqrt(dim)))
        self.scaled = scaled.reshape(len(codes), ROTATIONS * dim)
        # Each rotation's estimate of the vector, turned back and summed.
        self.total = self.scaled @ rotations(dim, ROTATIONS).astype(np.float32)
        self.error = np.maximum(1 / factors.astype(np.float64) ** 2 - 1, 0).mean(axis=1)
        self.dim, self.threshold = dim, threshold

    def estimates(self, rows: slice) -> np.ndarray:
        """Estimated inner products of ``rows`` with all vectors; products within a rotation are left out."""
        both = self.total[rows] @ self.total.T - self.scaled[rows] @ self.scaled.T
        return both / (ROTATIONS * (ROTATIONS - 1))

    def deviations(self, rows: slice) -> np.ndarray:
        """Standard deviation of the estimate for a pair at the threshold."""
        one, two = self.error[rows, None], self.error[None, :]
        across = max(0.0, 1 - self.threshold**2) * (one + two) / ROTATIONS
        return np.sqrt((across + one * two / (ROTATIONS * (ROTATIONS - 1))) / max(self.dim - 1, 1))

    def undecided(self, table: int, block: np.ndarray, crossing: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i < j) that meet first in ``table`` and whose estimate doesn't rule a link out, in parts."""
        for start in range(0, len(self.cells), 512):
            rows = slice(start, start + 512)
            i, j = np.nonzero(self.estimates(rows) + BOUND * self.deviations(rows) + 1e-5 >= self.threshold)
            i += start
            keep = i < j
            if crossing:
                keep &= block[i] != block[j]
            i, j = i[keep], j[keep]
            first = (self.cells[i] == self.cells[j]).argmax(axis=1) == table
            yield i[first], j[first]


def _products(vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parts = [slice(at, at + EXACT_PAIRS) for at in range(0, len(i), EXACT_PAIRS)]
    return np.concatenate([np.einsum("ij,ij->i", vectors[i[p]], vectors[j[p]]) for p in parts] or [np.zeros(0)])


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        fresh = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(fresh, label[i], low)
        np.minimum.at(fresh, label[j], low)
        while (jumped := fresh[fresh]).tolist() != fresh.tolist():
            fresh = jumped
        if (fresh == label).all():
            return label
        label = fresh


KEYS = ["dim", "t", "cell", "first", "second"]


def _codes_of(frame: pd.DataFrame, bits: int, tables: int, threshold: float) -> Codes:
    codes = np.stack([np.frombuffer(x, dtype=np.uint8) for x in frame["code"]])
    factors = np.stack([np.frombuffer(x, dtype="<f4") for x in frame["factors"]])
    return Codes(codes, factors, int(frame["dim"].iat[0]), bits, tables, threshold)


def _pairs(frame: pd.DataFrame, bits: int, tables: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    crossing = frame["first"].iat[0] != frame["second"].iat[0]
    codes = _codes_of(frame, bits, tables, threshold)
    return codes.undecided(int(frame["t"].iat[0]), frame["block"].to_numpy(), crossing)


def to_fetch(frame: pd.DataFrame, bits: int, tables: int, threshold: float) -> pd.DataFrame:
    """The vectors of one cell, or of two of its blocks, that have an undecided pair there."""
    needed = np.zeros(len(frame), dtype=bool)
    for i, j in _pairs(frame, bits, tables, threshold):
        needed[i] = needed[j] = True
    return frame.loc[needed, [*KEYS, "block", "rep"]]


def compare(frame: pd.DataFrame, dtype: str, bits: int, tables: int, threshold: float) -> pd.DataFrame:
    """Links among the fetched vectors of one cell, or between two of its blocks: sums per vector and forest."""
    frame = frame.sort_values("rep", ignore_index=True)
    vectors = _unit(frame["vec"].tolist(), dtype)
    found_i, found_j = [], []
    for i, j in _pairs(frame, bits, tables, threshold):
        link = _products(vectors, i, j) >= threshold
        found_i.append(i[link])
        found_j.append(j[link])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    weight = frame["copies"].to_numpy()
    links = np.bincount(i, weight[j], len(frame)) + np.bincount(j, weight[i], len(frame))
    root = frame["rep"].to_numpy()[_forest(i, j, len(frame))]
    out = pd.DataFrame({"rep": frame["rep"], "links": links.astype(np.int64), "root": root})
    return out[out["links"] > 0]


def valid(vector: str) -> F.Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    col = F.col(vector)
    return F.coalesce(F.forall(col, finite) & F.exists(col, lambda x: x != 0), F.lit(False))


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row: key, ``n_links``, ``component_id`` (smallest key reachable) and ``kept``."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    usable = F.col("id").isNotNull() & valid("v")
    hashed = rows.select("id", "v", usable.alias("ok"), F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v")).alias("h2"))
    members = materialize(hashed.drop("v"))
    distinct = materialize(
        hashed.where("ok")
        .groupBy("h1", "h2")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    )
    n = distinct.count()
    bits = min(60, max(1, round(math.log2(max(n, 2) / cell_rows))))
    tables = tables_for(bits, threshold, recall)
    dtype = "<f4" if df.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            raw = [np.asarray(v, dtype=dtype).tobytes() for v in batch.column("v").to_pylist()]
            for at, x in enumerate(raw):
                by_dim.setdefault(len(x) // np.dtype(dtype).itemsize, []).append(at)
            for dim, at in by_dim.items():
                codes, factors = encode(_unit([raw[a] for a in at], dtype), bits, tables)
                columns = {name: batch.column(name).to_numpy()[at] for name in ("rep", "copies")}
                columns |= {"dim": np.full(len(at), dim), "vec": [raw[a] for a in at]}
                columns |= {"code": [x.tobytes() for x in codes], "factors": [x.tobytes() for x in factors]}
                yield pa.RecordBatch.from_pydict(columns)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                packed = np.stack([np.frombuffer(x, dtype=np.uint8) for x in part.column("code").to_pylist()])
                cells = _cells(np.unpackbits(packed, axis=1, count=code_bits(dim, bits, tables)), bits, tables)
                rows = part.take(pa.array(np.repeat(np.arange(part.num_rows), tables)))
                columns = {name: rows.column(name) for name in rows.schema.names}
                columns |= {"t": np.tile(np.arange(tables), part.num_rows), "cell": cells.ravel()}
                yield pa.RecordBatch.from_pydict(columns)

    schema = "rep long, copies long, dim long, vec binary, code binary, factors binary"
    stored = materialize(distinct.select("rep", "copies", "v").mapInArrow(coded, schema))
    keys = ["dim", "t", "cell"]
    counted = stored.select("dim", "code").mapInArrow(placed, "dim long, code binary, t long, cell long")
    large = materialize(counted.groupBy(keys).count().where(F.col("count") > block_rows))
    # ``large`` has few rows and is a stored table: Spark broadcasts it if it is small, else it joins by sorting.
    full = stored.select("rep", "dim", "code", "factors").mapInArrow(
        placed, "rep long, dim long, code binary, factors binary, t long, cell long"
    )
    blocks = F.ceil(F.coalesce("count", F.lit(1)) / block_rows)
    blocked = (
        full.join(large, keys, "left")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
        .select(*KEYS, "block", "rep", "code", "factors")
    )
    places = "dim long, t long, cell long, first long, second long, block long, rep long"
    needed = materialize(
        blocked.groupBy(KEYS).applyInPandas(lambda frame: to_fetch(frame, bits, tables, threshold), places)
    )
    compared = materialize(
        needed.join(stored.drop("dim"), "rep")
        .groupBy(KEYS)
        .applyInPandas(
            lambda frame: compare(frame, dtype, bits, tables, threshold), "rep long, links long, root long"
        )
    )
    links = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(compared.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    groups = (
        distinct.select("h1", "h2", "rep", "copies")
        .join(links, "rep", "left")
        .join(linked.withColumnRenamed("vertex", "rep"), "rep", "left")
        .select(
            "h1", "h2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = members.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    found = members.where("ok").join(materialize(groups), ["h1", "h2"]).select("id", "n_links", "component_id")
    result = found.unionByName(alone)
    return result.select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )

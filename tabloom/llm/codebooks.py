"""Compression of vectors to codebook indices, in integers, with memoised grid cells.

Every component becomes ``floor(scale * x)``, and vectors are cut into equal consecutive parts. Each part position
has a codebook; a part is coded by the index of its nearest entry (squared Euclidean distance, ties to the lower
index). Codebooks start as the parts of the smallest ids and move to the means of their parts for a few rounds.

To find the nearest entry, a part is hashed to a coarse grid cell, a box of equal sides. The first time a
cell is met, the least and the greatest distance of every entry from its box are worked out; an entry whose least
distance exceeds another's greatest one can be nearest to no point of the box. What is left is remembered for the
cell, and only these entries are evaluated for its parts. So results are those of comparing every entry.

Bounds: a task remembers at most ``CACHE_CELLS`` cells a part position and starts anew when they are full, which only
costs time; codebooks (parts x entries) and one row of sums for each entry are all that passes the driver; every
task sends one row of sums for each entry.

Defined cases: vectors that are null, or hold null or non-finite components, or whose length isn't a positive
multiple of ``parts`` or isn't that of the smallest id left, are dropped. Rows with equal ids are rows of their own,
ordered by their vectors; null ids come last and are kept. With fewer vectors than ``entries`` there are fewer
entries. An empty table gives an empty result. Equal labels share an error, null labels too. Extra columns are
not read. Components beyond about 2^26 / scale raise an error, as distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.attach import attach
from tabloom.operators.grouped import per_group
from tabloom.sources.shared import materialize

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CACHE_CELLS = 200_000


def finite(vector: str) -> Column:
    col = F.col(vector)
    good = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(good, F.lit(False))


def integers(vectors: np.ndarray, scale: int, parts: int) -> np.ndarray:
    """Vectors (rows) as integers, shape (vectors, parts, components of a part)."""
    values = np.floor(vectors.astype(np.float64) * scale)
    size = values.shape[1] // parts
    if np.abs(values).max(initial=0) > math.isqrt((1 << 55) // size):
        raise ValueError("vector components are too large for exact distances in 64 bits")
    return values.astype(np.int64).reshape(len(values), parts, size)


class Nearest:
    """Nearest entry of one codebook, by memoised candidates of grid cells."""

    def __init__(self, book: np.ndarray):
        self.book = book
        spread = np.abs(book - book.mean(axis=0)).mean() if len(book) else 0
        self.shift = max(0, round(math.log2(max(spread, 1))))  # only the time depends on the cells' size
        self._empty()

    def _empty(self) -> None:
        self.known: dict[bytes, int] = {}
        self.candidates = np.zeros((1024, len(self.book)), dtype=bool)

    def _rows_of(self, cells: np.ndarray) -> np.ndarray:
        """Row in ``candidates`` of every cell; the cells are distinct."""
        if len(self.known) + len(cells) > CACHE_CELLS:
            self._empty()
        names = [cell.tobytes() for cell in cells]
        fresh = [at for at, name in enumerate(names) if name not in self.known]
        if fresh:
            low = (cells[fresh] << self.shift)[:, None, :]
            high = low + ((1 << self.shift) - 1)
            book = self.book[None, :, :]
            least = (np.maximum(np.maximum(low - book, book - high), 0) ** 2).sum(axis=2)
            greatest = (np.maximum(np.abs(book - low), np.abs(book - high)) ** 2).sum(axis=2)
            top = len(self.known) + len(fresh)
            if top > len(self.candidates):
                grown = np.zeros((max(top, 2 * len(self.candidates)), len(self.book)), dtype=bool)
                grown[: len(self.candidates)] = self.candidates
                self.candidates = grown
            self.candidates[len(self.known) : top] = least <= greatest.min(axis=1, keepdims=True)
            for at in fresh:
                self.known[names[at]] = len(self.known)
        return np.fromiter((self.known[name] for name in names), dtype=np.int64, count=len(names))

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance of every point."""
        cells = points >> self.shift
        code = np.zeros(len(points), dtype=np.int64)
        for column in cells.T:  # numbers the distinct cells
            values, place = np.unique(column, return_inverse=True)
            code = np.unique(code * len(values) + place, return_inverse=True)[1]
        _, first, cell = np.unique(code, return_index=True, return_inverse=True)
        allowed = self.candidates_of(cells[first])[cell]
        point, entry = np.nonzero(allowed)
        distance = ((points[point] - self.book[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(point, np.arange(len(points)))
        best = np.minimum.reduceat(distance * len(self.book) + entry, starts)  # ties to the lower index
        return best % len(self.book), best // len(self.book)

    def candidates_of(self, cells: np.ndarray) -> np.ndarray:
        rows = self._rows_of(cells)  # may replace the table of candidates
        return self.candidates[rows]


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)


def _nearest_of_all(values: np.ndarray, finders: list[Nearest]) -> tuple[np.ndarray, np.ndarray]:
    found = [finders[part](values[:, part]) for part in range(values.shape[1])]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _moved(rows: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """The codebooks after a round: every entry becomes the mean of its parts, unused entries stay."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [Nearest(book) for book in books]
        sums, counts = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                values = integers(_vectors(batch), scale, parts)
                near, _ = _nearest_of_all(values, finders)
                for part in range(parts):
                    np.add.at(sums[part], near[:, part], values[:, part])
                    counts[part] += np.bincount(near[:, part], minlength=entries)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "part": part.astype(np.int64),
                "entry": entry.astype(np.int64),
                "n": counts[part, entry],
                "sums": pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
            }
        )

    partial = rows.select("vector").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    totals = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums")
    )
    books = books.copy()
    for row in totals.collect():  # one row for each entry at most
        books[row["part"], row["entry"]] = [total // row["n"] for total in row["sums"]]
    return books


def compress(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Per kept row: key, label, ``code`` (array of indices), ``error``, ``label_error``; and the codebooks."""
    if parts < 1 or entries < 1:
        raise ValueError("parts and entries must be positive")
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.where(finite("vector") & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    first = rows.orderBy(F.col("key").asc_nulls_last(), "vector").first()
    width = len(first["vector"]) if first else parts
    rows = rows.where(F.size("vector") == width)
    start = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
    raw = np.asarray([row["vector"] for row in start], dtype=np.float64).reshape(len(start), width)
    books = integers(raw, scale, parts).transpose(1, 0, 2)
    for _ in range(rounds if start else 0):
        books = _moved(rows, books, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [Nearest(book) for book in books]
        for batch in batches:
            if batch.num_rows:
                values = integers(_vectors(batch), scale, parts)
                near, distance = _nearest_of_all(values, finders)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"),
                        batch.column("label"),
                        pa.array(list(near.astype(np.int32)), pa.list_(pa.int32())),
                        pa.array(distance.sum(axis=1)),
                    ],
                    ["key", "label", "code", "error"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    coded = materialize(
        rows.mapInArrow(run, f"key {kinds['key']}, label {kinds['label']}, code array<int>, error long")
    )
    sums = per_group(coded, ["label"], {"label_error": F.sum("error")})
    found = attach(coded, sums, ["label"])
    return found.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error"), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

"""Suffix-array dedup: spans that a document shares with an earlier one are cut, by a distributed merge sort.

A byte goes if it is covered by a string of ``span`` bytes that also starts in a document with a smaller key.
Sorting every suffix would write many times the corpus, so only those are sorted that can have an equal:

1. Documents are stored in runs of about ``run_bytes`` bytes, compressed.
2. The anchor of a string of ``span`` bytes is its leftmost ``gram`` bytes with the smallest hash, so equal strings
   have equal anchors, and neighbouring strings mostly share theirs. Every run sends the sorted, delta-coded hashes
   of its anchors to buckets; a bucket answers each run with those that more than one document has.
3. A run takes the suffixes at these anchors, together with the bytes before them as far as strings with that
   anchor reach, sorts them, keeps one of equal ones (for the smallest key), and sends them front-coded: each as
   the length of the prefix that it shares with its predecessor and the bytes after that.
4. A bucket merges the runs by a loser tree. A player's common prefix with the last winner is known; the longer one
   wins, and only if both are equally long are bytes compared, from there on. So known prefixes are never compared
   again, and the merged order comes with its own common prefixes. Suffixes that share a prefix stand together:
   for each offset of the anchor within the string, equal strings are those that share the rest of the string to the
   right and, refined byte by byte, that to the left. The smallest key of each decides, exactly.
5. The answers go back to the runs, which mark the bytes and cut them.

Suffixes are dealt by the hash of their anchor, not by ranges of bytes, as order between buckets isn't needed; so a
frequent beginning is no large range. Copies cost one suffix a run, however many there are. Bounds: a run, an
answer to a run and a bucket are worked on at once; the numbers of buckets follow from those of bytes and of shared
anchors; nothing but these sums comes to the driver. A bucket grows only if one string of ``gram`` bytes stands in
very many different surroundings.

Defined cases: a null text counts as empty; texts are UTF-8 bytes, strings may begin and end inside a character and
so may what is left; texts shorter than ``span`` keep everything, one of any length is worked on in blocks; rows with
equal keys are no earlier documents to each other, null keys come after all others (and tie); rows that are repeated
are rows of their own; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize

SPAN = 50
GRAM = 24
RUN_BYTES = 8_000_000
BLOCK_BYTES = 1_000_000
BUCKET_HASHES = 1_000_000
BUCKET_SUFFIXES = 60_000
LAST = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from every position on, by doubling."""
    part, width = data.astype(np.uint64) + np.uint64(1), 1
    found, done, left = None, 0, gram
    while left:
        if left & 1:
            if found is None:
                found = part
            else:
                n = len(part) - done
                found = found[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + part[done:]
            done += width
        left >>= 1
        if left:
            part = part[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + part[width:]
            width *= 2
    return _mixed(found)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return np.minimum(least[: len(least) - (width - reach)], least[width - reach :]) if reach < width else least


class Run:
    """The documents of a run with their anchors.

    ``at`` is an anchor's position; ``low`` and ``high`` the first position of a string that has it and the one after
    the last; ``hash`` 48 bits that stand for its bytes; ``doc`` its document's number in the run.
    """

    def __init__(self, body: bytes, lengths: np.ndarray, span: int, gram: int):
        self.data, self.span, self.gram = np.frombuffer(body, dtype=np.uint8), span, gram
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        found = [self._block(start) for start in range(0, max(len(self.data) - span + 1, 0), BLOCK_BYTES)]
        empty = [np.zeros(0, dtype=np.int64)] * 4 + [np.zeros(0, dtype=np.uint64)]
        self.doc, self.at, self.low, self.high, self.hash = map(np.concatenate, zip(empty, *found))

    def _block(self, start: int) -> tuple[np.ndarray, ...]:
        data = self.data[start : start + BLOCK_BYTES + self.span - 1]
        hashes = gram_hashes(data, self.gram)
        # The upper bits order the grams, the position below them makes the leftmost of equal ones the least.
        mask = np.uint64((1 << 24) - 1)
        ranks = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
        least = sliding_least(ranks, self.span - self.gram + 1)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        at = (least[first] & mask).astype(np.int64)
        hashed = _mixed(hashes[at] ^ np.uint64(_BASE)) >> np.uint64(16)
        low, high, at = first + start, np.append(first[1:], len(least)) + start, at + start
        doc = np.searchsorted(self.ends, at, side="right")
        low, high = np.maximum(low, self.starts[doc]), np.minimum(high, self.ends[doc] - self.span + 1)
        inside = low < high
        return doc[inside], at[inside], low[inside], high[inside], hashed[inside]

    def shared_only(self, wanted: np.ndarray) -> None:
        """Leave the anchors whose hash is among the sorted ``wanted``."""
        place = np.searchsorted(wanted, self.hash)
        keep = np.zeros(len(self.hash), dtype=bool)
        near = place < len(wanted)
        keep[near] = wanted[place[near]] == self.hash[near]
        self.doc, self.at, self.low, self.high, self.hash = (
            x[keep] for x in (self.doc, self.at, self.low, self.high, self.hash)
        )

    def suffixes(self) -> np.ndarray:
        """A row of bytes for every anchor: the suffix, the bytes before it backwards, and how long both are."""
        width = self.span - self.gram
        right, left = self.span - (self.at - self.high + 1), self.at - self.low
        rows = np.zeros((len(self.at), -(-(self.span + width + 2) // 8) * 8), dtype=np.uint8)
        for j in range(self.span):
            some = right > j
            rows[some, j] = self.data[self.at[some] + j]
        for j in range(width):
            some = left > j
            rows[some, self.span + j] = self.data[self.at[some] - 1 - j]
        rows[:, self.span + width], rows[:, self.span + width + 1] = right, left
        return rows

    def sorted_suffixes(self, keys: np.ndarray, buckets: int):
        """Distinct suffixes in the order of bucket and bytes.

        (bucket, rows, least key) of every distinct one, and for every anchor the number of its distinct suffix.
        """
        rows = self.suffixes()
        bucket = (self.hash % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
        rows, owner = rows[order], keys[self.doc[order]]
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1) | (bucket[order][1:] != bucket[order][:-1])
        first = np.flatnonzero(fresh)
        number = np.empty(len(rows), dtype=np.int64)
        number[order] = np.cumsum(fresh) - 1
        least = np.minimum.reduceat(owner, first) if len(first) else owner
        return bucket[order][first], rows[first], least, number


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that every row shares with the one before."""
    differ = rows[1:] != rows[:-1]
    length = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1]) if len(rows) else np.zeros(0)
    return np.concatenate([[0], length]).astype(np.int64) if len(rows) else length.astype(np.int64)


def front_coded(rows: np.ndarray, lcp: np.ndarray) -> bytes:
    behind = np.arange(rows.shape[1])[None, :] >= lcp[:, None]
    return zstandard.compress(lcp.astype(np.uint8).tobytes() + rows[behind].tobytes(), 3)


def from_front_coded(data: bytes, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    lcp, tails = raw[:n].astype(np.int64), raw[n:]
    begin = n and np.cumsum(width - lcp) - (width - lcp)
    rows, at = np.empty((n, width), dtype=np.uint8), np.arange(n)
    for j in range(width):
        source = np.maximum.accumulate(np.where(lcp <= j, at, 0))
        rows[:, j] = tails[begin[source] + j - lcp[source]]
    return rows, lcp


def merged(runs: list[np.ndarray], prefixes: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """The number of the run of each row in merged order, and its common prefix with the row before.

    ``runs`` are sorted rows of bytes (a multiple of 8), ``prefixes`` their common prefixes.
    """
    width = runs[0].shape[1]
    words = width // 8
    rows = [run.view(">u8").astype(np.uint64).tolist() for run in runs]
    shared = [lcp.tolist() for lcp in prefixes]
    players = 1 << max(len(runs) - 1, 0).bit_length()
    left = [len(run) for run in runs] + [0] * (players - len(runs))
    place = [0] * players
    row = [run[0] if run else None for run in rows] + [None] * (players - len(runs))
    # Common prefix with the last winner; a player without rows has less than any.
    known = [0 if one is not None else -1 for one in row]
    losers = [0] * players

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's common prefix is then that with the winner."""
        x, y = known[a], known[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        one, two, at = row[a], row[b], x >> 3
        while at < words and one[at] == two[at]:
            at += 1
        if at == words:
            known[b] = width
            return a, b
        differ = one[at] ^ two[at]
        length = 8 * at + ((64 - differ.bit_length()) >> 3)
        if one[at] < two[at]:
            known[b] = length
            return a, b
        known[a] = length
        return b, a

    winners = [0] * players + list(range(players))
    for node in range(players - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if players > 1 else 0
    order, lcps = [], []
    while known[best] >= 0:
        order.append(best)
        lcps.append(known[best])
        at = place[best] = place[best] + 1
        if at < left[best]:
            row[best], known[best] = rows[best][at], shared[best][at]
        else:
            known[best] = -1
        node = (best + players) >> 1
        while node:
            other = losers[node]
            x, y = known[best], known[other]
            if x > y:
                pass
            elif x < y:
                losers[node], best = best, other
            else:
                best, losers[node] = play(best, other)
            node >>= 1
    return order, lcps


def removed_strings(rows: np.ndarray, lcp: np.ndarray, keys: np.ndarray, span: int, gram: int) -> np.ndarray:
    """For each suffix in merged order a set of offsets (bits): those whose string a smaller key has too."""
    width = span - gram
    found = np.zeros(len(rows), dtype=np.int64)
    high, low = rows[:, span + width + 1].astype(np.int64), span - rows[:, span + width].astype(np.int64)
    # Only groups of equal grams in which keys differ need a look.
    group = np.cumsum(lcp < gram) - 1
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    several = np.minimum.reduceat(keys, starts) != np.maximum.reduceat(keys, starts)
    look = np.flatnonzero(several[group])
    if not len(look):
        return found
    # Rows that are left out are whole groups, so the common prefixes stay those of neighbours.
    lcp, high, low, keys, before = lcp[look], high[look], low[look], keys[look], rows[look, span : span + width]
    left = np.zeros(len(look), dtype=np.int64)
    bits = np.zeros(len(look), dtype=np.int64)
    for offset in range(width + 1):
        if offset:
            left = np.unique(left * 256 + before[:, offset - 1], return_inverse=True)[1]
        there = np.flatnonzero((low <= offset) & (offset <= high))
        if not len(there):
            continue
        right = np.cumsum(lcp < span - offset)
        same = right[there] * (int(left.max()) + 1) + left[there]
        order = np.argsort(same, kind="stable")
        ordered = same[order]
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        least = np.repeat(np.minimum.reduceat(keys[there][order], begin), np.diff(np.append(begin, len(order))))
        late = there[order][keys[there][order] > least]
        bits[late] |= 1 << offset
    found[look] = bits
    return found


def _runs(df: DataFrame, key: str, text: str, run_bytes: int) -> DataFrame:
    """Stored (run, keys, lengths, n_bytes, body): the documents in the order they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        keys: list = []
        bodies: list[bytes] = []
        done = size = 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "run": pa.array([first + done]),
                    "keys": pa.array([keys], pa.list_(pa.int64())),
                    "lengths": pa.array([list(map(len, bodies))], pa.list_(pa.int64())),
                    "n_bytes": pa.array([size], pa.int64()),
                    "body": pa.array([zstandard.compress(b"".join(bodies), 3)], pa.binary()),
                }
            )

        for batch in batches:
            for name, body in zip(batch.column("key").to_pylist(), batch.column("body").to_pylist()):
                if bodies and size + len(body) > run_bytes:
                    yield row()
                    keys, bodies, done, size = [], [], done + 1, 0
                keys.append(name)
                bodies.append(body)
                size += len(body)
        if bodies:
            yield row()

    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    return materialize(rows.mapInArrow(run, "run long, keys array<long>, lengths array<long>, n_bytes long, body binary"))


def _read(row: dict, span: int, gram: int) -> tuple[Run, np.ndarray]:
    run = Run(zstandard.decompress(row["body"]), np.asarray(row["lengths"], dtype=np.int64), span, gram)
    return run, np.asarray([LAST if key is None else key for key in row["keys"]], dtype=np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, as a row is a whole run."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _shared_hashes(runs: DataFrame, span: int, gram: int, buckets: int) -> DataFrame:
    """Stored (run, n, hashes): anchors' hashes of each run that several documents have."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            run, _ = _read(row, span, gram)
            bucket = run.hash % np.uint64(buckets)
            order = np.lexsort([run.doc, run.hash, bucket])
            hashes, docs = run.hash[order], run.doc[order]
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else order
            several = np.maximum.reduceat(docs, first) != docs[first] if len(first) else np.zeros(0, dtype=bool)
            hashes, bucket = hashes[first], bucket[order][first]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(first) else first
            columns: dict[str, list] = {"bucket": [], "run": [], "hashes": [], "several": []}
            for a, b in zip(cuts, np.append(cuts[1:], len(first))):
                columns["bucket"].append(int(bucket[a]))
                columns["run"].append(row["run"])
                columns["hashes"].append(packed(np.diff(hashes[a:b], prepend=np.uint64(0))))
                columns["several"].append(np.packbits(several[a:b]).tobytes())
            yield pa.RecordBatch.from_pydict(columns, pa.schema([("bucket", pa.int64()), ("run", pa.int64()), ("hashes", pa.binary()), ("several", pa.binary())]))

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.cumsum(unpacked(data, np.uint64), dtype=np.uint64) for data in frame["hashes"]]
        flags = [np.unpackbits(np.frombuffer(f, np.uint8), count=len(p)).astype(bool) for f, p in zip(frame["several"], parts)]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        again = ordered[1:] == ordered[:-1]
        shared = np.concatenate(flags)
        shared[order[1:][again]] = shared[order[:-1][again]] = True
        ends = np.cumsum([len(p) for p in parts])
        out = [part[shared[end - len(part) : end]] for part, end in zip(parts, ends)]
        found = pd.DataFrame({"run": frame["run"], "n": [len(x) for x in out], "hashes": [packed(np.diff(x, prepend=np.uint64(0))) for x in out]})
        return found[found["n"] > 0]

    rows = runs.select("run", "keys", "lengths", "body").mapInArrow(sent, "bucket long, run long, hashes binary, several binary")
    return materialize(rows.groupBy("bucket").applyInPandas(answer, "run long, n long, hashes binary"))


def _wanted(row: dict) -> np.ndarray:
    parts = [np.cumsum(unpacked(data, np.uint64), dtype=np.uint64) for data in row["hashes"]]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


def _decided(runs: DataFrame, span: int, gram: int, buckets: int) -> DataFrame:
    """Stored (run, bucket, sets): the sets of removed offsets of a run's suffixes in a bucket, in sorted order."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            run, keys = _read(row, span, gram)
            run.shared_only(_wanted(row))
            bucket, rows, least, _ = run.sorted_suffixes(keys, buckets)
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else bucket
            columns: dict[str, list] = {"bucket": [], "run": [], "n": [], "rows": [], "keys": []}
            for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
                columns["bucket"].append(int(bucket[a]))
                columns["run"].append(row["run"])
                columns["n"].append(int(b - a))
                columns["rows"].append(front_coded(rows[a:b], common_prefixes(rows[a:b])))
                columns["keys"].append(packed(least[a:b]))
            yield pa.RecordBatch.from_pydict(columns, pa.schema([("bucket", pa.int64()), ("run", pa.int64()), ("n", pa.int64()), ("rows", pa.binary()), ("keys", pa.binary())]))

    width = -(-(2 * span - gram + 2) // 8) * 8

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        decoded = [from_front_coded(data, n, width) for data, n in zip(frame["rows"], frame["n"])]
        order, lcp = merged([rows for rows, _ in decoded], [prefix for _, prefix in decoded])
        origin = np.asarray(order)
        # The rows of a run come in their order, so its k-th one in the result is its k-th row.
        by_run = np.argsort(origin, kind="stable")
        place = np.empty(len(origin), dtype=np.int64)
        place[by_run] = np.arange(len(origin))
        rows = np.concatenate([rows for rows, _ in decoded])[place]
        keys = np.concatenate([unpacked(data, np.int64) for data in frame["keys"]])[place]
        sets = removed_strings(rows, np.asarray(lcp), keys, span, gram)[by_run]
        ends = np.cumsum(frame["n"].to_numpy())
        out = [sets[end - n : end] for end, n in zip(ends, frame["n"])]
        found = pd.DataFrame({"run": frame["run"], "bucket": frame["bucket"], "sets": [packed(x) for x in out]})
        return found[[bool(x.any()) for x in out]]

    rows = runs.mapInArrow(sent, "bucket long, run long, n long, rows binary, keys binary")
    return materialize(rows.groupBy("bucket").applyInPandas(merge, "run long, bucket long, sets binary"))


def _cut(runs: DataFrame, span: int, gram: int, buckets: int) -> DataFrame:
    fields = [("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
    schema = pa.schema([*fields, ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            run, keys = _read(row, span, gram)
            run.shared_only(_wanted(row))
            bucket, _, least, number = run.sorted_suffixes(keys, buckets)
            sets = np.zeros(len(bucket), dtype=np.int64)
            for answer in row["sets"] or []:
                sets[bucket == answer["bucket"]] = unpacked(answer["sets"], np.int64)
            # What isn't the least key's goes whole; the least key's as the bucket says.
            gone = np.where(keys[run.doc] > least[number], -1, sets[number])
            edges = np.zeros(len(run.data) + 1, dtype=np.int32)
            for offset in range(span - gram + 1):
                start = run.at - offset
                some = start[(gone >> offset & 1 == 1) & (run.low <= start) & (start < run.high)]
                np.add.at(edges, some, 1)
                np.add.at(edges, some + span, -1)
            covered = np.cumsum(edges[:-1]) > 0
            body = run.data.tobytes()
            columns: dict[str, list] = {name: [] for name in schema.names}
            for name, a, b in zip(row["keys"], run.starts.tolist(), run.ends.tolist()):
                flips = np.flatnonzero(np.diff(covered[a:b], prepend=False, append=False))
                starts, ends = flips[::2], flips[1::2]
                rest = zip([0, *ends.tolist()], [*starts.tolist(), b - a])
                kept = b"".join(body[a + i : a + j] for i, j in rest)
                columns["key"].append(name)
                columns["n_bytes"].append(b - a)
                columns["n_removed"].append(int((ends - starts).sum()))
                columns["n_spans"].append(len(starts))
                columns["kept"].append(kept)
                columns["starts"].append(starts)
                columns["ends"].append(ends)
            yield pa.RecordBatch.from_pydict(columns, schema)

    kinds = "key long, n_bytes long, n_removed long, n_spans long, kept binary, starts array<long>, ends array<long>"
    return runs.mapInArrow(run, kinds)


def cut_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    run_bytes: int = RUN_BYTES,
    bucket_hashes: int = BUCKET_HASHES,
    bucket_suffixes: int = BUCKET_SUFFIXES,
) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes), and the removed spans as ``starts`` and ``ends``."""
    if not 1 <= gram <= span or span > 200 or span - gram > 62:
        raise ValueError("1 <= gram <= span <= 200 and span - gram <= 62 are asked for")
    runs = _runs(df, key, text, run_bytes)
    total = runs.agg(F.sum("n_bytes")).first()[0] or 0
    hashes = _shared_hashes(runs, span, gram, max(1, math.ceil(2 * total / (span - gram + 2) / bucket_hashes)))
    shared = hashes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(shared / bucket_suffixes))
    own = hashes.groupBy("run").agg(F.collect_list("hashes").alias("hashes"))  # no more than its anchors
    marked = runs.drop("n_bytes").join(own.hint("merge"), "run", "left").withColumn("hashes", F.coalesce("hashes", F.array().cast("array<binary>")))
    sets = _decided(marked.where(F.size("hashes") > 0), span, gram, buckets)
    answers = sets.groupBy("run").agg(F.collect_list(F.struct("bucket", "sets")).alias("sets"))
    return _cut(marked.join(answers.hint("merge"), "run", "left"), span, gram, buckets).withColumnRenamed("key", key)

"""Bounded-space online packing of tokenised documents into training sequences.

Each task reads its documents in order and keeps at most ``open_windows`` unfinished windows. Whole windows
are cut off a document first. What is left goes into the open window that it fills best; if it fits into none
and all windows are in use, the fullest is emitted. The windows still open at the end of a task are merged
with those of other tasks, again best-fit and in groups of bounded size. No token sequence is ever sorted or
shuffled for the packing: after the first pass only lengths move.

Defined cases: a null text counts as empty, so its document is the end token alone; repeated rows are
packed as often as they occur; an empty table gives an empty result; a document longer than a window is
cut into pieces. Columns of the input other than key and text are not carried along.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.batches import groups, texts_of
from tabloom.sources.shared import materialize

WINDOW = 1024
OPEN_WINDOWS = 64
#: So many tasks' leftovers meet in one merging task: at most TASKS_MERGED * OPEN_WINDOWS windows.
TASKS_MERGED = 64
END_ID = 0
# Fixed value: how byte-level vocabularies of this family cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteEncoder:
    """Ids of a byte-level vocabulary file of the tokenizers library.

    The merges are run by tiktoken, several times faster and with the same result; the tokenizers library
    encodes one text of every group as well, drawn by their hash, and a difference fails the task. Texts that tiktoken
    can't cut, those with a run of about a million blanks or more, are encoded by the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        special = {token.content: i for i, token in self.exact.get_added_tokens_decoder().items()}
        # The file writes printable bytes as themselves and the others, in order, as characters from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
        ranks = {
            bytes(byte_of[c] for c in token): i for token, i in self.exact.get_vocab(with_added_tokens=False).items()
            if token not in special
        }
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        found, by_fast = [], []
        for i, text in enumerate(texts):
            try:
                ids = self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
                by_fast.append(i)
            except ValueError:  # its regular expressions ran out of stack
                ids = self.by_library(text)
            found.append(ids)
        if by_fast:
            # By a hash of the whole group, so that neither short nor frequent texts are preferred.
            drawn = by_fast[reduce(lambda crc, text: zlib.crc32(text.encode(), crc), texts, 0) % len(by_fast)]
            if self.by_library(texts[drawn]) != found[drawn]:
                raise RuntimeError("tiktoken and the tokenizers library differ")
        return found

    def by_library(self, text: str) -> bytes:
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder per Python worker."""
    return ByteEncoder(path)


class OpenWindows:
    """At most ``limit`` windows, found by the room they have left."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.count = capacity, limit, 0
        self.rooms: list[tuple[int, int]] = []  # (room left, window), ascending

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset) for a piece of ``length``; may forget the fullest window."""
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.limit:
                self.rooms.pop(0)
            room, window = self.capacity, self.fresh()
        if room > length:
            insort(self.rooms, (room - length, window))
        return window, self.capacity - room

    def fresh(self) -> int:
        self.count += 1
        return self.count - 1


PIECES = "start long, length long, ids binary, doc_tokens long, task long, window long, offset long, open boolean"


def fill_windows(
    df: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = END_ID,
) -> DataFrame:
    """First pass: the pieces with their ids and places, by task; ``open`` marks windows to be merged."""
    key_type = df.schema[key].dataType.simpleString()
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, windows = byte_encoder(tokenizer_path), OpenWindows(window, open_windows)
        task = TaskContext.get().partitionId()
        waiting: dict[int, list[tuple]] = {}  # pieces of the open windows

        def rows(pieces: list[tuple], still_open: bool) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*pieces)]
            n = len(pieces)
            arrays = [
                pa.array(columns[0], key_arrow),
                *[pa.array(columns[i], t) for i, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.binary()), (4, pa.int64()))],
                pa.array([task] * n, pa.int64()),
                *[pa.array(columns[i], pa.int64()) for i in (5, 6)],
                pa.array([still_open] * n, pa.bool_()),
            ]
            names = [key, "start", "length", "ids", "doc_tokens", "task", "window", "offset", "open"]
            return pa.RecordBatch.from_arrays(arrays, names)

        key_arrow = None
        for batch in batches:
            key_arrow = batch.schema.field(key).type
            keys, texts = batch.column(key).to_pylist(), texts_of(batch, text)
            for first, last in groups(texts):
                done: list[tuple] = []
                for doc, ids in zip(keys[first:last], encoder.encode(texts[first:last])):
                    ids += end
                    n = len(ids) // 4
                    whole = n - n % window
                    for start in range(0, whole, window):
                        done.append((doc, start, window, ids[4 * start : 4 * (start + window)], n, windows.fresh(), 0))
                    if n > whole:
                        at, offset = windows.place(n - whole)
                        waiting.setdefault(at, []).append((doc, whole, n - whole, ids[4 * whole :], n, at, offset))
                live = {at for _, at in windows.rooms}
                for at in [at for at in waiting if at not in live]:
                    done.extend(waiting.pop(at))
                if done:
                    yield rows(done, False)
        if waiting:
            yield rows(list(chain.from_iterable(waiting.values())), True)

    return df.select(key, text).mapInArrow(pack, f"`{key}` {key_type}, {PIECES}")


def _merge(frame: pd.DataFrame, window: int) -> pd.DataFrame:
    """Best-fit decreasing of the leftover windows of a group of tasks."""
    frame = frame.sort_values(["used", "task", "window"], ascending=[False, True, True], ignore_index=True)
    windows = OpenWindows(window, len(frame) + 1)
    places = [windows.place(int(used)) for used in frame["used"]]
    frame["merged"], frame["base"] = [w for w, _ in places], [offset for _, offset in places]
    return frame[["task", "window", "group", "merged", "base"]]


def merge_leftovers(pieces: DataFrame, window: int = WINDOW, tasks_merged: int = TASKS_MERGED) -> DataFrame:
    """Second pass over a stored table of pieces: ``sequence_id`` and final ``offset`` of each piece.

    Sequence ids are unique but not gapless. The leftovers of a fixed number of tasks meet in one
    merging task; each brings at most its open windows, so the merging task is of bounded size.
    """
    closed, leftover = pieces.where(~F.col("open")), pieces.where("open")
    used = leftover.groupBy("task", "window").agg(F.sum("length").alias("used"))
    groups_ = used.withColumn("group", F.floor(F.col("task") / tasks_merged).cast("long"))
    merged = groups_.groupBy("group").applyInPandas(
        lambda frame: _merge(frame, window), "task long, window long, group long, merged long, base long"
    )
    # Odd ids belong to merged windows, even ones to those that a task has filled.
    closed = closed.withColumn("sequence_id", 2 * (F.shiftleft("task", 32) + F.col("window")))
    joined = leftover.join(merged, ["task", "window"]).withColumns(
        {
            "sequence_id": 2 * (F.shiftleft("group", 32) + F.col("merged")) + 1,
            "offset": F.col("offset") + F.col("base"),
        }
    )
    return closed.drop("task", "window", "open").unionByName(
        joined.drop("task", "window", "open", "group", "merged", "base")
    )


def pack(df: DataFrame, tokenizer_path: str, window: int = WINDOW, **options) -> DataFrame:
    """All pieces with their ids: key, start, length, ids, doc_tokens, offset, sequence_id."""
    return merge_leftovers(materialize(fill_windows(df, tokenizer_path, window=window, **options)), window)

"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Texts are worked on in groups of about this many characters, which bounds a task's memory.
GROUP_CHARS = 1_000_000
#: Entries of a cache of encoded words; it is emptied when full, which only costs time.
CACHE_ENTRIES = 800_000


def groups(texts: list[str], chars: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that hold about ``chars`` characters, at least one text each."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The strings of a column; null counts as empty."""
    return ["" if text is None else text for text in batch.column(column).to_pylist()]

"""Key expressions: null-safe group keys and hashes that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def as_columns(cols: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def group_key(by: Sequence[str]) -> Column:
    """One struct for the grouping columns.

    A struct is never null itself and two structs with null in the same field are equal, so an
    ordinary equi-join on it keeps null keys. The constant field allows an empty ``by``.
    """
    return F.struct(F.lit(0).alias("all_rows"), *[F.col(f"`{name}`") for name in by])


def hash32(key: str | Column | Sequence[str | Column], seed: int | str) -> Column:
    """Number in [0, 2^32) from the MD5 of ``seed:key``: the same on every cluster and engine."""
    parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in as_columns(key)]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")

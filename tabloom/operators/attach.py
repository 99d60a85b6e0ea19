"""Bring one row of values per group back to the rows of that group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DatetimeType,
    DecimalType,
    MapType,
    NumericType,
    StringType,
    StructType,
)

from tabloom.functions.keys import group_key

KEY = "group_key_"
ROWS = "group_rows_"
BROADCAST_BYTES = 8 * 1024 * 1024
HOT_BYTES = 8 * 1024 * 1024
HOT_GROUPS = 1000


def stored_bytes(df: DataFrame, name: str) -> Column:
    """About how many bytes a value takes: 8 for a plain one, the length of its text for any other."""
    kind = df.schema[name].dataType
    if isinstance(kind, (NumericType, BooleanType, DatetimeType)) and not isinstance(kind, DecimalType):
        return F.lit(8).cast("bigint")
    if isinstance(kind, (StringType, BinaryType)):
        text = F.col(name)
    elif isinstance(kind, (ArrayType, MapType, StructType)):
        text = F.to_json(F.struct(name))
    else:
        text = F.col(name).cast("string")
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def attach(
    df: DataFrame, per_group: DataFrame, by: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join of ``df`` with ``per_group`` on the grouping columns; a null key matches null.

    ``per_group`` is a stored table with the key struct ``KEY``, the group's row count ``ROWS``
    and the values to attach. The size of its keys and values is measured, whatever their types. If it is
    small it is broadcast and ``df`` is not shuffled. Otherwise the hot groups, those with more than 1/1000 of
    all rows, are broadcast to their rows, and only the rows of the other groups are shuffled. There are fewer
    than 1000 hot groups; those that don't fit into ``HOT_BYTES`` together are joined by sorting like the others.

    ``df`` is read once, or twice if there are hot groups; store it first if it is costly.
    """
    values = [c for c in per_group.columns if c not in (KEY, ROWS)]
    row_bytes = 16 + sum(stored_bytes(per_group, c) for c in (KEY, *values))
    size = per_group.agg(
        F.sum(row_bytes).alias("bytes"), F.sum(ROWS).alias("rows"), F.max(ROWS).alias("largest")
    ).first()
    keyed = df.withColumn(KEY, group_key(by))
    lookup = per_group.drop(ROWS)
    if (size["bytes"] or 0) <= broadcast_bytes:
        return keyed.join(F.broadcast(lookup), KEY, "left").drop(KEY)

    hot_rows = size["rows"] / HOT_GROUPS
    if size["largest"] <= hot_rows:
        return keyed.join(lookup, KEY, "left").drop(KEY)
    # Of fewer than 1000 groups, the largest as far as they fit.
    sizes = per_group.where(F.col(ROWS) > hot_rows).select(F.col(ROWS).alias("n"), row_bytes.alias("b"))
    room = HOT_BYTES
    for n, width in sorted(((row["n"], row["b"]) for row in sizes.collect()), reverse=True):
        room -= width
        if room < 0:
            hot_rows = max(hot_rows, n)
            break
    hot = per_group.where(F.col(ROWS) > hot_rows).drop(ROWS)
    cold = per_group.where(F.col(ROWS) <= hot_rows).drop(ROWS)
    joined_hot = keyed.join(F.broadcast(hot), KEY)
    others = keyed.join(F.broadcast(hot.select(KEY)), KEY, "left_anti")
    return joined_hot.unionByName(others.join(cold, KEY, "left")).drop(KEY)

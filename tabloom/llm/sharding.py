"""Reproducible shuffle: a keyed Feistel permutation of global row numbers gives shard and slot.

Rows are numbered 0 to n - 1 in the order of their key columns. The number is permuted by a balanced
Feistel network over an a x b grid with a * b >= n; a result outside [0, n) is permuted again (cycle
walking), so the whole is a bijection on [0, n). Shard and slot of any row then follow from its number
alone: ``shard = p mod shards`` and ``slot = p div shards``.

Defined cases: null and equal keys are numbered like any other value (nulls first; rows with equal keys
take neighbouring numbers); an empty table gives an empty result; columns are kept, those named like an
output are replaced, and helper columns carry the prefix ``_sh_``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize

ROUNDS = 4
ROWS_PER_RANGE = 500_000


def numbered(df: DataFrame, order: Sequence[str], into: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with gapless numbers from 0 in the order of ``order``, and the number of rows.

    The rows are sorted into ranges, each range is numbered by its own task, and the few range totals
    are accumulated. Rows that are equal in every sort column are told apart by where they were read,
    so one value on a third of all rows is spread over many ranges.
    """
    spark = df.sparkSession
    df = df.drop(into)
    columns = df.columns
    placed = df.withColumn("_sh_read", F.monotonically_increasing_id())
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / ROWS_PER_RANGE))
    keys = [F.col(c).asc_nulls_first() for c in order] + [F.col("_sh_read")]
    # The upper 31 bits of monotonically_increasing_id are the task, the lower 33 the row in the task.
    stored = materialize(
        placed.repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_sh_at", F.monotonically_increasing_id())
        .drop("_sh_read")
    )
    task = F.shiftright("_sh_at", 33)
    totals = sorted(stored.groupBy(task.alias("task")).count().collect())  # one row per range
    starts, n = [], 0
    for row in totals:
        starts.append((row["task"], n))
        n += row["count"]
    offsets = spark.createDataFrame(starts, "_sh_task long, _sh_start long")
    result = (
        stored.withColumn("_sh_task", task)
        .join(F.broadcast(offsets), "_sh_task")
        .withColumn(into, F.col("_sh_start") + F.col("_sh_at").bitwiseAND((1 << 33) - 1))
    )
    return result.select(*columns, into), n


def grid(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid that holds ``n`` numbers."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _round(right: Column, seed: str, step: int) -> Column:
    """Keyed hash of 52 bits of one half. MD5 has no weak pairs of rounds and is the same everywhere."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{step}:"), right.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def _permute(value: Column, a: int, b: int, seed: str) -> Column:
    """One pass of the network over [0, a * b): the halves are added to in turn, modulo their side."""

    def step(i: int, state: Column) -> Column:
        left, right = state["left"], state["right"]
        if i % 2 == 0:
            left = (left + _round(right, seed, i)) % a
        else:
            right = (right + _round(left, seed, i)) % b
        return F.struct(left.alias("left"), right.alias("right"))

    # transform() over an array of one binds the state, so no round is computed twice.
    state = F.array(F.struct((value % a).alias("left"), F.floor(value / F.lit(a)).cast("long").alias("right")))
    for i in range(ROUNDS):
        state = F.transform(state, partial(step, i))
    return F.transform(state, lambda s: s["left"] + s["right"] * a)[0]


def longest_walk(spark: SparkSession, n: int, seed: str) -> int:
    """How often the network must at most be applied until every number has come back into [0, n).

    Only numbers outside [0, n) continue a walk. There are about sqrt(n) of them at most, and they are
    followed as a Spark range. Walks enter from inside, so they start where no outside number leads.
    """
    a, b = grid(n)
    if a * b == n:
        return 1
    onward = _permute(F.col("v"), a, b, seed).alias("v")
    outside = spark.range(n, a * b).select(F.col("id").alias("v"))
    walking, steps = materialize(outside.join(outside.select(onward), "v", "left_anti")), 1
    while walking.head():
        steps += 1
        walking = materialize(walking.select(onward).where(F.col("v") >= n))
    return steps


def permuted(spark: SparkSession, number: Column, n: int, seed: str) -> Column:
    """The place of row ``number`` in the shuffle of ``n`` rows."""
    a, b = grid(n)
    place = F.array(_permute(number, a, b, seed))
    for _ in range(longest_walk(spark, n, seed) - 1):
        place = F.transform(place, lambda v: F.when(v < n, v).otherwise(_permute(v, a, b, seed)))
    return place[0]


def shard(df: DataFrame, order: Sequence[str], shards: int, seed: str = "0") -> DataFrame:
    """``df`` with ``row_number``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in the shard).

    Shard sizes differ by one row at most. The same rows, seed and shard count give the same result on
    every cluster; ``order`` should identify a row.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    rows, n = numbered(df, order)
    place = rows.withColumn("_sh_place", permuted(df.sparkSession, F.col("row_number"), n, seed))
    return place.withColumns(
        {
            "shard": (F.col("_sh_place") % shards).cast("int"),
            "slot": F.floor(F.col("_sh_place") / F.lit(shards)).cast("long"),
        }
    ).drop("_sh_place")

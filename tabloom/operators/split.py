"""Train/test parts and folds."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.keys import HASH_RANGE, hash32

Key = str | Column | Sequence[str | Column]


def part_number(weights: Sequence[float], seed: int, key: Key) -> Column:
    """Number of the part that a key falls in; part sizes follow the weights."""
    if any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError(f"weights must not be negative nor all zero: {list(weights)}")
    total = sum(weights)
    ends = [int(HASH_RANGE * end / total) for end in accumulate(weights)]
    point = hash32(key, seed)
    number = F.lit(len(weights) - 1)
    for i in range(len(weights) - 2, -1, -1):
        number = F.when(point < ends[i], i).otherwise(number)
    return number


def hash_split(df: DataFrame, weights: Sequence[float], seed: int, key: Key) -> list[DataFrame]:
    """Split by the hash of ``key``: the same rows on any partitioning, and no shuffle."""
    number = part_number(weights, seed, key)
    return [df.where(number == i) for i in range(len(weights))]


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own split. Which rows go where depends on the partitioning of ``df``."""
    return df.randomSplit(list(weights), seed=seed)


def fold_number(folds: int, seed: int, key: Key) -> Column:
    """Fold in [0, folds) as int. It draws from another hash than the split does."""
    return F.pmod(hash32(key, f"fold {seed}"), F.lit(folds)).cast("int")

"""Running counts and exact quantiles over an ordered column, without a one-task window.

An ordinary running window puts a whole group, or the whole table, into one task. Here the rows are
sorted into ranges of group and value, as many as their number asks for, and stored with the number of their
range. Each range is summed up by group, these sums are accumulated within each group, and the running counts are
then taken inside each range on top of its offset. Where a range begins only decides which task does which
rows; the counts are exact wherever it does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.keys import group_key
from tabloom.operators.attach import KEY
from tabloom.sources.shared import materialize

RANGE = "value_range_"


def _ranged(counts: DataFrame, value: str, rows_per_range: int) -> tuple[DataFrame, bool]:
    """``counts`` with the number of the range that a row is in; ranges are in the order of group and value."""
    ranges = math.ceil(counts.count() / rows_per_range)
    if ranges <= 1:
        return counts.withColumn(RANGE, F.lit(0)), False
    dealt = counts.repartitionByRange(ranges, KEY, value).withColumn(RANGE, F.spark_partition_id())
    return materialize(dealt), True


def running_counts(
    counts: DataFrame,
    value: str,
    amounts: Sequence[str],
    ascending: bool = True,
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """Add ``before_x`` and ``total_x`` for every count column ``x`` in ``amounts``.

    ``counts`` is a stored table with one row per group key struct ``KEY`` and ``value``.
    ``before_x`` is the sum of ``x`` over the values ahead of this one in its group, ``total_x``
    the sum over the group.
    """
    ranged, several = _ranged(counts, value, rows_per_range)

    def order(name):
        return F.col(name).asc() if ascending else F.col(name).desc()

    ahead = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(KEY, RANGE).orderBy(order(value)).rowsBetween(*ahead)
    before = {a: F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in amounts}
    if not several:
        group = Window.partitionBy(KEY, RANGE)
        return ranged.select(
            KEY,
            value,
            *amounts,
            *[before[a].alias(f"before_{a}") for a in amounts],
            *[F.sum(a).over(group).alias(f"total_{a}") for a in amounts],
        )

    cells = ranged.groupBy(KEY, RANGE).agg(*[F.sum(a).alias(a) for a in amounts])
    group = Window.partitionBy(KEY)
    across = group.orderBy(order(RANGE)).rowsBetween(*ahead)
    offsets = cells.select(
        KEY,
        RANGE,
        *[F.coalesce(F.sum(a).over(across), F.lit(0)).alias(f"offset_{a}") for a in amounts],
        *[F.sum(a).over(group).alias(f"total_{a}") for a in amounts],
    )
    return ranged.join(offsets, [KEY, RANGE]).select(
        KEY,
        value,
        *amounts,
        *[(before[a] + F.col(f"offset_{a}")).alias(f"before_{a}") for a in amounts],
        *[f"total_{a}" for a in amounts],
    )


def grouped_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str] | None = None,
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """Exact quantiles of ``value`` per group, with linear interpolation between two values.

    Null values do not count. The result has the key struct ``KEY``, the grouping columns, the
    number of values ``n`` and one column per probability.
    """
    counts = materialize(
        df.where(F.col(value).isNotNull())
        .groupBy(group_key(by).alias(KEY), F.col(value).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    return quantiles_of_counts(counts, by, probabilities, names, rows_per_range)


def quantiles_of_counts(
    counts: DataFrame,
    by: Sequence[str],
    probabilities: Sequence[float],
    names: Sequence[str] | None = None,
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """``grouped_quantiles`` from a stored table of ``KEY``, a ``value`` that isn't null, and ``n``, how often it occurs."""
    names = list(names) if names else [f"q{i}" for i in range(len(probabilities))]
    ranked = running_counts(counts, "value", ["n"], rows_per_range=rows_per_range)

    def value_at(index):
        here = (F.col("before_n") <= index) & (index < F.col("before_n") + F.col("n"))
        return F.max(F.when(here, F.col("value")))

    picks = []
    for i, q in enumerate(probabilities):
        position = F.lit(float(q)) * (F.col("total_n") - 1)
        picks += [
            value_at(F.floor(position)).alias(f"low_{i}"),
            value_at(F.ceil(position)).alias(f"high_{i}"),
        ]
    picked = ranked.groupBy(KEY).agg(F.max("total_n").alias("n"), *picks)
    results = []
    for i, (q, name) in enumerate(zip(probabilities, names)):
        position = F.lit(float(q)) * (F.col("n") - 1)
        share = position - F.floor(position)
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        results.append(F.when(low == high, low).otherwise(low + (high - low) * share).alias(name))
    return picked.select(KEY, *[F.col(KEY)[c].alias(c) for c in by], "n", *results)


def sketched_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str] | None = None,
    rank_error: float = 1e-4,
) -> DataFrame:
    """Quantiles in one aggregate whose memory doesn't grow with the rows: a mergeable sketch for each group.

    Each result is a value of the group whose rank is off by at most ``rank_error`` of the group's rows. The smallest
    and the largest value are exact. Same columns as ``grouped_quantiles``, without interpolation between two values.
    """
    if not 0 < rank_error < 1:
        raise ValueError("rank_error is a share of rows between 0 and 1")
    names = list(names) if names else [f"q{i}" for i in range(len(probabilities))]
    number = F.col(value).cast("double")
    sketch = F.percentile_approx(number, [float(q) for q in probabilities], math.ceil(1 / rank_error))
    found = (
        df.where(F.col(value).isNotNull())
        .groupBy(group_key(by).alias(KEY))
        .agg(F.count("*").alias("n"), sketch.alias("found"), F.min(number).alias("least"), F.max(number).alias("most"))
    )
    ends = {0.0: F.col("least"), 1.0: F.col("most")}
    values = [ends.get(float(q), F.col("found")[i]).alias(name) for i, (q, name) in enumerate(zip(probabilities, names))]
    return found.select(KEY, *[F.col(KEY)[c].alias(c) for c in by], "n", *values)

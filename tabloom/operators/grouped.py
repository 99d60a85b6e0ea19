"""Per-group scaling, imputation and pandas functions that hold up when one group is huge."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import islice
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegralType, StructType

from tabloom.functions.keys import group_key
from tabloom.operators.attach import BROADCAST_BYTES, KEY, ROWS, attach
from tabloom.operators.group_forest import fill_by_group_forests
from tabloom.operators.ranks import quantiles_of_counts
from tabloom.sources.shared import materialize, new_path, spread, training_table

FILL = "fill_"
GROUP = "group_number_"
FIRST = "first_of_group_"
#: Rows of a group that a pandas function gets in a frame, and of results that go back at a time, about.
FRAME_ROWS = 10_000
WEIGHT = "weight_"
#: Forests without resampling are fitted on counted rows beyond this many rows, if there are at most half as many different ones.
COUNTED_FROM = 50_000


def known_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with NaN in floating-point columns of ``cols`` as null: both are missing values."""
    floating = [c for c in cols if isinstance(df.schema[c].dataType, (FloatType, DoubleType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating}) if floating else df


def missing_split(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose target is known, and rows whose target is missing: null, or NaN in a floating type."""
    known, missing = F.col(target).isNotNull(), F.col(target).isNull()
    if isinstance(df.schema[target].dataType, (FloatType, DoubleType)):
        known, missing = known & ~F.isnan(target), missing | F.isnan(target)
    return df.where(known), df.where(missing)


def per_group(df: DataFrame, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Stored table of aggregates per group, in the form that ``attach`` takes."""
    aggregates = [column.alias(name) for name, column in values.items()]
    return materialize(
        df.groupBy(group_key(by).alias(KEY)).agg(F.count("*").alias(ROWS), *aggregates)
    )


def grouped_standardize(
    df: DataFrame,
    by: Sequence[str],
    cols: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Centre and scale ``cols`` inside each group with the population standard deviation.

    A zero deviation counts as 1. Nulls and NaN are left out of the statistics and stay as they are.
    """
    cols, by = list(cols), list(by)
    statistics = {}
    for i, c in enumerate(cols):
        statistics[f"mean_{i}_"] = F.avg(c)
        statistics[f"std_{i}_"] = F.stddev_pop(c)
    joined = attach(df, per_group(known_values(df, cols), by, statistics), by, broadcast_bytes)
    scaled = {}
    for i, c in enumerate(cols):
        deviation = F.when(F.col(f"std_{i}_") == 0, 1.0).otherwise(F.col(f"std_{i}_"))
        scaled[c] = ((F.col(c) - F.col(f"mean_{i}_")) / deviation).alias(c)
    return joined.select(*[scaled.get(c, F.col(c)) for c in df.columns])


def grouped_map(
    df: DataFrame,
    by: Sequence[str],
    fn: Callable,
    schema: StructType | str,
    statistics: Mapping[str, Column] | None = None,
    order: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Apply a pandas function group by group; result columns match ``schema`` by name.

    With ``statistics`` (a name and an aggregate for each) Spark computes these per group, and
    ``fn`` gets batches of rows in which every row carries the statistics of its own group. Rows
    are not shuffled for small statistics, and a group of any size is spread over all tasks.

    Without them ``fn`` gets an iterator over the frames of one group, in the order of ``order``, and
    returns frames one by one. A group is one task's work, but never held in memory as a whole.
    """
    by = list(by)
    if statistics is None:
        return _map_whole_groups(df, by, fn, schema, order)

    if isinstance(schema, StructType):
        names = schema.names
    else:
        names = StructType.fromDDL(schema).names
    joined = attach(df, per_group(df, by, statistics), by, broadcast_bytes)

    def apply(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)[names]

    return joined.mapInPandas(apply, schema)


def _map_whole_groups(df, by, fn, schema, order):
    """Rows come sorted, the first of each group marked, and a task's groups are cut out of batches that hold many."""
    # A null would turn a batch's whole numbers and flags into other types for all of its groups, so it is sent apart.
    apart = [f for f in df.schema if f.nullable and isinstance(f.dataType, (IntegralType, BooleanType))]
    nulls = {f.name: f"null_{i}_" for i, f in enumerate(apart)}
    zeros = {f.name: F.coalesce(f"`{f.name}`", F.lit(0).cast(f.dataType)) for f in apart}
    of_group = Window.partitionBy(*[f"`{c}`" for c in by]).orderBy(*(order or [F.lit(0)]))
    marked = df.withColumn(FIRST, F.row_number().over(of_group) == 1)
    marked = marked.withColumns({flag: F.col(f"`{name}`").isNull() for name, flag in nulls.items()}).withColumns(zeros)
    columns = df.columns

    def pieces(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[bool, pd.DataFrame]]:
        for batch in batches:
            starts = batch[FIRST].to_numpy()
            cuts = [0, *(np.flatnonzero(starts[1:]) + 1).tolist(), len(batch)] if len(batch) else []
            for start, end in zip(cuts, cuts[1:]):
                yield bool(starts[start]), batch.iloc[start:end]

    def whole(held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
        frame = rows[columns]
        for name, flag in nulls.items():
            missing = rows[flag].to_numpy()
            if missing.any():
                kind = object if frame[name].dtype == bool else np.float64
                frame = frame.assign(**{name: frame[name].astype(kind).mask(missing, None if kind is object else np.nan)})
        return frame

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = pieces(batches)
        piece = next(left, None)

        def frames() -> Iterator[pd.DataFrame]:
            nonlocal piece
            held, rows = [piece[1]], len(piece[1])
            while (piece := next(left, None)) is not None and not piece[0]:
                if rows >= FRAME_ROWS:
                    yield whole(held)
                    held, rows = [], 0
                held.append(piece[1])
                rows += len(piece[1])
            yield whole(held)

        # Small results go back together, if of the same types.
        made, rows, kinds = [], 0, None
        while piece is not None:
            group = frames()
            for result in fn(group):
                found = (tuple(result.columns), tuple(result.dtypes))
                if made and (found != kinds or rows >= FRAME_ROWS):
                    yield pd.concat(made, ignore_index=True)
                    made, rows = [], 0
                if len(result):
                    made.append(result)
                    rows, kinds = rows + len(result), found
            for _ in group:  # what the function has not read
                pass
        if made:
            yield pd.concat(made, ignore_index=True)

    return marked.mapInPandas(run, schema)


def grouped_reduce(
    df: DataFrame,
    by: Sequence[str],
    state: StructType | str,
    summarize: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    finish: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    schema: StructType | str | None = None,
    rows_per_state: int = 10_000,
) -> DataFrame:
    """A pandas function of whole groups in two stages, for groups of any size.

    ``summarize`` turns rows of one group into a state (rows with the columns ``state``), ``merge`` turns several
    states into one, and ``finish`` the last state into the result with the columns ``schema``. All must not
    depend on the order of rows. Rows are summarized where they are, a batch at a time, so neither does a hot group
    meet in one task nor are rows shuffled. Its states are merged in rounds, ``rows_per_state`` rows of states at a time
    at most, until every group has one. Grouping columns come first in the result; null keys are groups like any others.
    """
    by = list(by)
    keys = [df.schema[c] for c in by]
    kind = StructType.fromDDL(state) if isinstance(state, str) else state
    stored = StructType([*keys, *kind.fields])

    def reduced(function):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for _, group in frame.groupby(by, dropna=False, sort=False) if by else [((), frame)]:
                    made = function(group)
                    head = {c: [group[c].iat[0]] * len(made) for c in by}
                    yield pd.DataFrame(head | {f.name: made[f.name].to_numpy() for f in kind.fields})

        return run

    states = materialize(df.mapInPandas(reduced(summarize), stored))
    part, before = "part_", math.inf
    while True:
        counts = states.groupBy(group_key(by).alias(KEY)).agg(F.count("*").alias(ROWS))
        largest = counts.agg(F.max(ROWS)).first()[0] or 0
        if largest > rows_per_state and largest >= before:
            raise ValueError("merging does not make the states of a group fewer")
        before = largest
        rounds_left = largest > rows_per_state
        # States of a group are dealt to as many tasks as they need; the last round has one task a group.
        dealt = F.pmod(F.monotonically_increasing_id(), F.lit(math.ceil(largest / rows_per_state) if rounds_left else 1))
        numbered = materialize(states.withColumn(part, dealt)) if rounds_left else states.withColumn(part, F.lit(0).cast("long"))

        def merged(frame: pd.DataFrame) -> pd.DataFrame:
            made = merge(frame.drop(columns=[part]))
            head = {c: [frame[c].iat[0]] * len(made) for c in by}
            return pd.DataFrame(head | {f.name: made[f.name].to_numpy() for f in kind.fields})

        merged_states = materialize(numbered.groupBy(*by, part).applyInPandas(merged, stored))
        if not rounds_left:
            break
        states = merged_states
    if finish is None:
        return merged_states
    last = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def finished(frame: pd.DataFrame) -> pd.DataFrame:
        made = finish(frame)
        head = {c: [frame[c].iat[0]] * len(made) for c in by}
        return pd.DataFrame(head | {f.name: made[f.name].to_numpy() for f in last.fields})

    return merged_states.groupBy(*by).applyInPandas(finished, StructType([*keys, *last.fields]))


def _fill(df: DataFrame, target: str) -> DataFrame:
    filled = F.coalesce(F.col(target), F.col(FILL)).alias(target)
    return df.select(*[filled if c == target else F.col(c) for c in df.columns if c != FILL])


def _impute_mean(df, by, target, broadcast_bytes):
    groups = per_group(df, by, {"sum_": F.sum(target), "known_": F.count(target)})
    whole = groups.agg(F.sum("sum_") / F.nullif(F.sum("known_"), F.lit(0))).first()[0]
    groups = groups.select(
        KEY, ROWS, F.coalesce(F.col("sum_") / F.col("known_"), F.lit(whole)).alias(FILL)
    )
    return _fill(attach(df, groups, by, broadcast_bytes), target)


def _impute_median(df, by, target, broadcast_bytes):
    # One scan of the rows; everything else comes from the counts of equal values, null among them.
    counts = materialize(
        df.groupBy(group_key(by).alias(KEY), F.col(target).alias("value")).agg(F.count("*").alias("n"))
    )
    known = counts.where("value IS NOT NULL")
    medians = quantiles_of_counts(known, by, [0.5], [FILL]).select(KEY, FILL)
    groups = counts.groupBy(KEY).agg(F.sum("n").alias(ROWS))
    groups = materialize(groups.join(medians, KEY, "left"))
    whole = None
    if not groups.where(F.col(FILL).isNull()).isEmpty():
        values = known.groupBy(group_key([]).alias(KEY), "value").agg(F.sum("n").alias("n"))
        row = quantiles_of_counts(materialize(values), [], [0.5], [FILL]).first()
        whole = row[FILL] if row else None
    groups = groups.select(KEY, ROWS, F.coalesce(FILL, F.lit(whole)).alias(FILL))
    return _fill(attach(df, groups, by, broadcast_bytes), target)


def _forest(features, target, seed, trees, depth, bootstrap, subset):
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_")
    forest = RandomForestRegressor(
        featuresCol="features_",
        labelCol=target,
        predictionCol=FILL,
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy=subset,
        bootstrap=bootstrap,
        seed=seed,
    )
    return assembler, forest


def _counted(rows: DataFrame, known: int, bootstrap: bool) -> DataFrame | None:
    """The different rows with their number as ``WEIGHT``, which give the same trees, if they are much fewer."""
    if bootstrap or known <= COUNTED_FROM:
        return None
    counted = materialize(rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias(WEIGHT)))
    return counted if 2 * counted.count() <= known else None


def _impute_forest(df, by, target, features, forest_options, parallelism, broadcast_bytes):
    spark = df.sparkSession
    groups = per_group(df, by, {"known_": F.count(target), "sum_": F.sum(target)})
    groups = materialize(groups.withColumn(GROUP, F.monotonically_increasing_id()))
    whole = groups.agg(F.sum("known_").alias("known"), F.sum("sum_").alias("sum")).first()
    if not whole["known"]:
        return df
    # Known rows go straight to the result. Apart by group are stored only what a fit reads, features and
    # target of known rows of groups in which something is missing, and the rows to be filled.
    lookup = groups.select(KEY, ROWS, GROUP, (F.col("known_") < F.col(ROWS)).alias("gaps_"), "known_")
    numbered = attach(df, lookup, by, broadcast_bytes)
    known, missing = missing_split(numbered, target)
    rows = known.where("gaps_").select(*features, target, GROUP)
    used = groups.where(f"known_ < {ROWS}").agg(F.sum("known_")).first()[0] or 0
    counted = _counted(rows, used, forest_options["bootstrap"])
    train = materialize(rows if counted is None else counted, partition_by=GROUP)
    to_fill = materialize(missing.where("known_ > 0").drop("gaps_", "known_"), partition_by=GROUP)
    assembler, forest = _forest(features, target, **forest_options)
    if counted is not None:
        forest.setWeightCol(WEIGHT)
    filled = new_path(spark)
    kinds = df.select(*df.columns).schema

    def fill(group):
        rows = train.where(F.col(GROUP) == group[GROUP]).drop(GROUP)
        model = forest.fit(assembler.transform(spread(rows, group["known_"] if counted is None else rows.count())))
        found = model.transform(assembler.transform(to_fill.where(F.col(GROUP) == group[GROUP])))
        found.withColumn(target, F.col(FILL)).select(*df.columns).write.parquet(f"{filled}/group={group[GROUP]}")

    # Groups are read from the stored table a few at a time; each writes its own folder, so a lost
    # driver loses no more than the fits under way, and the plan of the result does not grow.
    pending = groups.where(f"known_ > 0 AND known_ < {ROWS}").select(GROUP, "known_").toLocalIterator()
    with ThreadPool(max(1, parallelism)) as pool:
        work = inheritable_thread_target(spark)(fill)
        while batch := list(islice(pending, parallelism)):
            pool.map(work, batch)
    unknown = missing.where("known_ = 0").withColumn(target, F.lit(whole["sum"] / whole["known"]))
    result = known.select(*df.columns).unionByName(unknown.select(*df.columns))
    if to_fill.isEmpty():
        return result
    return result.unionByName(spark.read.schema(kinds).parquet(f"{filled}/group=*").select(*df.columns))


def _impute_pooled(df, by, target, features, forest_options, broadcast_bytes):
    groups = per_group(df, by, {"sum_": F.sum(target), "known_": F.count(target)})
    whole = groups.agg(F.sum("sum_").alias("sum"), F.sum("known_").alias("known")).first()
    if not whole["known"]:
        return df
    mean = F.lit(whole["sum"] / whole["known"])
    level = F.coalesce(F.col("sum_") / F.col("known_"), mean).alias("group_level_")
    known, missing = missing_split(attach(df, groups.select(KEY, ROWS, level), by, broadcast_bytes), target)
    inputs = [*features, "group_level_"]
    assembler, forest = _forest(inputs, target, **forest_options)
    rows = known.select(*inputs, target)
    counted = _counted(rows, whole["known"], forest_options["bootstrap"])
    if counted is not None:
        forest.setWeightCol(WEIGHT)
    train = training_table(rows) if counted is None else spread(counted, counted.count())
    model = forest.fit(assembler.transform(train))
    predicted = model.transform(assembler.transform(missing)).withColumn(target, F.col(FILL))
    return known.select(*df.columns).unionByName(predicted.select(*df.columns))


def grouped_impute(
    df: DataFrame,
    by: Sequence[str],
    target: str,
    features: Sequence[str] = (),
    strategy: str = "forest",
    seed: int = 1,
    trees: int = 100,
    depth: int = 10,
    bootstrap: bool = False,
    subset: str = "onethird",
    parallelism: int = 4,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fill a missing target (null or NaN) per group. Known values and the row count do not change.

    The target becomes a double, whatever the strategy.

    ``forest`` fits one random forest per group on the rows whose target is known and predicts
    the others; each fit is spread over the cluster, ``parallelism`` groups at a time, however many
    groups there are. Trees differ by the features tried at each split (``subset``); with
    ``bootstrap`` by resampled rows as well, in groups of any size.
    ``level_forest`` grows the forests of all groups together, a level at a time, in a number of jobs that does not
    depend on the number of groups: the one to take for more than some dozens. It cuts features at quantiles of their
    group and has no ``bootstrap``.
    ``pooled_forest`` is one forest for all rows, in which the group is present as the mean of its
    known targets; it takes one fit instead of one per group. ``mean`` and ``median`` need no features.
    A group without a known target gets the mean (or median) of all known targets.
    """
    by, features = list(by), list(features)
    df = known_values(df.withColumn(target, F.col(target).cast("double")), [target])
    if strategy == "mean":
        return _impute_mean(df, by, target, broadcast_bytes)
    if strategy == "median":
        return _impute_median(df, by, target, broadcast_bytes)
    if strategy not in ("forest", "level_forest", "pooled_forest"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if not features:
        raise ValueError(f"the strategy {strategy} needs features")
    if strategy == "level_forest":
        if bootstrap:
            raise ValueError("a level_forest does not resample rows")
        return fill_by_group_forests(
            df, by, target, features, seed, trees, depth, subset, broadcast_bytes=broadcast_bytes
        )
    options = {"seed": seed, "trees": trees, "depth": depth, "bootstrap": bootstrap, "subset": subset}
    if strategy == "forest":
        return _impute_forest(df, by, target, features, options, parallelism, broadcast_bytes)
    return _impute_pooled(df, by, target, features, options, broadcast_bytes)

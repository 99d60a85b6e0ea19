"""Forests for any number of groups in one set of jobs.

All trees of all groups grow a level at a time. One aggregate counts the histogram of every (group, node, feature,
bin), one more picks the splits, one join sends the rows to their children: some ten jobs a level, for one group or
a million.

* Rows with equal bins behave alike in every tree, so they are counted into cells first (map-side combine). A hot
  group becomes at most as many cells as it has different rows.
* Trees of a group that have split alike so far share a node: it is counted once and holds the list of its trees.
  Only the choice of a split, which depends on the features a tree tries there, is made for each tree.
* The cells to be predicted travel down with the known ones, so no trees are stored or sent about. Nodes that no such
  cell reaches are not split further, which changes no prediction.
* Splits go back to the cells by ``attach``, which spreads the cells of a hot node.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.keys import group_key
from tabloom.operators.attach import BROADCAST_BYTES, KEY, ROWS, attach
from tabloom.sources.shared import materialize

GROUP = "group_number_"
NODE = "node_"
BINS = "bins_"
CUT_ACCURACY = 1000


def tried_features(subset: str, features: int) -> int:
    """How many features a tree tries at a split."""
    counts = {
        "all": features,
        "onethird": math.ceil(features / 3),
        "sqrt": math.ceil(math.sqrt(features)),
        "log2": max(1, math.ceil(math.log2(features))),
    }
    if subset not in counts:
        raise ValueError(f"unknown subset {subset!r}, known are {sorted(counts)}")
    return counts[subset]


def plain(name: str) -> Column:
    """A feature as a double in which NaN is null, like any missing value."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None))


def cut_points(feature: str, target: str, bins: int) -> Column:
    """Aggregate of a group: up to ``bins`` values of the feature in its known rows, the smallest among them.

    A value that ``1 / bins`` of the rows have is always among them, so every value of a group of up to
    ``bins`` known rows is, and both values of a flag are told apart.
    """
    known = F.when(F.col(target).isNotNull(), plain(feature))
    shares = [i / bins for i in range(bins)]
    points = F.percentile_approx(known, shares, max(CUT_ACCURACY, 4 * bins))
    return F.array_distinct(F.coalesce(points, F.array().cast("array<double>")))


def bin_numbers(features: Sequence[str], cuts: Sequence[str]) -> Column:
    """One number per feature: how many cut points lie below the value; -1 if it is missing."""

    def number(feature, points):
        value = plain(feature)
        below = F.size(F.filter(F.col(points), lambda point: point < value))
        return F.when(value.isNull(), -1).otherwise(below)

    return F.array(*[number(f, c).cast("int") for f, c in zip(features, cuts, strict=True)])


def _candidates(members: DataFrame) -> DataFrame:
    """Per node its number of cells and the best split of every feature, the best feature first."""
    histogram = (
        members.select(GROUP, NODE, "n", "total", "gaps", F.posexplode(BINS).alias("f", "b"))
        .groupBy(GROUP, NODE, "f", "b")
        .agg(*[F.sum(c).alias(c) for c in ("n", "total", "gaps")], F.count("*").alias("cells"))
    )
    whole = Window.partitionBy(GROUP, NODE, "f")
    upto = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sides = histogram.select(
        GROUP,
        NODE,
        "f",
        "b",
        F.sum("cells").over(whole).alias("cells"),
        *[F.sum(c).over(upto).alias(f"left_{c}") for c in ("n", "total", "gaps")],
        *[(F.sum(c).over(whole) - F.sum(c).over(upto)).alias(f"right_{c}") for c in ("n", "total", "gaps")],
    )
    left = F.col("left_total") / F.nullif(F.col("left_n"), F.lit(0))
    right = F.col("right_total") / F.nullif(F.col("right_n"), F.lit(0))
    apart = F.abs(left - right) > 1e-12 * (F.abs(left) + F.abs(right))
    gain = F.col("left_n") * F.col("right_n") / (F.col("left_n") + F.col("right_n")) * (left - right) * (left - right)
    split = F.struct(
        gain.alias("gain"),
        (-F.col("f")).alias("minus_f"),
        (-F.col("b")).alias("minus_b"),
        *[f"{side}_{c}" for side in ("left", "right") for c in ("n", "total", "gaps")],
    )
    best = sides.groupBy(GROUP, NODE, "f").agg(
        F.max(F.when(apart, split)).alias("split"), F.max("cells").alias("cells")
    )
    return best.groupBy(GROUP, NODE).agg(
        F.sort_array(F.collect_list("split"), asc=False).alias("splits"), F.max("cells").alias(ROWS)
    )


def _choices(nodes: DataFrame, candidates: DataFrame, features: int, tried: int, seed: int) -> DataFrame:
    """Per node and split chosen there: the trees that choose it. The split is null where trees end."""
    found = nodes.join(candidates, [GROUP, NODE])
    if tried == features:
        return found.select(GROUP, NODE, "mean", ROWS, "trees", F.get("splits", F.lit(0)).alias("split"))
    draws = F.array_sort(
        F.array(
            *[
                F.struct(F.xxhash64(F.lit(seed), "tree", NODE, F.lit(f)).alias("draw"), F.lit(-f).alias("minus_f"))
                for f in range(features)
            ]
        )
    )
    return (
        found.withColumn("tree", F.explode("trees"))
        .withColumn("tries", F.slice(draws, 1, tried)["minus_f"])
        .withColumn(
            "split", F.get(F.filter("splits", lambda s: F.array_contains(F.col("tries"), s["minus_f"])), F.lit(0))
        )
        .groupBy(GROUP, NODE, "mean", ROWS, "split")
        .agg(F.sort_array(F.collect_list("tree")).alias("trees"))
    )


def _child(node: Column, f: Column, b: Column, left: Column) -> Column:
    return F.xxhash64(node, f, b, left)


def _children(choices: DataFrame) -> DataFrame:
    """The nodes of the next level that a cell to be predicted reaches."""
    split = choices.where("split IS NOT NULL")
    f, b = -F.col("split.minus_f"), -F.col("split.minus_b")

    def side(name, left):
        return split.where(F.col(f"split.{name}_gaps") > 0).select(
            GROUP,
            _child(F.col(NODE), f, b, F.lit(left)).alias(NODE),
            (F.col(f"split.{name}_total") / F.col(f"split.{name}_n")).alias("mean"),
            "trees",
        )

    return side("left", True).unionByName(side("right", False))


def _routed(members: DataFrame, choices: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Every cell once for each choice of its node: in the child it goes to, or with the mean where trees end."""
    way = F.struct(
        (-F.col("split.minus_f")).alias("f"),
        (-F.col("split.minus_b")).alias("b"),
        (F.col("split.left_gaps") > 0).alias("left_open"),
        (F.col("split.right_gaps") > 0).alias("right_open"),
        F.size("trees").alias("weight"),
        F.col("mean").alias("mean"),
    )
    ways = materialize(
        choices.groupBy(group_key([GROUP, NODE]).alias(KEY)).agg(
            F.max(ROWS).alias(ROWS), F.collect_list(way).alias("ways")
        )
    )
    sent = attach(members, ways, [GROUP, NODE], broadcast_bytes)
    sent = sent.select(GROUP, NODE, BINS, "n", "total", "gaps", F.explode("ways").alias("way"))
    ends = F.col("way.f").isNull()
    left = F.get(BINS, F.coalesce("way.f", F.lit(0))) <= F.col("way.b")
    wanted = F.when(ends, F.col("gaps") > 0).when(left, F.col("way.left_open")).otherwise(F.col("way.right_open"))
    child = _child(F.col(NODE), F.col("way.f"), F.col("way.b"), left)
    return materialize(
        sent.where(wanted).select(
            GROUP,
            F.when(~ends, child).alias(NODE),
            BINS,
            "n",
            "total",
            "gaps",
            F.when(ends, F.col("way.mean") * F.col("way.weight")).alias("share"),
        )
    )


def predict_cells(
    cells: DataFrame,
    features: int,
    trees: int,
    depth: int,
    subset: str,
    seed: int,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mean prediction of all trees for every cell with ``gaps``: ``GROUP``, ``BINS`` and ``prediction``.

    ``cells`` is a stored table with one row per group and bins: ``n`` known rows, ``total`` of their targets, and
    ``gaps`` rows to be predicted. Every group has a known row and a gap. A split has the largest
    decrease of the squared error, then the first feature, then the lowest cut.
    """
    tried = tried_features(subset, features)
    members = cells.withColumn(NODE, F.lit(0).cast("bigint"))
    nodes = materialize(
        cells.groupBy(GROUP)
        .agg((F.sum("total") / F.sum("n")).alias("mean"))
        .select(GROUP, F.lit(0).cast("bigint").alias(NODE), "mean", F.sequence(F.lit(0), F.lit(trees - 1)).alias("trees"))
    )
    ended = []
    for level in range(depth + 1):
        if level < depth:
            choices = _choices(nodes, _candidates(members), features, tried, seed)
        else:
            sizes = members.groupBy(GROUP, NODE).agg(F.count("*").alias(ROWS))
            nothing = F.lit(None).cast(split_type)
            choices = nodes.join(sizes, [GROUP, NODE]).withColumn("split", nothing)
        choices = materialize(choices)
        split_type = choices.schema["split"].dataType
        routed = _routed(members, choices, broadcast_bytes)
        ended.append(routed.where(F.col(NODE).isNull()).select(GROUP, BINS, "share"))
        nodes = materialize(_children(choices))
        if nodes.isEmpty():
            break
        members = routed.where(F.col(NODE).isNotNull()).drop("share")
    shares = reduce(DataFrame.unionByName, ended)
    return materialize(shares.groupBy(GROUP, BINS).agg((F.sum("share") / trees).alias("prediction")))


def fill_by_group_forests(
    df: DataFrame,
    by: Sequence[str],
    target: str,
    features: Sequence[str],
    seed: int,
    trees: int,
    depth: int,
    subset: str,
    bins: int = 32,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with each null target filled by a forest of its own group, with the mean of all in a group without known one.

    ``target`` is a double in which only null is missing. Features are cut at quantiles of their group. A missing
    feature lies below every value. Clashing names: columns of ``df`` may not be called like the constants of this module.
    """
    if depth < 1 or trees < 1 or bins < 2:
        raise ValueError("depth and trees must be at least 1, bins at least 2")
    tried_features(subset, len(features))
    names = [f"cuts_{i}_" for i in range(len(features))]
    aggregates = [cut_points(f, target, bins).alias(c) for f, c in zip(features, names, strict=True)]
    groups = materialize(
        df.groupBy(group_key(by).alias(KEY)).agg(
            F.count("*").alias(ROWS), F.count(target).alias("known_"), F.sum(target).alias("sum_"), *aggregates
        )
    )
    whole = groups.agg(F.sum("known_").alias("known"), F.sum("sum_").alias("sum")).first()
    if not whole["known"]:
        return df
    numbered = materialize(groups.withColumn(GROUP, F.monotonically_increasing_id()).drop("sum_"))
    # Cut points go only to the rows of groups in which something is known and something missing.
    fitted = (F.col("known_") > 0) & (F.col("known_") < F.col(ROWS))
    lookup = numbered.select(
        KEY, ROWS, F.when(fitted, F.col(GROUP)).alias(GROUP), *[F.when(fitted, F.col(c)).alias(c) for c in names]
    )
    binned = attach(df, lookup, by, broadcast_bytes).withColumn(BINS, bin_numbers(features, names)).drop(*names)
    binned = materialize(binned)
    cells = materialize(
        binned.where(F.col(GROUP).isNotNull())
        .groupBy(GROUP, BINS)
        .agg(
            F.count(target).alias("n"),
            F.coalesce(F.sum(target), F.lit(0.0)).alias("total"),
            F.sum(F.when(F.col(target).isNull(), 1).otherwise(0)).alias("gaps"),
        )
    )
    found = predict_cells(cells, len(features), trees, depth, subset, seed, broadcast_bytes)
    gaps = cells.where("gaps > 0").select(GROUP, BINS, F.col("gaps").alias(ROWS))
    values = materialize(
        gaps.join(found, [GROUP, BINS]).select(group_key([GROUP, BINS]).alias(KEY), ROWS, "prediction")
    )
    missing = attach(binned.where(F.col(target).isNull()), values, [GROUP, BINS], broadcast_bytes)
    filled = F.coalesce("prediction", F.lit(whole["sum"] / whole["known"])).alias(target)
    columns = [filled if c == target else F.col(c) for c in df.columns]
    return binned.where(F.col(target).isNotNull()).select(*df.columns).unionByName(missing.select(*columns))

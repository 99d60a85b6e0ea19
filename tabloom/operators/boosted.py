"""Boosted trees of a search, fitted on cells: the different rows of bins, each with the weight of all rows in it.

MLlib grows trees with a job for every level, which for deep trees takes far longer than the work in it. Its trees see no
more of a row than its label and the bins of its features, so rows that have these in common are counted first, by all tasks. A fold
that is left with few cells is sent to a task for each fit, which grows the trees from MLlib's candidate splits with MLlib's
gains and rules to stop. Deviations are those of sums taken in another order. A fold with more cells is left to MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.features import SCALED
from tabloom.sources.shared import materialize

#: MLlib finds candidate splits in a sample of so many rows, or of the square of the bins if that is more.
SAMPLED = 10_000
#: Values of that sample that may come to the driver.
MOST_VALUES = 4_000_000
#: Bins are stored as bytes.
MOST_BINS = 256
#: Cells of a fold times bins of a feature: a task's histograms of a level, half a dozen at a time, have half as many numbers.
MOST_SUMS = 4_000_000
EPSILON = float(np.finfo(float).eps)


def takes_cells(estimators: Sequence[Estimator], inputs: int) -> bool:
    """Whether ``grow`` does for these estimators what MLlib does: trees of all features and rows, with the same bins."""
    if not all(isinstance(e, GBTClassifier) for e in estimators):
        return False
    if len({(e.getMaxBins(), e.getSeed()) for e in estimators}) > 1 or estimators[0].getMaxBins() > MOST_BINS:
        return False
    plain = [
        (e.getSubsamplingRate(), e.getFeatureSubsetStrategy(), e.getMinInstancesPerNode(), e.getMinWeightFractionPerNode())
        == (1.0, "all", 1, 0.0) and not e.isDefined(e.validationIndicatorCol)
        for e in estimators
    ]
    return all(plain) and inputs * max(SAMPLED, estimators[0].getMaxBins() ** 2) <= MOST_VALUES


def feature_cuts(values: np.ndarray, weight: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """MLlib's candidate splits of a feature with these sampled values; ``expected`` is the weight of a sample."""
    seen = values != 0
    found, at = np.unique(values[seen], return_inverse=True)
    sums = np.bincount(at, weight[seen], len(found))
    zeros = expected - sums.sum()
    if len(found) and zeros > EPSILON * seen.sum() * 100:
        place = np.searchsorted(found, 0.0)
        found, sums = np.insert(found, place, 0.0), np.insert(sums, place, zeros)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) < bins:
        return middles
    # A cut is where the running weight is nearest to the next multiple of the stride.
    stride, running, cuts = expected / bins, np.cumsum(sums), []
    target = stride
    for before, after, middle in zip(running, running[1:], middles):
        if abs(before - target) < abs(after - target):
            cuts.append(middle)
            target += stride
    return np.array(cuts)


def candidate_cuts(estimator: GBTClassifier, rows: DataFrame, weight: str | None) -> list[np.ndarray] | None:
    """The splits that MLlib would try on ``rows`` for each feature; none for rows that it would refuse or take otherwise."""
    spark = rows.sparkSession
    attributes = rows.schema[SCALED].metadata.get("ml_attr", {}).get("attrs", {})
    if {"nominal", "binary"} & set(attributes):
        return None  # categories are split by sets of them
    w = F.col(weight) if weight else F.lit(1.0)
    facts = rows.agg(F.count("*").alias("n"), F.sum(w).alias("weight"), F.count_if(F.col("label").isin(0, 1)).alias("binary")).first()
    if not facts["n"] or facts["binary"] < facts["n"]:
        return None
    bins = min(estimator.getMaxBins(), facts["n"])
    wanted = max(bins * bins, SAMPLED)
    fraction = min(1.0, wanted / facts["n"])
    sample = rows.select(vector_to_array(SCALED).alias("x"), w.alias("w"))
    if fraction < 1:
        # The rows that MLlib draws, which are other ones than those of DataFrame.sample.
        seed = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(estimator.getSeed()).nextInt()
        drawn = sample._jdf.rdd().sample(False, fraction, seed)
        sample = DataFrame(spark._jsparkSession.createDataFrame(drawn, sample._jdf.schema()), spark)
    table = sample.toArrow()
    x = table.column("x").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    weights = table.column("w").to_numpy()
    return [feature_cuts(x[:, i], weights, fraction * facts["weight"], bins) for i in range(x.shape[1])]


def cells_of(rows: DataFrame, cuts: Sequence[np.ndarray], weight: str | None) -> DataFrame:
    """The cell (a byte for the label, then one for each bin) and weight of each row, in the order of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(cuts))
            found = np.empty((batch.num_rows, 1 + len(cuts)), np.uint8)
            found[:, 0] = batch.column("label").to_numpy()
            for i, feature in enumerate(cuts):
                found[:, 1 + i] = np.searchsorted(feature, x[:, i])
            cell = pa.FixedSizeBinaryArray.from_buffers(pa.binary(found.shape[1]), len(found), [None, pa.py_buffer(found)])
            yield pa.RecordBatch.from_arrays([cell.cast(pa.binary()), batch.column("w")], ["cell", "w"])

    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    plain = rows.select(F.col("label").cast("double").alias("label"), vector_to_array(SCALED).alias("x"), w.alias("w"))
    return plain.mapInArrow(run, "cell binary, w double")


def fold_cells(estimator: GBTClassifier, rows: DataFrame, held: DataFrame, weight: str, count: str) -> DataFrame | None:
    """Stored cells (held, at, cell, w) of the rows to fit on and of the held ones; none if they are too many for a task.

    Rows in one part are not counted and keep their order, ``at``: their sums are rounded as MLlib's are. Several parts' sums
    meet in any order there, too. ``count`` says how many rows a held row stands for.
    """
    weight = weight if weight in rows.columns else None
    cuts = candidate_cuts(estimator, rows, weight)
    if cuts is None:
        return None

    def counted(cells: DataFrame) -> DataFrame:
        return cells.groupBy("cell").agg(F.sum("w").alias("w")).withColumn("at", F.lit(0).cast("bigint"))

    fitted = cells_of(rows, cuts, weight)
    single = rows.rdd.getNumPartitions() == 1
    fitted = fitted.withColumn("at", F.monotonically_increasing_id()) if single else counted(fitted)
    parts = [fitted.withColumn("held", F.lit(False)), counted(cells_of(held, cuts, count)).withColumn("held", F.lit(True))]
    found = materialize(parts[0].unionByName(parts[1]))
    return found if found.count() * max(len(c) + 1 for c in cuts) <= MOST_SUMS else None


def _variance(sums: np.ndarray) -> np.ndarray:
    """Of targets, from (weight, weighted sum, weighted sum of squares)."""
    return (sums[2] - sums[1] * sums[1] / sums[0]) / sums[0]


def grow(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, depth: int, least_gain: float = 0.0) -> np.ndarray:
    """What a regression tree predicts for each cell; ``bins`` has a row for each feature. Cells without weight only follow.

    Sums are taken and rounded in MLlib's order, since gains are often equal but for that.
    """
    value, sizes = np.zeros(len(target)), bins.max(axis=1, initial=0).astype(int) + 1
    parts = np.stack([weight, weight * target, weight * target * target])
    rows, node, nodes, whole = np.arange(len(target)), np.zeros(len(target), int), 1, None
    for level in range(depth + 1):
        if whole is not None:
            value[rows] = (whole[1] / whole[0])[node]
        if whole is not None and level == depth:
            break
        own = parts[:, rows]
        gain, feature, cut, sides = np.full(nodes, -np.inf), np.zeros(nodes, int), np.zeros(nodes, int), np.zeros((2, 3, nodes))
        for i in np.flatnonzero(sizes > 1):
            place, shape = node * sizes[i] + bins[i, rows], (nodes, sizes[i])
            sums = np.stack([np.bincount(place, part, nodes * sizes[i]).reshape(shape) for part in own]).cumsum(axis=2)
            left = sums[:, :, :-1]
            right = sums[:, :, -1:] - left
            whole = left[:, :, 0] + right[:, :, 0] if whole is None else whole
            total = left[0] + right[0]
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = _variance(whole)[:, None] - left[0] / total * _variance(left) - right[0] / total * _variance(right)
            gains[(left[0] <= 0) | (right[0] <= 0) | ~(gains >= least_gain)] = -np.inf
            best = np.arange(nodes), gains.argmax(axis=1)
            better = gains[best] > gain
            gain, feature, cut = np.where(better, gains[best], gain), np.where(better, i, feature), np.where(better, best[1], cut)
            sides = np.where(better, np.stack([left[:, *best], right[:, *best]]), sides)
        if whole is None:
            whole = own.sum(axis=1, keepdims=True)
        if level == 0:
            value[:] = whole[1, 0] / whole[0, 0]
        split = (gain > 0) & ((np.abs(_variance(whole)) >= EPSILON) | (level == 0))
        if level == depth or not split.any():
            break
        kept = split[node]
        rows, node = rows[kept], node[kept]
        right = bins[feature[node], rows] > cut[node]
        node, nodes = 2 * (np.cumsum(split) - 1)[node] + right, 2 * int(split.sum())
        whole = sides[:, :, split].transpose(1, 2, 0).reshape(3, nodes)
    return value


def boost(
    bins: np.ndarray, label: np.ndarray, weight: np.ndarray, depth: int, rounds: int, step: float, least_gain: float = 0.0
) -> Iterator[np.ndarray]:
    """The score of each cell after each round, for MLlib's loss: twice the negative log likelihood of labels 1 and -1."""
    sign = 2.0 * label - 1
    score = grow(bins, sign, weight, depth, least_gain)
    yield score
    for _ in range(rounds - 1):
        margins, at = np.unique(2 * sign * score, return_inverse=True)
        target = 4 * sign / (1 + np.array([math.exp(min(m, 700.0)) for m in margins.tolist()]))[at]
        score = score + step * grow(bins, target, weight, depth, least_gain)
        yield score


def boosted_scores(
    cells: Sequence[DataFrame], families: Sequence[Sequence[int]], estimators: Sequence[GBTClassifier], measure: str, count: str
) -> DataFrame:
    """Rows (fold, entry, label, score, ``count``) of the held cells of all folds, for all entries of a grid.

    ``cells`` has the stored cells of each fold, ``families`` the entries that one fit serves. Every fit is a task, the deepest
    trees begin.
    """
    order = sorted(range(len(families)), key=lambda i: -estimators[families[i][0]].getMaxDepth())
    fits = []
    for i in order:
        first = estimators[families[i][0]]
        rounds = [(entry, estimators[entry].getMaxIter()) for entry in families[i]]
        fits.append((first.getMaxDepth(), first.getStepSize(), first.getMinInfoGain(), rounds))
    folds = len(cells)
    schema = f"fold int, entry int, label double, score double, {count} bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [batch for batch in batches if batch.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        task = table.column("task").to_numpy()
        for number in np.unique(task):
            own = table.filter(pa.array(task == number))
            held, w = own.column("held").to_numpy(), own.column("w").to_numpy()
            cell = np.frombuffer(b"".join(own.column("cell").to_pylist()), np.uint8).reshape(own.num_rows, -1)
            # In one order however they come.
            at = np.lexsort((*cell.T, own.column("at").to_numpy(), held))
            held, w, cell = held[at], w[at], cell[at]
            depth, step, least_gain, rounds = fits[number // folds]
            wanted: dict[int, list[int]] = {}
            for entry, n in rounds:
                wanted.setdefault(n, []).append(entry)
            label, n = cell[:, 0].astype(float), int(held.sum())
            bins = np.ascontiguousarray(cell[:, 1:].T)
            scores = boost(bins, label, np.where(held, 0.0, w), depth, max(wanted), step, least_gain)
            for done, score in enumerate(scores, 1):
                found = score if measure == "auc" else (score > 0).astype(float)
                for entry in wanted.get(done, []):
                    columns = [np.full(n, number % folds, np.int32), np.full(n, entry, np.int32), label[held], found[held], w[held].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fold", "entry", "label", "score", count])

    numbered = reduce(DataFrame.unionByName, [c.withColumn("fold", F.lit(fold)) for fold, c in enumerate(cells)])
    tasks = F.explode(F.sequence(F.lit(0), F.lit(len(fits) - 1)))
    dealt = numbered.select("held", "at", "cell", "w", "fold", tasks.alias("fit")).withColumn("task", F.col("fit") * folds + F.col("fold"))
    return dealt.select("task", "held", "at", "cell", "w").repartitionById(folds * len(fits), "task").mapInArrow(run, schema)

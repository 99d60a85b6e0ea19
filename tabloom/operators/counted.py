"""Perceptrons fitted on counted rows: different ones, each with the number of equal rows that it stands for.

MLlib's takes single rows only. A counted one is fitted with MLlib's loss (cross entropy, its mean over all rows), start and optimizer: L-BFGS with a strong
Wolfe line search and the same rules to stop. Every evaluation is one Spark job, of which each task returns one gradient; rows
that one task can hold are fitted in one, without a job for each step.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: MLlib's settings of the optimizer: steps that are remembered, losses that a new one is compared with, evaluations of a
#: line search and of its zoom, and the conditions for a step.
STEPS, LOSSES, TRIES, DECREASE, CURVATURE = 10, 20, 10, 1e-4, 0.9
#: Rows times neurons that are fitted in one task.
MOST_OUTPUTS = 4_000_000


def takes_counts(estimator: Estimator) -> bool:
    """Whether ``estimator`` can do with counted rows what it does with single ones."""
    if isinstance(estimator, RandomForestClassifier) and estimator.getMinInstancesPerNode() > 1:
        return False  # it would count the rows that stand for others
    if isinstance(estimator, MultilayerPerceptronClassifier):
        return estimator.getSolver() == "l-bfgs"
    return True


def _parts(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views (matrix, bias) of every layer, as they lie in MLlib's vector of weights."""
    found, at = [], 0
    for inputs, outputs in zip(layers, layers[1:]):
        matrix = weights[at : at + inputs * outputs].reshape(inputs, outputs)  # MLlib's is its transpose, by columns
        at += inputs * outputs
        found.append((matrix, weights[at : at + outputs]))
        at += outputs
    return found


def loss_and_gradient(
    weights: np.ndarray, layers: Sequence[int], x: np.ndarray, label: np.ndarray, weight: np.ndarray
) -> np.ndarray:
    """Weighted sums over the rows: the cross entropy, then its gradient."""
    parts, outputs = _parts(weights, layers), [x]
    for matrix, bias in parts:
        z = outputs[-1] @ matrix + bias
        if len(outputs) < len(parts):
            outputs.append(0.5 * (1 + np.tanh(0.5 * z)))  # the logistic function, without overflow
    z -= z.max(axis=1, keepdims=True)
    logs = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    at = np.arange(len(label)), label.astype(int)
    found = np.zeros(1 + len(weights))
    found[0] = -(logs[at] * weight).sum()
    delta = np.exp(logs)
    delta[at] -= 1
    delta *= weight[:, None]
    for (matrix, _), (by_matrix, by_bias), inputs in reversed(list(zip(parts, _parts(found[1:], layers), outputs))):
        by_matrix[:] = inputs.T @ delta
        by_bias[:] = delta.sum(axis=0)
        delta = (delta @ matrix.T) * inputs * (1 - inputs)
    return found


class _NoStep(Exception):
    pass


def _between(a: tuple[float, float, float], b: tuple[float, float, float]) -> float:
    """Where a cubic through two points (place, loss, slope) is least, apart from their ends."""
    (low, f_low, d_low), (high, f_high, d_high) = sorted((a, b))
    one = d_low + d_high - 3 * (f_low - f_high) / (low - high)
    root = one * one - d_low * d_high
    two = math.sqrt(root) if root >= 0 else math.nan
    bottom = d_high - d_low + 2 * two
    at = high - (high - low) * (d_high + two - one) / bottom if bottom else math.nan
    return min(max(at, low + 0.1 * (high - low)), low + 0.9 * (high - low)) if not math.isnan(at) else (low + high) / 2


def _step(along: Callable[[float], tuple[float, float, float]], first: float) -> float:
    """The length of a step that meets the strong Wolfe conditions."""
    start = low = along(0.0)
    slope, length = start[2], first
    if slope > 0:
        raise _NoStep

    def higher(c):
        return c[1] > start[1] + DECREASE * c[0] * slope

    def zoom(low, high):
        for _ in range(TRIES):
            c = along(_between(low, high))
            if higher(c) or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= CURVATURE * abs(slope):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _NoStep

    for i in range(TRIES):
        c = along(length)
        if not math.isfinite(c[1]):
            length /= 2
            continue
        if higher(c) or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= CURVATURE * abs(slope):
            return c[0]
        if c[2] >= 0:
            return zoom(c, low)
        low, length = c, 1.5 * length
    raise _NoStep


def minimize(
    evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, iterations: int, tolerance: float
) -> np.ndarray:
    """L-BFGS from ``start``, with MLlib's rules to stop."""
    x, (loss, gradient) = start, evaluate(start)
    scale, losses = loss, deque([loss], LOSSES)
    steps: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=STEPS)
    failed, done = False, 0
    while done < iterations and np.linalg.norm(gradient) > max(tolerance * loss, 1e-8):
        direction, factors = gradient.copy(), []
        for s, y in reversed(steps):
            factors.append((s @ direction) / (s @ y))
            direction -= factors[-1] * y
        if steps:
            s, y = steps[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y), factor in zip(steps, reversed(factors)):
            direction += s * (factor - (y @ direction) / (s @ y))
        direction = -direction
        known = {0.0: (loss, gradient)}

        def along(length: float) -> tuple[float, float, float]:
            if length not in known:
                known[length] = evaluate(x + length * direction)
            return length, known[length][0], float(known[length][1] @ direction)

        try:
            length = _step(along, 1.0 if done else 1.0 / np.linalg.norm(direction))
            if length * np.linalg.norm(gradient) < 1e-10:
                raise _NoStep
        except _NoStep:
            if failed:
                break
            failed = True
            steps.clear()
            continue
        failed = False
        new_loss, new_gradient = known[length]
        steps.append((length * direction, new_gradient - gradient))
        x, loss, gradient, done = x + length * direction, new_loss, new_gradient, done + 1
        losses.append(loss)
        if abs(loss - max(losses)) <= tolerance * abs(scale):
            break
    return x


def fit_counted_perceptron(estimator: MultilayerPerceptronClassifier, rows: DataFrame, weight: str) -> Model:
    """``estimator`` fitted on ``rows``, each standing for ``weight`` equal ones."""
    layers = estimator.getLayers()
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()

    def model(params: dict) -> Model:
        # Without an iteration the model has the weights that it starts with.
        return estimator.fit(rows.select(label, features).limit(1), params)

    unmoved = {estimator.maxIter: 0}
    given = estimator.getInitialWeights() if estimator.isSet(estimator.initialWeights) else None
    start = np.asarray((given if given is not None else model(unmoved).weights).toArray())
    plain = rows.select(
        F.col(label).alias("label"), vector_to_array(features).alias("x"), F.col(weight).alias("weight"), F.spark_partition_id().alias("part")
    )
    kept = plain.persist(StorageLevel.MEMORY_AND_DISK)
    iterations, tolerance = estimator.getMaxIter(), estimator.getTol()
    batch_rows = int(rows.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    batch_rows = batch_rows if batch_rows > 0 else MOST_OUTPUTS

    def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
        x = batch.column("x").flatten().to_numpy()
        return [x.reshape(batch.num_rows, layers[0]), *(batch.column(c).to_numpy() for c in ("label", "weight"))]

    def sums(weights: np.ndarray, batches: Iterator[list[np.ndarray]]) -> np.ndarray:
        """Of a part's batches: the weight, the loss and its gradient."""
        total = np.zeros(2 + len(weights))
        for x, labels, weight in batches:
            total[0] += weight.sum()
            total[1:] += loss_and_gradient(weights, layers, x, labels, weight)
        return total

    def mean(totals: Sequence[Sequence[float]]) -> tuple[float, np.ndarray]:
        total = np.sum(totals, axis=0)
        return total[1] / total[0], total[2:] / total[0]

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sums(weights, map(arrays, batches))
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

        return mean([row["total"] for row in kept.mapInArrow(run, "total array<double>").collect()])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(batch.column("part").to_numpy(), *arrays(batch)) for batch in batches if batch.num_rows]
        part, *columns = (np.concatenate(column) for column in zip(*found))
        # The parts and batches that ``evaluate`` would sum, so that the steps are the same.
        own = [[column[part == number] for column in columns] for number in np.unique(part)]
        cut = [[[c[i : i + batch_rows] for c in of_part] for i in range(0, len(of_part[0]), batch_rows)] for of_part in own]
        weights = minimize(lambda weights: mean([sums(weights, of_part) for of_part in cut]), start, iterations, tolerance)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()], pa.list_(pa.float64()))], ["found"])

    try:
        if kept.count() * sum(layers) <= MOST_OUTPUTS:
            found = np.array(kept.coalesce(1).mapInArrow(whole, "found array<double>").first()["found"])
        else:
            found = minimize(evaluate, start, iterations, tolerance)
    finally:
        kept.unpersist()
    fitted = model(unmoved | {estimator.initialWeights: Vectors.dense(found)})
    return fitted.copy({fitted.maxIter: estimator.getMaxIter()})

"""Cross-validated parameter search.

Every fold prepares its rows once, fits all models on what it has stored, and scores the held rows with all of them
in one pass, equal ones once; one grouped job then gives every model's metric exactly. A parameter that only lengthens a
model (the number of boosting rounds) costs one fit for all its values: a shorter model is the beginning of the
longest one.

Models are fitted on counted rows if a large fold has many equal ones: encoded columns have few different values,
however many rows there are. Perceptrons, which MLlib fits on single rows only, are fitted by ``counted``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegressionModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tabloom.operators.boosted import boosted_scores, fold_cells, takes_cells
from tabloom.operators.counted import fit_counted_perceptron, takes_counts
from tabloom.operators.evaluate import accuracy, area_under_roc, weighted_f1
from tabloom.operators.features import SCALED
from tabloom.operators.models import UNSPECIFIED, ModelSpec
from tabloom.operators.split import Key, fold_number
from tabloom.sources import shared
from tabloom.sources.shared import materialize, shared_folder

FOLD = "fold_"
DEAL = "deal_"
#: Many fits run at a time, so each is cut into fewer parts than a single one.
ROWS_PER_PART = 50_000
WEIGHT = "weight_"
COUNT = "count_"
#: A counted row stands for at most this share of all rows. Weights make the deviations by which MLlib scales larger by up to
#: half of that, and candidate splits are drawn from single rows.
MOST_WEIGHT = 1 / 10_000
#: A forest draws each counted row as a whole, so there are at least this many of them: larger tables' equal rows are drawn a few at a
#: time, and what a tree draws varies as with this many rows.
DRAWN_ROWS = 200_000


@dataclass(frozen=True)
class Search:
    """``maps`` are the grid's entries, ``metrics`` their means over the folds, ``best`` the number of the best entry.

    ``model`` is fitted with it on all rows and includes the prepared stages; ``parameters`` describes it. ``fits`` is
    the number of models fitted in the folds, ``submodels`` the fitted models of each fold by entry, if kept.
    """

    maps: list[dict[str, Any]]
    metrics: list[float | None]
    best: int
    model: PipelineModel
    parameters: str
    fits: int
    submodels: list[list[Model]] = field(default_factory=list)


def best_parameters(spec: ModelSpec, model: Model) -> str:
    if not spec.report:
        return UNSPECIFIED
    return " - ".join(f"{label}: {model.getOrDefault(name)}" for label, name in spec.report)


def grid_maps(grid: Mapping[str, Sequence] | None) -> list[dict[str, Any]]:
    """Every combination of the grid's values, the last parameter changing fastest; one empty map without a grid."""
    grid = grid or {}
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def model_scores(df: DataFrame, model: Model, measure: str, out: str) -> DataFrame:
    """``df`` with what ``measure`` needs of the model's output: the score of class 1 or the prediction."""
    wanted = "rawPredictionCol" if measure == "auc" else "predictionCol"
    # An empty name means that the model leaves this output out.
    names = {model.getParam(p): "" for p in ("predictionCol", "rawPredictionCol", "probabilityCol") if model.hasParam(p)}
    scored = model.transform(df, names | {model.getParam(wanted): out})
    return scored.withColumn(out, vector_to_array(out)[1]) if measure == "auc" else scored


def linear_scores(df: DataFrame, models: Sequence[LogisticRegressionModel]) -> DataFrame:
    """Rows (label, ``COUNT``, entry, score) of the held rows ``df``: the margins of all models, in one pass over the features."""
    weights = np.stack([model.coefficients.toArray() for model in models], axis=1)
    constants = np.array([model.intercept for model in models])
    entries = np.arange(len(models), dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(weights))
            margins = np.zeros((batch.num_rows, len(entries)))
            for i, of_feature in enumerate(weights):  # feature by feature, so that all rows are rounded alike
                margins += x[:, i, None] * of_feature
            at = pa.array(np.repeat(np.arange(batch.num_rows), len(entries)))
            of_models = pa.array(np.tile(entries, batch.num_rows))
            columns = [batch.column("label").take(at), batch.column(COUNT).take(at), of_models, pa.array((margins + constants).ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["label", COUNT, "entry", "score"])

    plain = df.select(F.col("label").cast("double").alias("label"), COUNT, vector_to_array(SCALED).alias("x"))
    return plain.mapInArrow(run, f"label double, {COUNT} bigint, entry int, score double")


def prefix_scores(df: DataFrame, model: Model, lengths: Sequence[int], measure: str, outs: Sequence[str]) -> DataFrame:
    """``df`` with the outputs of the models that are the first trees of a boosted ``model``, one for each length.

    A tree is evaluated once for all lengths. The score of class 1 is the weighted sum of the trees, the prediction its sign.
    """
    trees = [f"{outs[0]}_tree_{i}" for i in range(max(lengths))]
    for tree, name in zip(model.trees, trees):
        df = tree.transform(df, {tree.getParam("predictionCol"): name})
    margins: list[Column] = []
    for weight, name in zip(model.treeWeights, trees):
        margins.append((margins[-1] if margins else F.lit(0.0)) + F.lit(weight) * F.col(name))
    for length, out in zip(lengths, outs):
        margin = margins[length - 1]
        df = df.withColumn(out, margin if measure == "auc" else F.when(margin > 0, 1.0).otherwise(0.0))
    return df.drop(*trees)


def counted_rows(rows: DataFrame) -> DataFrame:
    """The different rows of ``rows`` and how often each occurs, as ``COUNT``."""
    return rows.groupBy(*rows.columns).agg(F.count("*").alias(COUNT))


def weighted_rows(counted: DataFrame, total: int, most: float | None = None) -> DataFrame:
    """Rows (columns, ``WEIGHT``, ``DEAL``) that stand for the ``total`` rows behind ``counted``.

    Weights are whole numbers. Those of a row with more than ``most`` (``MOST_WEIGHT``) of ``total`` are dealt to several equal rows.
    """
    most = MOST_WEIGHT if most is None else most
    columns = [c for c in counted.columns if c != COUNT]
    pieces = F.ceil(F.col(COUNT) / F.lit(max(1, int(total * most))))
    cut = counted.withColumn("pieces_", pieces).withColumn("piece_", F.explode(F.sequence(F.lit(1), "pieces_")))
    weight = F.expr(f"piece_ * {COUNT} div pieces_ - (piece_ - 1) * {COUNT} div pieces_").cast("double")
    return cut.select(*columns, weight.alias(WEIGHT), F.xxhash64(*columns, "piece_").alias(DEAL))


def _metric(scored: DataFrame, measure: str, by: Sequence[str] = ("entry",)) -> DataFrame:
    """(entry, metric) of rows (entry, label, score, count), for all models at once; ``by`` may name more than the entry."""
    if measure == "auc":
        return area_under_roc(scored, by=by, count=COUNT).select(*by, F.col("auc").alias("metric"))
    if measure == "accuracy":
        found = accuracy(scored, prediction="score", by=by, count=COUNT)
        return found.select(*by, F.col("accuracy").alias("metric"))
    return weighted_f1(scored, prediction="score", by=by, count=COUNT).select(*by, F.col("f1").alias("metric"))


def _families(spec: ModelSpec, maps: Sequence[dict[str, Any]]) -> list[list[int]]:
    """Numbers of the entries that one fit serves: those that differ in the lengthening parameter alone."""
    found: dict[tuple, list[int]] = {}
    for entry, values in enumerate(maps):
        name = tuple((k, v) for k, v in values.items() if k != spec.lengthens)
        found.setdefault(name, []).append(entry)
    return list(found.values())


def fitted_model(estimator: Estimator, rows: DataFrame) -> Model:
    """``estimator`` fitted on ``rows``, each of which stands for as many as its ``WEIGHT`` says, if it has one."""
    if WEIGHT not in rows.columns:
        return estimator.fit(rows)
    if isinstance(estimator, MultilayerPerceptronClassifier):
        return fit_counted_perceptron(estimator, rows, WEIGHT)
    return estimator.copy({estimator.getParam("weightCol"): WEIGHT}).fit(rows)


class Folds:
    """The folds of a training table and what a search reads of them, each made once: searches of one table share them.

    A fold's rows to fit on are all but its own; the fold None holds no rows, so all are fitted on.
    """

    def __init__(self, train: DataFrame, key: Key, folds: int, seed: int, prepare: Sequence[Transformer | Estimator] = ()) -> None:
        self.columns, self.prepare = train.columns, list(prepare)
        numbered = train.withColumn(FOLD, fold_number(folds, seed, key))
        # A training table is dealt out anew whenever it is read; the folds read large ones as stored, which shuffles no rows.
        stored = materialize(numbered)
        self.large = stored.count() > ROWS_PER_PART
        self.numbered = stored if self.large else numbered
        self._made: dict[tuple, Any] = {}
        self._locks: defaultdict[tuple, Any] = defaultdict(Lock)
        self._lock = Lock()

    def _once(self, what: tuple, make: Callable[[], Any]) -> Any:
        with self._lock:
            lock = self._locks[what]
        with lock:
            if what not in self._made:
                self._made[what] = make()
            return self._made[what]

    def own(self, fold: int | None) -> DataFrame:
        return self.numbered if fold is None else self.numbered.where(F.col(FOLD) != fold)

    def prepared(self, fold: int | None) -> PipelineModel:
        return self._once(("prepared", fold), lambda: Pipeline(stages=self.prepare).fit(self.own(fold)))

    def held(self, fold: int) -> DataFrame:
        """The different held rows with their ``COUNT``."""
        rows = self.numbered.where(F.col(FOLD) == fold)
        return self._once(("held", fold), lambda: materialize(counted_rows(self.prepared(fold).transform(rows).select("label", SCALED))))

    def _counted(self, fold: int | None) -> tuple[DataFrame, Row]:
        def make():
            counted = materialize(counted_rows(self.prepared(fold).transform(self.own(fold)).select("label", SCALED)))
            return counted, counted.agg(F.count("*").alias("different"), F.sum(COUNT).alias("rows")).first()

        return self._once(("counted", fold), make)

    def _weighted(self, fold: int | None, most: float) -> tuple[DataFrame, int]:
        def make():
            counted, sums = self._counted(fold)
            rows = materialize(weighted_rows(counted, sums["rows"], most))
            return rows, rows.count()

        return self._once(("weighted", fold, most), make)

    def _single(self, fold: int | None) -> tuple[DataFrame, int]:
        def make():
            # Labels and features may have few values, so rows are dealt by all that is known of them, the key too.
            deal = [F.xxhash64(*self.columns).alias(DEAL)] if self.large else []
            rows = materialize(self.prepared(fold).transform(self.own(fold)).select("label", SCALED, *deal))
            return rows, rows.count()

        return self._once(("single", fold), make)

    def fit_rows(self, fold: int | None, spec: ModelSpec, countable: bool, rows_per_part: int | None = None) -> DataFrame:
        """The rows to fit on: ``countable`` ones as different rows with a ``WEIGHT``, if that makes them far fewer."""
        rows_per_part = rows_per_part or shared.ROWS_PER_PART
        if countable:
            sums = self._counted(fold)[1]
            if sums["different"] and 2 * (sums["different"] + spec.draws * DRAWN_ROWS) <= sums["rows"]:
                rows, count = self._weighted(fold, 1 / DRAWN_ROWS if spec.draws else MOST_WEIGHT)
                parts = shared.part_count(count, rows_per_part)
                return rows.repartition(parts, DEAL).sortWithinPartitions(DEAL).drop(DEAL)
        rows, count = self._single(fold)
        return shared.spread(rows, count, rows_per_part, DEAL if self.large else None)

    def whole_model(self, spec: ModelSpec, estimator: Estimator, countable: bool) -> PipelineModel:
        """``estimator`` fitted on all rows, behind the prepared stages."""
        rows = self.fit_rows(None, spec, countable).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = fitted_model(estimator, rows)
        finally:
            rows.unpersist()
        return PipelineModel(stages=[*self.prepared(None).stages, model])


def cross_validate(
    spec: ModelSpec,
    train: DataFrame,
    inputs: int,
    key: Key,
    folds: int = 5,
    grid: Mapping[str, Sequence] | None = None,
    classes: int = 2,
    seed: int = 1,
    parallelism: int = 8,
    keep_submodels: bool = False,
    prepare: Sequence[Transformer | Estimator] = (),
    tables: Folds | None = None,
    **overrides: Any,
) -> Search:
    """Search ``grid`` (by default the one of ``spec``) and refit the best entry on all of ``train``.

    Folds come from the hash of ``key``, so they do not depend on the partitioning; ``train`` is read for every
    fold and should be a stored table. Stages in ``prepare`` (a scaler, for example) are fitted once inside
    each fold, with that fold's rows. A model without a metric of its own is chosen by F1, the first of equal entries
    is taken, and folds in which the metric isn't defined don't count. ``tables`` are the folds that another search of
    the same rows has read. ``overrides`` are further parameters of the estimator.
    """
    spark = train.sparkSession
    shared_folder(spark)
    estimator = spec.build(inputs, classes, seed, **overrides)
    maps = grid_maps(spec.grid if grid is None else grid)
    families, measure = _families(spec, maps), spec.select_by or "f1"
    tables = Folds(train, key, folds, seed, prepare) if tables is None else tables
    totals: list[list[float]] = [[] for _ in maps]
    submodels: list[list[Model]] = []

    def longest(family: list[int]) -> int:
        return max(family, key=lambda entry: maps[entry].get(spec.lengthens, 0))

    def chosen(entry: int) -> Estimator:
        return estimator.copy({estimator.getParam(name): value for name, value in maps[entry].items()})

    countable = tables.large and spec.weighs and all(takes_counts(chosen(entry)) for entry in range(len(maps)))

    def ready(fold: int) -> DataFrame:
        return tables.fit_rows(fold, spec, countable, ROWS_PER_PART).persist(StorageLevel.MEMORY_AND_DISK)

    def side_by_side(work: Callable[[int], Any], numbers: Sequence[int]) -> list[Any]:
        with ThreadPool(max(1, min(parallelism, len(numbers)))) as pool:
            wrapped = [inheritable_thread_target(spark)(partial(work, number)) for number in numbers]
            return pool.map(lambda task: task(), wrapped, chunksize=1)

    def scores(fold: int, models: Sequence[Model]) -> DataFrame:
        held = tables.held(fold)
        if measure == "auc" and all(isinstance(m, LogisticRegressionModel) and m.coefficientMatrix.numRows == 1 for m in models):
            return linear_scores(held, [models[number] for _, number in sorted((entry, n) for n, (entry,) in enumerate(families))])
        for family, model in zip(families, models):
            if len(family) == 1:
                held = model_scores(held, model, measure, f"score_{family[0]}")
            else:
                lengths = [maps[entry][spec.lengthens] for entry in family]
                held = prefix_scores(held, model, lengths, measure, [f"score_{entry}" for entry in family])
        each = F.array(*[F.struct(F.lit(i).alias("entry"), F.col(f"score_{i}").alias("score")) for i in range(len(maps))])
        return held.select("label", COUNT, F.explode(each).alias("s")).select("label", COUNT, "s.entry", "s.score")

    def judged(fold: int, models: Sequence[Model]) -> list[Row]:
        return _metric(scores(fold, models), measure).collect()  # one row for each entry

    def cells_of(fold: int) -> DataFrame | None:
        rows = ready(fold)
        try:
            return fold_cells(chosen(0), rows, tables.held(fold), WEIGHT, COUNT)
        finally:
            rows.unpersist()

    def judged_by_cells() -> list[Row] | None:
        """Metrics of all folds and entries from models fitted on cells; none if these models or a fold's rows don't allow it."""
        every = [chosen(entry) for entry in range(len(maps))]
        if keep_submodels or not takes_cells(every, inputs):
            return None
        cells = [cells_of(0)]
        if cells[0] is not None:
            cells += side_by_side(cells_of, range(1, folds))
        if any(found is None for found in cells):
            return None
        scored = boosted_scores(cells, families, every, measure, COUNT)
        return _metric(scored, measure, ["fold", "entry"]).collect()  # one row for each fold and entry

    found = judged_by_cells()
    for row in sorted(found or [], key=lambda row: row["fold"]):
        if row["metric"] is not None:
            totals[row["entry"]].append(row["metric"])
    start = 0 if found is None else folds
    while start < folds:
        wave = {start: ready(start)}
        parts = wave[start].rdd.getNumPartitions()
        # Fits run side by side until their tasks fill the cores; more would only push each other's rows out of memory.
        side = max(1, min(parallelism, 2 * shared.PARTS // parts))
        together = folds if folds * parts <= shared.PARTS else max(1, side // len(families))
        others = range(start + 1, min(start + together, folds))
        wave |= dict(zip(others, side_by_side(ready, others)))
        start += together
        # Grids go from small models to large ones; the large ones begin first.
        tasks = [(fold, number) for number in reversed(range(len(families))) for fold in wave]
        try:
            with ThreadPool(max(1, min(side, len(tasks)))) as pool:
                # Wrapped one by one: fits that share one set of Spark's local properties would change it under each other.
                ready_fits = [partial(fitted_model, chosen(longest(families[number])), wave[fold]) for fold, number in tasks]
                work = [inheritable_thread_target(spark)(task) for task in ready_fits]
                fitted = dict(zip(tasks, pool.map(lambda task: task(), work, chunksize=1)))
        finally:
            for rows in wave.values():
                rows.unpersist()
        found = {fold: [fitted[fold, number] for number in range(len(families))] for fold in wave}
        # Scoring with many models is mostly planning, which the folds do side by side.
        with ThreadPool(len(wave)) as pool:
            judges = [partial(judged, fold, models) for fold, models in found.items()]
            results = pool.map(lambda task: task(), [inheritable_thread_target(spark)(judge) for judge in judges], chunksize=1)
        for models, rows in zip(found.values(), results):
            for row in rows:
                if row["metric"] is not None:
                    totals[row["entry"]].append(row["metric"])
            if keep_submodels:
                kept = {entry: model for family, model in zip(families, models) for entry in family}
                submodels.append([kept[entry] for entry in range(len(maps))])
    metrics = [sum(found) / len(found) if found else None for found in totals]
    best = max(range(len(maps)), key=lambda entry: -1.0 if metrics[entry] is None else metrics[entry])
    whole = tables.whole_model(spec, chosen(best), countable)
    return Search(maps, metrics, best, whole, best_parameters(spec, whole.stages[-1]), folds * len(families), submodels)

"""Fit all classifiers, plain and searched, and compare them on rows they have not seen."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.evaluate import accuracy, area_under_roc, confidence
from tabloom.operators.features import feature_frames, feature_pipeline, to_label
from tabloom.operators.models import CLASSIFIERS, STANDARD, fit_predict
from tabloom.operators.split import Key, hash_split
from tabloom.operators.tuning import Folds, Search, cross_validate
from tabloom.schemas import COMPARISON_SCHEMA, FEATURES, TARGET
from tabloom.sources.shared import materialize, training_table, written

# The models of the comparison in order, and the title of a searched one.
COMPARED = ("logistic", "random_forest", "gbt", "decision_tree", "mlp", "naive_bayes")
SEARCHED_TITLE = "{} - Cross Validation"


@dataclass(frozen=True)
class Comparison:
    """``table`` has one row per model; ``confidences`` one row per model and test row."""

    table: DataFrame
    confidences: DataFrame
    searches: Mapping[str, Search]


def train_and_test(
    df: DataFrame,
    key: Key,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    keys: Sequence[str] = (),
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Label, scaled features and ``keys`` of the two parts; the scaler sees only the first."""
    parts = hash_split(df, weights, seed, key)
    labelled = [to_label(part, target, features, keys) for part in parts]
    _, (train, test) = feature_frames(labelled[0], labelled[1:], features)
    return train, test


@dataclass(frozen=True)
class _Step:
    """A fitted model, its scored test rows, and what else is known of it."""

    model: PipelineModel
    scored: DataFrame
    facts: dict


def _kept(spark: SparkSession, folder: str, meaning: str | None, fit: Callable[[], _Step]) -> _Step:
    """The step stored in ``folder``, or else a new one, which is stored there; its facts are written last.

    ``meaning`` says what the step was made from; facts of another meaning are an error. Without one only the
    scored rows are stored.
    """
    facts = f"{folder}/facts"
    if meaning and written(spark, facts):
        row = spark.read.schema("meaning string, facts string").parquet(facts).first()
        if row["meaning"] != meaning:
            raise ValueError(f"{folder} holds the model of other rows or parameters: {row['meaning']}, not {meaning}")
        scored = spark.read.parquet(f"{folder}/scored")
        return _Step(PipelineModel.load(f"{folder}/model"), scored, json.loads(row["facts"]))
    step = fit()
    if not meaning:
        return _Step(step.model, materialize(step.scored), step.facts)
    step.model.write().overwrite().save(f"{folder}/model")
    step.scored.write.mode("overwrite").parquet(f"{folder}/scored")
    row = spark.createDataFrame([(meaning, json.dumps(step.facts))], "meaning string, facts string")
    row.coalesce(1).write.mode("overwrite").parquet(facts)
    return _Step(step.model, spark.read.schema(step.scored.schema).parquet(f"{folder}/scored"), step.facts)


def _rows_digest(df: DataFrame) -> str:
    """A number for the rows of ``df`` that doesn't depend on their order."""
    hashed = F.pmod(F.xxhash64(*df.columns), F.lit(2**31))
    found = df.agg(F.count("*").alias("n"), F.sum(hashed).alias("hashes")).first()
    return f"{found['n']}:{found['hashes']}"


def compare_models(
    df: DataFrame,
    keys: Sequence[str],
    models: Sequence[str] = COMPARED,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
    folds: int = 5,
    classes: int = 2,
    seed: int = 1,
    parallelism: int = 8,
    keep_submodels: bool = False,
    store: str | None = None,
) -> Comparison:
    """Fit every model with its standard parameters and, if it has a grid, with the best of that grid.

    ``grids`` replaces or adds grids by model. Features are scaled with the rows that a model is fitted
    on, in each fold anew. Every model scores the test rows once; label, score, prediction and
    confidence are stored, and all metrics come from there. A metric that is not measured for a model
    is null. ``searches`` has the fitted searches, with their sub-models if ``keep_submodels``. Large tables with few different
    rows are counted once for all searches.

    Each finished step (a plain model, or a search) keeps its model, its scored test rows and its facts in a folder
    below ``store``. A later call with the same rows and parameters goes on from there, also in another application, and may
    ask for more models; one with others raises. Sub-models aren't stored. Without ``store`` nothing outlasts the
    application's tables.
    """
    if store and keep_submodels:
        raise ValueError("sub-models are not stored")
    spark = df.sparkSession
    key = list(keys)
    folder = (store or "").rstrip("/")
    split = hash_split(df, (0.7, 0.3), seed, key)
    train, test = [training_table(to_label(part, target, features, key)) for part in split]
    stages = feature_pipeline(features).getStages()
    digests = [_rows_digest(part) for part in (train, test)] if store else []
    rows, confidences, searches = [], [], {}

    def scored_rows(predictions):
        has_probability = "probability" in predictions.columns
        vector = "probability" if has_probability else "rawPrediction" if "rawPrediction" in predictions.columns else None
        score = vector_to_array(vector)[1] if vector else F.lit(None).cast("double")
        chosen = confidence() if has_probability else F.lit(None).cast("double")
        scored = predictions.select("label", "prediction", score.alias("score"), chosen.alias("confidence"))
        return scored, {"has_probability": has_probability}

    def record(title, spec, step, parameters):
        area = area_under_roc(step.scored).first()["auc"] if "auc" in spec.measures else None
        right = accuracy(step.scored).first()["accuracy"] if "accuracy" in spec.measures else None
        rows.append((title, area, right, parameters))
        if step.facts["has_probability"]:
            confidences.append(step.scored.select(F.lit(title).alias("model"), "confidence"))

    tables = []

    def of_train():
        """The training rows as all searches read them."""
        if not tables:
            tables.append(Folds(train, key, folds, seed, stages))
        return tables[0]

    def plain(name, spec):
        estimator = spec.build(len(features), classes, seed)
        model, predictions = fit_predict(Pipeline(stages=[*stages, estimator]), train, test)
        return _Step(model, *scored_rows(predictions))

    def searched(name, spec, grid):
        found = cross_validate(
            spec, train, len(features), key, folds, grid, classes, seed, parallelism, keep_submodels, stages, of_train()
        )
        searches[name] = found
        scored, facts = scored_rows(found.model.transform(test))
        search = {c: getattr(found, c) for c in ("maps", "metrics", "best", "parameters", "fits")}
        return _Step(found.model, scored, facts | {"search": search})

    common = {"rows": digests, "features": list(features), "classes": classes, "seed": seed}
    for name in models:
        spec = CLASSIFIERS[name]
        meaning = json.dumps(common, sort_keys=True) if store else None
        step = _kept(spark, f"{folder}/{name}-plain", meaning, lambda: plain(name, spec))
        record(spec.title, spec, step, STANDARD)
        grid = (grids or {}).get(name, spec.grid)
        if grid is None:
            continue
        of_search = {"grid": {k: list(v) for k, v in grid.items()}, "folds": folds, "key": key}
        meaning = json.dumps(common | of_search, sort_keys=True) if store else None
        step = _kept(spark, f"{folder}/{name}-searched", meaning, lambda: searched(name, spec, grid))
        if name not in searches:
            searches[name] = Search(model=step.model, **step.facts["search"])
        record(SEARCHED_TITLE.format(spec.title), spec, step, searches[name].parameters)
    none = spark.createDataFrame([], "model string, confidence double")
    return Comparison(spark.createDataFrame(rows, COMPARISON_SCHEMA), reduce(DataFrame.unionByName, confidences, none), searches)

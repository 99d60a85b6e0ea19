"""The estimators on offer, one entry each, all on ``label`` and ``features``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.param.shared import HasSeed
from pyspark.sql import DataFrame

from tabloom.sources.shared import shared_folder

STANDARD = "standard"
UNSPECIFIED = "unspecified"


@dataclass(frozen=True)
class ModelSpec:
    """An estimator with its parameters, its search grid and what is reported about it.

    ``lengthens`` is a parameter whose smaller values give the beginning of the model that a larger one gives.
    ``weighs`` says that a fit takes one row with a weight for as many equal rows, ``draws`` that it
    draws rows, heavy ones as a whole.
    """

    title: str
    estimator: type[Estimator]
    params: Mapping[str, Any] = field(default_factory=dict)
    measures: Sequence[str] = ()
    grid: Mapping[str, Sequence] | None = None
    select_by: str | None = None
    report: Sequence[tuple[str, str]] = ()
    hidden_layers: Sequence[int] = ()
    lengthens: str | None = None
    weighs: bool = False
    draws: bool = False

    def build(self, inputs: int, classes: int = 2, seed: int = 1, **overrides: Any) -> Estimator:
        """A new estimator for ``inputs`` features. Every estimator that takes a seed gets it."""
        params = dict(self.params)
        if self.hidden_layers:
            params["layers"] = [inputs, *self.hidden_layers, classes]
        if issubclass(self.estimator, HasSeed):
            params["seed"] = seed
        return self.estimator(**{**params, **overrides})


# Parameters, search grids and report formats.
CLASSIFIERS = {
    "logistic": ModelSpec(
        "Logistic Regression",
        C.LogisticRegression,
        measures=("auc",),
        grid={
            "regParam": [i / 100 for i in range(10)],
            "elasticNetParam": [0.0, 1.0],
            "maxIter": [1, 5, 10],
        },
        select_by="auc",
        report=(
            ("regParam", "regParam"),
            ("MaxIter", "maxIter"),
            ("elasticNetParam", "elasticNetParam"),
        ),
        weighs=True,
    ),
    "random_forest": ModelSpec(
        "Random forest",
        C.RandomForestClassifier,
        measures=("auc", "accuracy"),
        grid={"maxDepth": [2, 4, 6], "maxBins": [20, 60], "numTrees": [5, 20]},
        select_by="auc",
        report=(("maxDepth", "maxDepth"), ("maxBins", "maxBins"), ("numTrees", "numTrees")),
        weighs=True,
        draws=True,
    ),
    "gbt": ModelSpec(
        "Gradient-Boosted Tree Classifier",
        C.GBTClassifier,
        measures=("auc", "accuracy"),
        grid={"maxDepth": [1, 10, 20, 30], "maxIter": [7, 10, 14, 18]},
        select_by="auc",
        report=(("maxDepth", "maxDepth"), ("maxIter", "maxIter")),
        lengthens="maxIter",
        weighs=True,
    ),
    "decision_tree": ModelSpec(
        "Decision Tree Classifier",
        C.DecisionTreeClassifier,
        measures=("accuracy",),
        grid={"maxDepth": [4, 8], "maxBins": [2, 4, 6]},
        select_by="f1",
        report=(("maxDepth", "maxDepth"), ("maxBins", "maxBins")),
        weighs=True,
    ),
    "mlp": ModelSpec(
        "Multilayer perceptron classifier",
        C.MultilayerPerceptronClassifier,
        params={"maxIter": 100, "blockSize": 128},
        measures=("accuracy",),
        grid={},
        select_by="f1",
        hidden_layers=(5, 4),
        weighs=True,
    ),
    "naive_bayes": ModelSpec(
        "Naive Bayes",
        C.NaiveBayes,
        params={"smoothing": 1.0, "modelType": "multinomial"},
        measures=("accuracy",),
    ),
    "svc": ModelSpec(
        "Linear Support Vector Machine",
        C.LinearSVC,
        params={"maxIter": 10, "regParam": 0.1},
        measures=("accuracy",),
    ),
}

REGRESSORS = {
    "linear": ModelSpec(
        "Linear regression",
        R.LinearRegression,
        params={"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8},
    ),
    "generalized_linear": ModelSpec(
        "Generalized linear regression",
        R.GeneralizedLinearRegression,
        params={"family": "gaussian", "link": "identity", "maxIter": 10, "regParam": 0.3},
    ),
    "decision_tree": ModelSpec("Decision tree regression", R.DecisionTreeRegressor),
    "random_forest": ModelSpec("Random forest regression", R.RandomForestRegressor),
    "gbt": ModelSpec("Gradient-boosted tree regression", R.GBTRegressor, params={"maxIter": 10}),
    "aft": ModelSpec(
        "Survival regression",
        R.AFTSurvivalRegression,
        params={"quantileProbabilities": [0.3, 0.6], "quantilesCol": "quantiles"},
    ),
    "isotonic": ModelSpec("Isotonic regression", R.IsotonicRegression),
}


def fit_predict(
    estimator: Estimator, train: DataFrame, test: DataFrame
) -> tuple[Model, DataFrame]:
    """Fit on ``train``, add predictions to ``test``.

    A fit reads its rows several times, so they are kept until it ends. The shared folder is set
    up first: boosted trees cut their lineage there.
    """
    shared_folder(train.sparkSession)
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.fit(kept)
    finally:
        kept.unpersist()
    return model, model.transform(test)

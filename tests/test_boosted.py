import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import boosted, tuning
from tabloom.operators.boosted import boost, candidate_cuts, cells_of, fold_cells, takes_cells
from tabloom.operators.features import feature_pipeline
from tabloom.operators.models import CLASSIFIERS
from tabloom.operators.tuning import cross_validate


def table(spark, rows):
    """A feature with as many values as rows, one with five, one that is constant and a flag; labels follow from none."""
    return spark.range(rows).selectExpr(
        "id", "cast((id % 7 + id % 2 * 2) % 5 > 1 and id * 31 % 1009 > 300 as double) as label",
        "cast(id * 31 % 1009 as double) + id / 1e6 - 500 as x", "cast(id % 5 as double) as y", "1.0D as z", "cast(id % 2 as double) as flag",
    )


@pytest.fixture(scope="module")
def train(spark):
    return table(spark, 2000).localCheckpoint()


def features(df):
    prepared = feature_pipeline(["x", "y", "z", "flag"]).fit(df).transform(df)
    return prepared.select("label", "features").coalesce(1).localCheckpoint()


@pytest.mark.parametrize("rows, depth, bins", [(2000, 3, 32), (2000, 25, 32), (30_000, 5, 32), (2000, 4, 3), (20, 4, 32)])
def test_trees_of_cells_are_those_of_mllib(spark, rows, depth, bins):
    df = features(table(spark, rows))
    estimator = GBTClassifier(maxDepth=depth, maxIter=5, maxBins=bins, seed=3)
    cuts = candidate_cuts(estimator, df, None)
    found = cells_of(df, cuts, None).toPandas()
    cell = np.array([list(c) for c in found["cell"]])
    *_, score = boost(cell[:, 1:].T.copy(), cell[:, 0].astype(float), found["w"].to_numpy(), depth, 5, estimator.getStepSize())
    theirs = estimator.fit(df).transform(df).select(vector_to_array("rawPrediction")[1].alias("score")).toPandas()
    assert score == pytest.approx(theirs["score"].to_numpy(), abs=1e-9)
    assert len(cuts[2]) == 0 and len(cuts[3]) == 1


@pytest.mark.parametrize("measure", ["auc", "f1"])
def test_search_by_cells_has_the_metrics_of_mllibs_models(train, monkeypatch, measure):
    spec = CLASSIFIERS["gbt"].__class__(**CLASSIFIERS["gbt"].__dict__ | {"select_by": measure})
    grid = {"maxDepth": [1, 6], "maxIter": [3, 5]}
    options = {"folds": 3, "grid": grid, "prepare": feature_pipeline(["x", "y", "z", "flag"]).getStages()}
    fitted = []
    real = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, *a, **b: fitted.append(self) or real(self, *a, **b))
    found = cross_validate(spec, train, 4, ["id"], **options)
    assert len(fitted) == 1  # the best one, on all rows; it was seven with a fit of every fold and depth
    theirs = cross_validate(spec, train, 4, ["id"], keep_submodels=True, **options)
    assert len(fitted) == 1 + 7
    assert found.metrics == pytest.approx(theirs.metrics, abs=1e-9)
    assert (found.best, found.fits, found.parameters) == (theirs.best, theirs.fits, theirs.parameters)


def test_counted_folds_have_the_metrics_of_mllibs_models(spark, monkeypatch):
    monkeypatch.setattr(tuning, "ROWS_PER_PART", 500)
    df = table(spark, 3000).withColumn("x", F.floor(F.col("x") / 40).cast("double")).localCheckpoint()
    weights = []
    real = tuning.fold_cells
    monkeypatch.setattr(tuning, "fold_cells", lambda e, rows, *a: weights.append(tuning.WEIGHT in rows.columns) or real(e, rows, *a))
    options = {"folds": 2, "grid": {"maxDepth": [5], "maxIter": [2, 4]}, "prepare": feature_pipeline(["x", "y", "flag"]).getStages()}
    found = cross_validate(CLASSIFIERS["gbt"], df, 3, ["id"], **options)
    assert weights == [True, True]
    theirs = cross_validate(CLASSIFIERS["gbt"], df, 3, ["id"], keep_submodels=True, **options)
    assert found.metrics == pytest.approx(theirs.metrics, abs=1e-9)


def test_folds_with_too_many_cells_are_left_to_mllib(train, monkeypatch):
    options = {"folds": 2, "grid": {"maxDepth": [2]}, "prepare": feature_pipeline(["x", "flag"]).getStages()}
    found = cross_validate(CLASSIFIERS["gbt"], train, 2, ["id"], **options)
    monkeypatch.setattr(boosted, "MOST_SUMS", 100)
    monkeypatch.setattr(tuning, "boosted_scores", None)
    assert cross_validate(CLASSIFIERS["gbt"], train, 2, ["id"], **options).metrics == pytest.approx(found.metrics, abs=1e-9)


def test_only_trees_of_all_rows_and_features_take_cells(spark):
    def takes(**params):
        return takes_cells([GBTClassifier(**params)], 4)

    assert takes() and takes(maxDepth=30, stepSize=0.3, minInfoGain=0.01)
    assert not takes(subsamplingRate=0.5) and not takes(featureSubsetStrategy="sqrt") and not takes(minInstancesPerNode=2)
    assert not takes(minWeightFractionPerNode=0.1) and not takes(maxBins=300) and not takes(validationIndicatorCol="v")
    assert not takes_cells([GBTClassifier(maxBins=8), GBTClassifier(maxBins=9)], 4) and not takes_cells([GBTClassifier()], 1000)
    rows = features(table(spark, 50))
    assert fold_cells(GBTClassifier(), rows.where("label > 5"), rows, "w", "n") is None
    assert fold_cells(GBTClassifier(), rows.withColumn("label", F.col("label") * 2), rows, "w", "n") is None

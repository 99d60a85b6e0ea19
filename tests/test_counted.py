import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import counted as counted_module
from tabloom.operators import tuning
from tabloom.operators.counted import fit_counted_perceptron, loss_and_gradient, takes_counts
from tabloom.operators.features import feature_pipeline
from tabloom.operators.models import CLASSIFIERS
from tabloom.operators.tuning import cross_validate


@pytest.fixture(scope="module")
def train(spark):
    """28 different rows, of which no label follows from the features alone."""
    return spark.range(6000).selectExpr(
        "id", "cast((id % 7 + id % 2 * 2) % 5 > 1 and id % 11 > 2 as double) as label", "cast(id % 7 as double) as x", "cast(id % 2 as double) as y"
    )


@pytest.fixture(scope="module")
def counted(train):
    prepared = feature_pipeline(["x", "y"]).fit(train).transform(train)
    return tuning.counted_rows(prepared.select("label", "features")).localCheckpoint()


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    layers, x = [3, 4, 2, 3], rng.normal(size=(7, 3))
    label, weight = np.array([0.0, 1, 2, 0, 1, 2, 2]), rng.integers(1, 9, 7).astype(float)
    w = rng.normal(size=3 * 4 + 4 + 4 * 2 + 2 + 2 * 3 + 3)
    found = loss_and_gradient(w, layers, x, label, weight)
    for i in range(len(w)):
        up, down = w.copy(), w.copy()
        up[i], down[i] = up[i] + 1e-6, down[i] - 1e-6
        slope = (loss_and_gradient(up, layers, x, label, weight)[0] - loss_and_gradient(down, layers, x, label, weight)[0]) / 2e-6
        assert found[1 + i] == pytest.approx(slope, abs=1e-5)


@pytest.mark.parametrize("iterations", [1, 5, 20])
def test_counted_perceptron_takes_the_steps_of_mllib(spark, counted, iterations):
    # In blocks of one row MLlib's loss is the mean over all rows.
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(tuning.COUNT)))).drop("copy").coalesce(2)
    estimator = MultilayerPerceptronClassifier(layers=[2, 5, 4, 2], maxIter=iterations, seed=3, blockSize=1, tol=1e-9)
    plain = estimator.fit(copies)
    rows = counted.withColumn("w", F.col(tuning.COUNT).cast("double"))
    found = fit_counted_perceptron(estimator, rows, "w")
    np.testing.assert_allclose(found.weights.toArray(), plain.weights.toArray(), rtol=1e-5, atol=1e-5)
    assert found.getMaxIter() == iterations and found.transform(counted).count() == counted.count()


def test_few_counted_rows_are_fitted_in_one_task_with_the_same_steps(spark, counted, monkeypatch):
    rows = counted.withColumn("w", F.col(tuning.COUNT).cast("double")).repartition(3, "label", "features")
    estimator = MultilayerPerceptronClassifier(layers=[2, 5, 4, 2], maxIter=30, seed=3, tol=1e-12)
    jobs, found = [], []
    for most in (counted_module.MOST_OUTPUTS, 0):
        monkeypatch.setattr(counted_module, "MOST_OUTPUTS", most)
        spark.sparkContext.setJobGroup(f"perceptron {most}", "")
        found.append(fit_counted_perceptron(estimator, rows, "w").weights.toArray())
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"perceptron {most}")))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs[0] < 30 < jobs[1]  # a job for each step before
    np.testing.assert_allclose(found[0], found[1], rtol=1e-9)


def test_what_takes_no_counts():
    build = CLASSIFIERS["random_forest"].build
    assert takes_counts(build(2)) and not takes_counts(build(2, minInstancesPerNode=3))
    assert takes_counts(CLASSIFIERS["mlp"].build(2)) and not takes_counts(CLASSIFIERS["mlp"].build(2, solver="gd"))


@pytest.mark.parametrize("name", ["random_forest", "mlp"])
def test_searches_of_large_folds_read_counted_rows(spark, monkeypatch, train, name):
    spec, sizes = CLASSIFIERS[name], []
    build = spec.estimator.fit

    def fit(self, rows, params=None):
        sizes.append(rows.count())
        return build(self, rows, params) if params else build(self, rows)

    monkeypatch.setattr(spec.estimator, "fit", fit)
    grid = {"numTrees": [5, 20], "maxDepth": [4]} if name == "random_forest" else {"maxIter": [5, 20]}
    # In blocks of one row a perceptron's loss is the mean over all rows; in longer ones, rows of the last block count more.
    options = {"blockSize": 1} if name == "mlp" else {}
    stages = feature_pipeline(["x", "y"]).getStages()
    plain = cross_validate(spec, train, 2, "id", folds=2, grid=grid, prepare=stages, **options)
    assert min(sizes) > 2500
    sizes.clear()
    monkeypatch.setattr(tuning, "ROWS_PER_PART", 500)
    monkeypatch.setattr(tuning, "MOST_WEIGHT", 1 / 50)
    monkeypatch.setattr(tuning, "DRAWN_ROWS", 1000)
    found = cross_validate(spec, train, 2, "id", folds=2, grid=grid, prepare=stages, **options)
    assert max(sizes) <= (28 + 1600 if name == "random_forest" else 28 + 60)
    np.testing.assert_allclose(found.metrics, plain.metrics, atol=0.02 if options == {} else 1e-6)  # other draws of a forest
    assert found.model.transform(train).select(vector_to_array("probability")[1]).count() == 6000

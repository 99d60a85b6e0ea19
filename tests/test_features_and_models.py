import numpy as np
import pytest
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import tuning
from tabloom.operators.features import assembler, feature_frames, feature_pipeline, scaled_regression, scaler
from tabloom.operators.models import CLASSIFIERS, REGRESSORS, fit_predict
from tabloom.operators.split import fold_number
from tabloom.operators.tuning import best_parameters, cross_validate
from tabloom.schemas import FEATURES
from tabloom.sources.shared import training_table


def test_assembling_a_null_raises(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        assembler(["a", "b"]).transform(df).collect()


def test_scaling_divides_by_sample_deviation_and_zeroes_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaled = feature_pipeline(["a", "b"]).fit(df).transform(df)
    got = np.array([r[0] for r in scaled.select(vector_to_array("features")).collect()])
    np.testing.assert_allclose(got[:, 0], np.array([1, 2, 4]) / np.std([1, 2, 4], ddof=1))
    assert (got[:, 1] == 0).all()


def test_the_scaler_sees_only_training_rows(spark):
    train = spark.createDataFrame([(0, 1.0), (1, 3.0)], "k int, a double")
    test = spark.createDataFrame([(2, 100.0)], "k int, a double")
    _, (_, scaled) = feature_frames(train, [test], ["a"])
    assert scaled.columns == ["k", "features"]
    assert scaled.first()["features"][0] == pytest.approx(100 / np.sqrt(2))


def test_regression_predicts_every_row(people):
    labelled = people.withColumnRenamed("Survived", "label")
    model, predictions = scaled_regression(labelled, FEATURES)
    assert predictions.count() == people.count()
    rmse = RegressionEvaluator(metricName="rmse").evaluate(predictions)
    assert rmse < labelled.agg(F.stddev_pop("label")).first()[0]
    assert model.stages[-1].getRegParam() == 0.01


# The outcome expected of each model on the small table.
@pytest.mark.parametrize("name", [n for n in CLASSIFIERS if n != "naive_bayes"])
def test_classifiers_beat_chance_and_repeat(frames, name):
    train, test = frames
    estimator = CLASSIFIERS[name].build(len(FEATURES))
    _, first = fit_predict(estimator, train, test)
    _, again = fit_predict(CLASSIFIERS[name].build(len(FEATURES)), train, test)
    columns = ["PassengerId", "prediction"]
    assert first.count() == test.count()
    assert first.select(columns).exceptAll(again.select(columns)).isEmpty()
    assert MulticlassClassificationEvaluator(metricName="accuracy").evaluate(first) > 0.75
    if CLASSIFIERS[name].measures[0] == "auc":
        assert BinaryClassificationEvaluator(numBins=0).evaluate(first) > 0.8
    assert ("probability" in first.columns) == (name != "svc")


def test_naive_bayes_needs_features_that_are_not_negative(frames, spark):
    train, test = frames
    _, predictions = fit_predict(CLASSIFIERS["naive_bayes"].build(len(FEATURES)), train, test)
    assert MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predictions) > 0.6
    df = spark.createDataFrame([(0.0, -1.0), (1.0, 1.0)], "label double, a double")
    with pytest.raises(Exception, match="(?i)negative"):
        CLASSIFIERS["naive_bayes"].build(1).fit(assembler(["a"], "features").transform(df))


def test_perceptron_has_one_output_per_class(frames):
    train, test = frames
    for classes in (2, 3):
        estimator = CLASSIFIERS["mlp"].build(len(FEATURES), classes, maxIter=2)
        assert estimator.getLayers() == [12, 5, 4, classes]
        _, predictions = fit_predict(estimator, train, test)
        assert len(predictions.first()["probability"]) == classes


def test_boosting_depth_has_a_limit(frames):
    with pytest.raises(IllegalArgumentException):
        CLASSIFIERS["gbt"].build(12, maxDepth=31).fit(frames[0])


def test_seeds_are_set():
    assert CLASSIFIERS["gbt"].build(12, seed=7).getSeed() == 7
    assert REGRESSORS["random_forest"].build(12, seed=7).getSeed() == 7
    assert CLASSIFIERS["logistic"].build(12).getMaxIter() == 100
    assert CLASSIFIERS["random_forest"].build(12).getNumTrees() == 20


@pytest.mark.parametrize("name", ["linear", "generalized_linear", "decision_tree", "random_forest"])
def test_regressors(frames, name):
    train, test = frames
    _, predictions = fit_predict(REGRESSORS[name].build(len(FEATURES)), train, test)
    assert predictions.where("prediction IS NULL").isEmpty()
    assert RegressionEvaluator(metricName="mae").evaluate(predictions) < 0.6


def test_full_grids_have_the_expected_sizes():
    sizes = {n: int(np.prod([len(v) for v in s.grid.values()])) for n, s in CLASSIFIERS.items() if s.grid}
    assert sizes == {"logistic": 60, "random_forest": 12, "gbt": 16, "decision_tree": 6}
    assert CLASSIFIERS["mlp"].grid == {} and CLASSIFIERS["naive_bayes"].grid is None


def test_search_repeats_on_any_partitioning_and_reports_the_best(frames):
    train, _ = frames
    spec, grid = CLASSIFIERS["logistic"], {"regParam": [0.0, 0.5], "elasticNetParam": [1.0], "maxIter": [5]}
    results = [
        cross_validate(spec, part, 12, "PassengerId", folds=3, grid=grid, keep_submodels=True)
        for part in (train.repartition(1), train.repartition(5))
    ]
    one, other = results
    np.testing.assert_allclose(one.metrics, other.metrics, atol=1e-6)
    assert one.parameters == "regParam: 0.0 - MaxIter: 5 - elasticNetParam: 1.0" and one.best == 0
    assert len(one.submodels) == 3 and len(one.submodels[0]) == 2 and one.fits == 6


def test_search_equals_a_loop_of_fits_and_evaluators(frames, monkeypatch):
    train, _ = frames
    fitted = []
    original = Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, rows: fitted.append(1) or original(self, rows))
    grids = {
        "logistic": {"regParam": [0.0, 0.3], "maxIter": [1, 5]},
        "gbt": {"maxDepth": [1, 3], "maxIter": [2, 5, 3]},
        "decision_tree": {"maxDepth": [2, 4]},
    }
    stages = [scaler("features", "features_2")]
    for name, grid in grids.items():
        fitted.clear()
        spec = CLASSIFIERS[name]
        found = cross_validate(spec, train, 12, "PassengerId", folds=2, grid=grid, prepare=stages)
        assert len(fitted) == 3  # one for each fold and one for the last fit, however many maps there are
        assert found.fits == 2 * (2 if name == "gbt" else len(found.maps))
        numbered = train.withColumn("fold", fold_number(2, 1, "PassengerId"))
        judge = BinaryClassificationEvaluator(numBins=0) if spec.select_by == "auc" else MulticlassClassificationEvaluator(metricName="f1")
        for values, metric in zip(found.maps, found.metrics):
            each = []
            for fold in range(2):
                rows = training_table(numbered.where(F.col("fold") != fold).select("label", "features"), tuning.ROWS_PER_PART)
                model = spec.build(12, **values).fit(rows)
                each.append(judge.evaluate(model.transform(numbered.where(F.col("fold") == fold))))
            assert metric == pytest.approx(np.mean(each), abs=1e-9), (name, values)


def test_folds_of_few_different_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(tuning, "ROWS_PER_PART", 500)
    sizes = []
    build = CLASSIFIERS["decision_tree"].estimator.fit

    def fit(self, rows, params=None):
        sizes.append(sorted(len(part) for part in rows.rdd.glom().collect()))
        return build(self, rows, params) if params else build(self, rows)

    monkeypatch.setattr(CLASSIFIERS["decision_tree"].estimator, "fit", fit)
    train = spark.range(4000).selectExpr("id", "cast(id % 2 as double) as label", "cast(id % 2 as double) as x")
    found = cross_validate(
        CLASSIFIERS["decision_tree"], train, 1, "id", folds=2, grid={"maxDepth": [1]}, prepare=feature_pipeline(["x"]).getStages()
    )
    assert found.metrics == [1.0]
    # By the label alone two parts would have all rows of a fold.
    assert all(len(found) > 3 and found[0] > 300 and found[-1] < 700 for found in sizes[:2])


@pytest.mark.parametrize("name", ["logistic", "decision_tree", "gbt"])
def test_large_folds_are_fitted_on_counted_rows(spark, monkeypatch, name):
    spec, sizes = CLASSIFIERS[name], []
    build = spec.estimator.fit

    def fit(self, rows, params=None):
        sizes.append(rows.count())
        return build(self, rows, params) if params else build(self, rows)

    monkeypatch.setattr(spec.estimator, "fit", fit)
    # 28 different rows, of which no label follows from the features alone.
    train = spark.range(6000).selectExpr(
        "id", "cast((id % 7 + id % 2 * 2) % 5 > 1 and id % 11 > 2 as double) as label", "cast(id % 7 as double) as x", "cast(id % 2 as double) as y"
    )
    grid = {"maxIter": [5, 10]} if name != "decision_tree" else {"maxDepth": [1, 3]}
    stages = feature_pipeline(["x", "y"]).getStages()
    plain = cross_validate(spec, train, 2, "id", folds=2, grid=grid, prepare=stages)
    assert min(sizes) > 2500
    sizes.clear()
    monkeypatch.setattr(tuning, "ROWS_PER_PART", 500)
    monkeypatch.setattr(tuning, "MOST_WEIGHT", 1 / 50)
    counted = cross_validate(spec, train, 2, "id", folds=2, grid=grid, prepare=stages)
    assert max(sizes) <= 28 + 60
    # Few heavy rows: the deviations that a regression scales by differ by half of the greatest weight, as stated.
    np.testing.assert_allclose(counted.metrics, plain.metrics, atol=1e-6)
    assert (counted.best, counted.parameters) == (plain.best, plain.parameters)


def test_weights_of_counted_rows_add_up(spark):
    rows = spark.createDataFrame([(0.0, 7), (1.0, 1), (2.0, 1000)], f"label double, {tuning.COUNT} long")
    found = tuning.weighted_rows(rows, 1008 * 100).collect()
    sums = {}
    for r in found:
        assert r[tuning.WEIGHT] == int(r[tuning.WEIGHT]) and 1 <= r[tuning.WEIGHT] <= 10
        sums[r["label"]] = sums.get(r["label"], 0) + r[tuning.WEIGHT]
    assert sums == {0.0: 7, 1.0: 1, 2.0: 1000}
    assert len({r[tuning.DEAL] for r in found}) == len(found)


def test_a_shorter_boosted_model_is_the_beginning_of_a_longer_one(frames):
    train, test = frames
    spec = CLASSIFIERS["gbt"]
    longest = spec.build(12, maxDepth=4, maxIter=6).fit(train)
    for measure, columns in (("auc", "rawPrediction"), ("f1", "prediction")):
        scored = tuning.prefix_scores(test, longest, [1, 4, 6], measure, ["a", "b", "c"])
        assert [c for c in scored.columns if "tree" in c] == []
        for length, out in ((1, "a"), (4, "b"), (6, "c")):
            short = spec.build(12, maxDepth=4, maxIter=length).fit(train).transform(scored)
            value = vector_to_array(columns)[1] if measure == "auc" else F.col(columns)
            assert short.where(F.abs(value - F.col(out)) > 1e-12).isEmpty()


def test_report_texts(frames):
    train, _ = frames
    small = {"maxDepth": 2, "maxBins": 20, "numTrees": 2}
    forest = CLASSIFIERS["random_forest"].build(12, **small).fit(train)
    assert best_parameters(CLASSIFIERS["random_forest"], forest) == "maxDepth: 2 - maxBins: 20 - numTrees: 2"
    boosted = CLASSIFIERS["gbt"].build(12, maxDepth=1, maxIter=2).fit(train)
    assert best_parameters(CLASSIFIERS["gbt"], boosted) == "maxDepth: 1 - maxIter: 2"
    tree = CLASSIFIERS["decision_tree"].build(12, maxDepth=2, maxBins=4).fit(train)
    assert best_parameters(CLASSIFIERS["decision_tree"], tree) == "maxDepth: 2 - maxBins: 4"


def test_empty_grid_is_one_entry(frames):
    spec = CLASSIFIERS["mlp"]
    found = cross_validate(spec, frames[0], 12, "PassengerId", folds=2)
    assert len(found.metrics) == 1 and found.maps == [{}] and found.parameters == "unspecified"

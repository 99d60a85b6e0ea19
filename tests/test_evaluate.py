import numpy as np
import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import evaluate
from tabloom.operators.evaluate import confidence_summary, roc_curve, thin_roc
from tabloom.operators.models import CLASSIFIERS


@pytest.fixture(scope="module")
def scores(spark):
    """A third of all rows share one score."""
    return spark.range(0, 3000, 1, 4).select(
        ((F.col("id") * 17 % 23) > 11).cast("double").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.5)
        .otherwise((F.col("id") * 17 % 23 + F.col("id") * 31 % 19) / 50)
        .alias("score"),
        (F.col("id") * 7 % 5).cast("double").alias("a"),
        (F.col("id") * 3 % 5).cast("double").alias("b"),
    )


@pytest.mark.parametrize("rows_per_range", [1_000_000, 10])
def test_area_equals_the_exact_evaluator(scores, rows_per_range):
    area = evaluate.area_under_roc(scores, rows_per_range=rows_per_range).first()["auc"]
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scores)
    assert area == pytest.approx(exact, abs=1e-12)


def test_area_of_one_class_is_null(scores):
    assert evaluate.area_under_roc(scores.where("label = 1")).first()["auc"] is None
    assert evaluate.area_under_roc(scores.limit(0)).first()["auc"] is None


@pytest.mark.parametrize("rows_per_range", [1_000_000, 10])
def test_curve_rises_from_corner_to_corner_and_spans_the_area(scores, rows_per_range):
    curve = evaluate.roc_curve(scores, rows_per_range=rows_per_range).toPandas()
    curve = curve.sort_values(["FPR", "TPR"])
    assert len(curve) == scores.select("score").distinct().count() + 1
    assert tuple(curve.iloc[0][["FPR", "TPR"]]) == (0.0, 0.0)
    assert tuple(curve.iloc[-1][["FPR", "TPR"]]) == (1.0, 1.0)
    assert np.isnan(curve.iloc[0]["threshold"])
    area = np.trapezoid(curve["TPR"], curve["FPR"])
    assert area == pytest.approx(evaluate.area_under_roc(scores).first()["auc"], abs=1e-12)


def test_curve_equals_the_one_of_a_model_summary(frames):
    train, _ = frames
    columns = ["female", "low", "high"]
    short = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        train.select("label", F.round(F.rand(1) * 20 + 5 * F.col("label")).alias("x"))
    )
    model = CLASSIFIERS["logistic"].build(len(columns)).fit(short)
    points = {(round(r["FPR"], 9), round(r["TPR"], 9)) for r in model.summary.roc.collect()}
    scored = model.transform(short).select("label", F.expr("x").alias("score"))
    curve = evaluate.roc_curve(scored)
    assert {(round(r["FPR"], 9), round(r["TPR"], 9)) for r in curve.collect()} == points


def test_accuracy_and_f1_equal_the_evaluator(scores):
    for name, operator in (("accuracy", evaluate.accuracy), ("f1", evaluate.weighted_f1)):
        expected = MulticlassClassificationEvaluator(
            labelCol="a", predictionCol="b", metricName=name
        ).evaluate(scores)
        assert operator(scores, "a", "b").first()[0] == pytest.approx(expected, abs=1e-12)


def test_f1_with_classes_never_predicted_or_never_labelled(spark):
    rows = [(0.0, 0.0), (1.0, 0.0), (0.0, 2.0), (1.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    expected = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert evaluate.weighted_f1(df).first()["f1"] == pytest.approx(expected)


def test_regression_metrics_equal_the_evaluator(scores):
    row = evaluate.regression_metrics(scores, "a", "b").first()
    for name in ("rmse", "mae", "r2"):
        expected = RegressionEvaluator(
            labelCol="a", predictionCol="b", metricName=name
        ).evaluate(scores)
        assert row[name] == pytest.approx(expected)


def test_confidence_takes_all_classes(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0.7), (0.6, 0.3, 0.1)], "a double, b double, c double")
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="probability").transform(df)
    assert [r[0] for r in vectors.select(evaluate.confidence()).collect()] == [0.7, 0.6]


def test_summary_is_the_box_of_each_model(scores):
    df = scores.select(F.lit("m").alias("model"), F.col("score").alias("confidence"))
    row = evaluate.confidence_summary(df, rows_per_range=9).first()
    expected = np.quantile(df.toPandas()["confidence"], [0, 0.25, 0.5, 0.75, 1])
    np.testing.assert_allclose([row[c] for c in evaluate.BOX], expected)
    assert row["n"] == 3000


@pytest.mark.parametrize("cells", [1, 10, 100])
def test_thinned_curve_is_small_and_its_area_near(spark, cells):
    score = (F.col("id") * 7919 % 20011).cast("double")
    rows = spark.range(20_000).select(
        score.alias("score"), F.when(score + F.col("id") * 31 % 9973 > 14_000, 1.0).otherwise(0.0).alias("label")
    )

    def area(points):
        found = sorted((r["FPR"], r["TPR"]) for r in points.collect())
        return len(found), sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(found, found[1:]))

    curve = roc_curve(rows)
    whole, thin = area(curve), area(thin_roc(curve, cells))
    assert whole[0] == 20_001 and thin[0] <= 4 * cells + 2
    assert abs(whole[1] - thin[1]) <= 1 / (2 * cells)
    ends = [tuple(r) for r in thin_roc(curve, cells).where("FPR = 0 AND TPR = 0 OR FPR = 1 AND TPR = 1").collect()]
    assert (None, 0.0, 0.0) in ends and any(e[1:] == (1.0, 1.0) for e in ends)


def test_thinned_curve_of_one_class(spark):
    rows = spark.createDataFrame([(1.0, 0.1), (1.0, 0.9)], "label double, score double")
    assert {r["TPR"] for r in thin_roc(roc_curve(rows), 10).collect()} == {0.0, 0.5, 1.0}


def test_sketched_box_keeps_its_rank_error(spark):
    rows = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise(None).alias("model"),
        ((F.col("id") * 7919 % 60_013) / 7.0).alias("confidence"),
    )
    values = {m: sorted(r["confidence"] for r in rows.where(F.col("model").eqNullSafe(m)).collect()) for m in ("a", None)}
    boxes = {r["model"]: r for r in confidence_summary(rows, method="sketch", rank_error=0.01).collect()}
    assert boxes.keys() == values.keys()
    for model, box in boxes.items():
        known = values[model]
        assert box["n"] == len(known)
        assert (box["minimum"], box["maximum"]) == (known[0], known[-1])
        for name, share in (("lower_quartile", 0.25), ("median", 0.5), ("upper_quartile", 0.75)):
            assert abs(known.index(box[name]) / len(known) - share) <= 0.01 + 1 / len(known)
    with pytest.raises(ValueError):
        confidence_summary(rows, method="guess")


def test_counted_rows_have_the_metrics_of_their_rows(spark):
    rows = [("a", 1.0, 0.9, 3), ("a", 0.0, 0.9, 2), ("a", 0.0, 0.1, 5), ("a", 1.0, 0.1, 1), ("b", 1.0, 0.5, 4), ("b", 0.0, 0.2, 1)]
    counted = spark.createDataFrame(rows, "m string, label double, score double, n long").withColumn("prediction", F.round("score"))
    single = counted.selectExpr("m", "label", "score", "prediction", "explode(sequence(1, n)) as i")
    for metric in (evaluate.accuracy, evaluate.weighted_f1, evaluate.area_under_roc):
        for by in ([], ["m"]):
            assert sorted(metric(counted, by=by, count="n").collect()) == sorted(metric(single, by=by).collect())

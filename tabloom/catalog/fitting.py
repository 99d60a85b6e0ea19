"""Feature vectors and fitted models.

Where a model on few distinct feature vectors must give the mean or the majority of the training
rows with the same features, its twin computes just that; other models have none.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.cleaning import passenger_key
from tabloom.catalog.registry import ENCODED_CTE, PART_SQL, query, rounded, with_p
from tabloom.operators import evaluate
from tabloom.operators.evaluate import confidence
from tabloom.operators.features import (
    assembler,
    feature_pipeline,
    scaled_regression,
    to_label,
)
from tabloom.operators.models import CLASSIFIERS, REGRESSORS, fit_predict
from tabloom.operators.split import hash_split
from tabloom.plans.clean import clean, encode
from tabloom.plans.compare import train_and_test
from tabloom.schemas import DUMMIES, FEATURES
from tabloom.sources.passengers import passengers, table
from tabloom.sources.shared import training_table

CELL = ["female", "low", "mid", "Very_low", "very_high", "high"]
NUMBERS = ["Fare", "SibSp", "Pclass"]
CELL_SQL = 'female, low, mid, "Very_low", "very_high", high'
SPLIT_CTE = f"s AS (SELECT *, {PART_SQL} AS part FROM e)"
CELLS_CTE = f"m AS (SELECT {CELL_SQL}, avg(Survived) AS mean FROM s WHERE part = 0 GROUP BY ALL)"
CELL_MEAN_SQL = with_p(
    f"""SELECT PassengerId, Survived AS label, round(mean, 6) AS prediction
 FROM s JOIN m USING ({CELL_SQL}) WHERE part = 1""",
    ENCODED_CTE,
    SPLIT_CTE,
    CELLS_CTE,
)
CELL_MAJORITY_SQL = with_p(
    f"""SELECT PassengerId, Survived AS label, CAST(mean > 0.5 AS DOUBLE) AS prediction
 FROM s JOIN m USING ({CELL_SQL}) WHERE part = 1""",
    ENCODED_CTE,
    SPLIT_CTE,
    CELLS_CTE,
)


def parts(spark, sf_dir, features=FEATURES):
    """Scaled train and test rows of the stored clean table; ages are filled only if they are used."""
    raw = passengers(spark, sf_dir)
    df = clean(raw, "mean", ["PassengerId"]) if "Age" in features else encode(raw, ["PassengerId"])
    return train_and_test(training_table(df), passenger_key(), features, keys=["PassengerId"])


def _classify(spark, sf_dir, name, features=FEATURES, **overrides):
    train, test = parts(spark, sf_dir, features)
    estimator = CLASSIFIERS[name].build(len(features), **overrides)
    return fit_predict(estimator, train, test)[1]


def _classified(spark, sf_dir, name, **overrides):
    predictions = _classify(spark, sf_dir, name, **overrides)
    columns = ["PassengerId", "label", "prediction"]
    if "probability" in predictions.columns:
        predictions = predictions.withColumn("confidence", F.round(confidence(), 6))
        columns.append("confidence")
    return predictions.select(*columns)


def _regressed(spark, sf_dir, name, features=CELL, **overrides):
    train, test = parts(spark, sf_dir, features)
    predictions = fit_predict(REGRESSORS[name].build(len(features), **overrides), train, test)[1]
    return rounded(predictions.select("PassengerId", "label", "prediction"), ["prediction"])


@query(
    "assemble",
    with_p("SELECT PassengerId, round(Fare, 6) AS Fare, SibSp, Pclass, 3 AS width FROM p"),
)
def assemble(spark, sf_dir):
    df = assembler(NUMBERS, "vector").transform(passengers(spark, sf_dir))
    array = vector_to_array("vector")
    values = [F.round(array[i], 6).alias(c) for i, c in enumerate(NUMBERS)]
    return df.select("PassengerId", *values, F.size(array).alias("width"))


@query(
    "standard_scale",
    with_p(
        """SELECT PassengerId, round(Fare / stddev_samp(Fare) OVER (), 6) AS Fare,
 round(SibSp / stddev_samp(SibSp) OVER (), 6) AS SibSp,
 round(Pclass / stddev_samp(Pclass) OVER (), 6) AS Pclass FROM p"""
    ),
)
def standard_scale(spark, sf_dir):
    df = passengers(spark, sf_dir).select("PassengerId", *NUMBERS)
    scaled = feature_pipeline(NUMBERS).fit(df).transform(df)
    array = vector_to_array("features")
    values = [F.round(array[i], 6).alias(c) for i, c in enumerate(NUMBERS)]
    return scaled.select("PassengerId", *values)


@query(
    "linear_regression",
    with_p(
        """SELECT PassengerId, Survived AS label,
 round(regr_intercept(Survived, Fare) OVER () + regr_slope(Survived, Fare) OVER () * Fare, 6)
 AS prediction FROM p"""
    ),
)
def linear_regression(spark, sf_dir):
    df = to_label(passengers(spark, sf_dir), "Survived", ["Fare"], ["PassengerId"])
    _, predictions = scaled_regression(df, ["Fare"], reg_param=0.0, solver="normal")
    return rounded(predictions.select("PassengerId", "label", "prediction"), ["prediction"])


# The penalty shrinks the slope of the standardized columns, so the mean point stays on the line.
@query(
    "linear_regression_ridge",
    with_p(
        """SELECT PassengerId, Survived AS label, round(avg(Survived) OVER ()
 + regr_slope(Survived, Fare) OVER () / (1 + 0.01 / stddev_pop(Survived) OVER ())
 * (Fare - avg(Fare) OVER ()), 6) AS prediction FROM p"""
    ),
)
def linear_regression_ridge(spark, sf_dir):
    df = to_label(passengers(spark, sf_dir), "Survived", ["Fare"], ["PassengerId"])
    _, predictions = scaled_regression(df, ["Fare"])
    return rounded(predictions.select("PassengerId", "label", "prediction"), ["prediction"])


@query("scaled_regression")
def scaled_regression_query(spark, sf_dir):
    df = to_label(
        clean(passengers(spark, sf_dir), "mean", ["PassengerId"]),
        "Survived",
        FEATURES,
        ["PassengerId"],
    )
    _, predictions = scaled_regression(df, FEATURES)
    return rounded(predictions.select("PassengerId", "label", "prediction"), ["prediction"])


@query("fit_logistic")
def fit_logistic(spark, sf_dir):
    return _classified(spark, sf_dir, "logistic")


@query(
    "fit_logistic_one_flag",
    with_p(
        """SELECT PassengerId, Survived AS label, round(mean, 4) AS probability
 FROM s JOIN m USING (female) WHERE part = 1""",
        ENCODED_CTE,
        SPLIT_CTE,
        "m AS (SELECT female, avg(Survived) AS mean FROM s WHERE part = 0 GROUP BY female)",
    ),
)
def fit_logistic_one_flag(spark, sf_dir):
    predictions = _classify(spark, sf_dir, "logistic", ["female"])
    positive = F.round(vector_to_array("probability")[1], 4).alias("probability")
    return predictions.select("PassengerId", "label", positive)


# At the optimum the predicted probabilities and the labels agree in the mean of every feature.
MOMENTS = [c for c in FEATURES if c != "Age"]


@query(
    "fit_logistic_moments",
    with_p(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg("{c}" * Survived), 3) AS mean FROM s WHERE part = 0"""
            for c in MOMENTS
        ),
        ENCODED_CTE,
        SPLIT_CTE,
    ),
)
def fit_logistic_moments(spark, sf_dir):
    raw = encode(passengers(spark, sf_dir), ["PassengerId"])
    train = training_table(
        to_label(hash_split(raw, [0.7, 0.3], 1, passenger_key())[0], "Survived", MOMENTS)
    )
    estimator = CLASSIFIERS["logistic"].build(len(MOMENTS), maxIter=500, tol=1e-12)
    stages = [*feature_pipeline(MOMENTS).getStages(), estimator]
    fitted = fit_predict(Pipeline(stages=stages), train, train)[1]
    positive = vector_to_array("probability")[1]
    means = fitted.agg(*[F.round(F.avg(F.col(c) * positive), 3).alias(c) for c in MOMENTS])
    return means.unpivot([], MOMENTS, "feature", "mean")


# Labels that are a function of the features: every test row must be predicted right.
FLAG_SQL = with_p(
    "SELECT PassengerId, female AS label, female AS prediction FROM s WHERE part = 1", ENCODED_CTE, SPLIT_CTE
)
XOR_SQL = with_p(
    """SELECT PassengerId, label, label AS prediction
 FROM (SELECT *, CAST((female = 1) <> (low = 1) AS DOUBLE) AS label FROM s) WHERE part = 1""",
    ENCODED_CTE,
    SPLIT_CTE,
)


def _function_of_flags(spark, sf_dir, name, target, features, **overrides):
    df = encode(passengers(spark, sf_dir), ["PassengerId"]).withColumn("target", target)
    frames = train_and_test(training_table(df), passenger_key(), features, "target", ["PassengerId"])
    predictions = fit_predict(CLASSIFIERS[name].build(len(features), **overrides), *frames)[1]
    return predictions.select("PassengerId", "label", "prediction")


@query("fit_svc_flag", FLAG_SQL)
def fit_svc_flag(spark, sf_dir):
    return _function_of_flags(spark, sf_dir, "svc", F.col("female"), ["female", "low", "high"])


@query("fit_mlp_xor", XOR_SQL)
def fit_mlp_xor(spark, sf_dir):
    target = (F.col("female") != F.col("low")).cast("double")
    return _function_of_flags(spark, sf_dir, "mlp", target, ["female", "low"], maxIter=400, seed=2)


@query("fit_random_forest")
def fit_random_forest(spark, sf_dir):
    return _classified(spark, sf_dir, "random_forest")


@query("fit_gbt")
def fit_gbt(spark, sf_dir):
    return _classified(spark, sf_dir, "gbt")


@query("fit_decision_tree")
def fit_decision_tree(spark, sf_dir):
    return _classified(spark, sf_dir, "decision_tree")


def _cell_class(spark, sf_dir, name, **overrides):
    predictions = _classify(spark, sf_dir, name, CELL, **overrides)
    return predictions.select("PassengerId", "label", "prediction")


@query("fit_decision_tree_cells", CELL_MAJORITY_SQL)
def fit_decision_tree_cells(spark, sf_dir):
    return _cell_class(spark, sf_dir, "decision_tree")


@query("fit_random_forest_cells", CELL_MAJORITY_SQL)
def fit_random_forest_cells(spark, sf_dir):
    options = {"bootstrap": False, "featureSubsetStrategy": "all"}
    return _cell_class(spark, sf_dir, "random_forest", **options)


@query("fit_gbt_cells", CELL_MAJORITY_SQL)
def fit_gbt_cells(spark, sf_dir):
    return _cell_class(spark, sf_dir, "gbt")


@query("fit_mlp")
def fit_mlp(spark, sf_dir):
    return _classified(spark, sf_dir, "mlp")


@query("fit_mlp_three_outputs")
def fit_mlp_three_outputs(spark, sf_dir):
    return _classified(spark, sf_dir, "mlp", classes=3)


@query("fit_mlp_embeddings")
def fit_mlp_embeddings(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    size = F.size("embedding")
    least, width, top = df.agg(F.min(size), F.max(size), F.max("label")).first()
    if least != width:
        raise ValueError(f"vectors have {least} to {width} components")
    slots = [F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(width)]
    keys = [c for c in df.columns if c not in ("embedding", "label")][:1]
    names = [f"x{i}" for i in range(width)]
    flat = df.select(*keys, F.col("label").cast("double").alias("target"), *slots)
    train, test = train_and_test(flat, keys, names, "target", keys)
    estimator = CLASSIFIERS["mlp"].build(width, classes=int(top) + 1)
    predictions = fit_predict(estimator, train, test)[1]
    chosen = predictions.withColumn("confidence", F.round(confidence(), 6))
    return chosen.select(*keys, "label", "prediction", "confidence")


_FEATURES_SQL = ", ".join(f'"{c}"' for c in FEATURES)


# Features are scaled with the training rows, summed per class, and scored on the test rows.
@query(
    "fit_naive_bayes",
    with_p(
        """SELECT PassengerId, label, CAST(arg_max(class, score) AS DOUBLE) AS prediction,
 round(1 / sum(exp(score - top)), 6) AS confidence
 FROM (SELECT *, max(score) OVER (PARTITION BY PassengerId) AS top FROM r)
 GROUP BY PassengerId, label""",
        ENCODED_CTE,
        """g AS (SELECT * REPLACE (coalesce(Age, avg(Age) OVER (PARTITION BY Pclass)) AS Age) FROM e)""",
        f"s AS (SELECT *, {PART_SQL} AS part FROM g)",
        f"""w AS (SELECT PassengerId, Survived AS label, part, {_FEATURES_SQL} FROM s)""",
        f"u AS (UNPIVOT w ON {_FEATURES_SQL} INTO NAME feature VALUE amount)",
        """d AS (SELECT feature, stddev_samp(amount) AS deviation FROM u WHERE part = 0
 GROUP BY feature)""",
        """x AS (SELECT PassengerId, label, part, feature, amount / deviation AS amount
 FROM u JOIN d USING (feature))""",
        """t AS (SELECT label AS class, feature, sum(amount) AS total FROM x WHERE part = 0
 GROUP BY label, feature)""",
        "a AS (SELECT class, sum(total) AS whole FROM t GROUP BY class)",
        """n AS (SELECT label AS class, ln((count(*) + 1) / ((SELECT count(*) FROM s WHERE part = 0) + 2))
 AS pi FROM s JOIN (SELECT PassengerId, label FROM w) USING (PassengerId) WHERE part = 0 GROUP BY label)""",
        """r AS (SELECT x.PassengerId, x.label, t.class,
 any_value(n.pi) + sum(x.amount * ln((t.total + 1) / (a.whole + 12))) AS score
 FROM x JOIN t USING (feature) JOIN a USING (class) JOIN n USING (class) WHERE x.part = 1
 GROUP BY x.PassengerId, x.label, t.class)""",
    ),
)
def fit_naive_bayes(spark, sf_dir):
    return _classified(spark, sf_dir, "naive_bayes")


_NB_FEATURES = [*DUMMIES, "Pclass"]


@query(
    "naive_bayes_params",
    with_p(
        """SELECT t.label, t.feature, round(ln((t.total + 1) / (a.whole + 11)), 6) AS theta,
 round(ln((a.n + 1) / ((SELECT count(*) FROM e) + 2)), 6) AS pi
 FROM t JOIN a ON t.label = a.label""",
        ENCODED_CTE,
        "l AS (SELECT Survived AS label, {} FROM e)".format(
            ", ".join(f'"{c}"' for c in _NB_FEATURES)
        ),
        "u AS (UNPIVOT l ON {} INTO NAME feature VALUE amount)".format(
            ", ".join(f'"{c}"' for c in _NB_FEATURES)
        ),
        "t AS (SELECT label, feature, sum(amount) AS total FROM u GROUP BY label, feature)",
        """a AS (SELECT t.label, sum(total) AS whole, any_value(c.n) AS n FROM t JOIN
 (SELECT label, count(*) AS n FROM l GROUP BY label) c ON t.label = c.label GROUP BY t.label)""",
    ),
)
def naive_bayes_params(spark, sf_dir):
    labelled = to_label(encode(passengers(spark, sf_dir)), "Survived", _NB_FEATURES)
    vectors = assembler(_NB_FEATURES, "features").transform(labelled)
    model = CLASSIFIERS["naive_bayes"].build(len(_NB_FEATURES)).fit(vectors)
    theta, pi = model.theta.toArray(), model.pi.toArray()
    rows = [
        (float(label), feature, float(theta[label][i]), float(pi[label]))
        for label in range(len(pi))
        for i, feature in enumerate(_NB_FEATURES)
    ]
    schema = "label double, feature string, theta double, pi double"
    return rounded(spark.createDataFrame(rows, schema), ["theta", "pi"])


@query("fit_svc")
def fit_svc(spark, sf_dir):
    return _classified(spark, sf_dir, "svc")


@query(
    "fit_glr",
    with_p(
        """SELECT PassengerId, Survived AS label, round(middle + slope * (Fare - fare_mean), 6) AS prediction
 FROM s, m WHERE part = 1""",
        f"s AS (SELECT *, {PART_SQL} AS part FROM p)",
        """m AS (SELECT avg(Survived) AS middle, avg(Fare) AS fare_mean,
 regr_slope(Survived, Fare) / (1 + 0.3 / stddev_pop(Survived)) AS slope FROM s WHERE part = 0)""",
    ),
)
def fit_glr(spark, sf_dir):
    train, test = train_and_test(
        passengers(spark, sf_dir), passenger_key(), ["Fare"], keys=["PassengerId"]
    )
    estimator = REGRESSORS["generalized_linear"].build(1)
    predictions = fit_predict(estimator, train, test)[1]
    return rounded(predictions.select("PassengerId", "label", "prediction"), ["prediction"])


# Elastic net with one feature: the penalty's first part cuts the slope off, the second shrinks it.
@query(
    "fit_linear_one_feature",
    with_p(
        """SELECT PassengerId, Survived AS label, round(middle + slope * (Fare - fare_mean), 5) AS prediction
 FROM s, m WHERE part = 1""",
        f"s AS (SELECT *, {PART_SQL} AS part FROM p)",
        """m AS (SELECT avg(Survived) AS middle, avg(Fare) AS fare_mean, sign(corr(Survived, Fare))
 * greatest(abs(corr(Survived, Fare)) - 0.3 * 0.8 / stddev_pop(Survived), 0) / (1 + 0.3 * 0.2 / stddev_pop(Survived))
 * stddev_pop(Survived) / stddev_pop(Fare) AS slope FROM s WHERE part = 0)""",
    ),
)
def fit_linear_one_feature(spark, sf_dir):
    train, test = train_and_test(passengers(spark, sf_dir), passenger_key(), ["Fare"], keys=["PassengerId"])
    predictions = fit_predict(REGRESSORS["linear"].build(1, maxIter=100, tol=1e-12), train, test)[1]
    return rounded(predictions.select("PassengerId", "label", "prediction"), ["prediction"], 5)


@query("fit_linear")
def fit_linear(spark, sf_dir):
    return _regressed(spark, sf_dir, "linear", FEATURES)


@query("fit_dt_regressor", CELL_MEAN_SQL)
def fit_dt_regressor(spark, sf_dir):
    return _regressed(spark, sf_dir, "decision_tree")


@query("fit_rf_regressor")
def fit_rf_regressor(spark, sf_dir):
    return _regressed(spark, sf_dir, "random_forest", FEATURES)


@query("fit_rf_regressor_cells", CELL_MEAN_SQL)
def fit_rf_regressor_cells(spark, sf_dir):
    options = {"bootstrap": False, "featureSubsetStrategy": "all"}
    return _regressed(spark, sf_dir, "random_forest", **options)


@query("fit_gbt_regressor", CELL_MEAN_SQL)
def fit_gbt_regressor(spark, sf_dir):
    return _regressed(spark, sf_dir, "gbt")


@query("fit_aft")
def fit_aft(spark, sf_dir):
    df = passengers(spark, sf_dir).select(
        "PassengerId", F.col("Survived").alias("censor"), "Fare", "Pclass", "SibSp"
    )
    keys = ["PassengerId", "censor"]
    train, test = train_and_test(df, passenger_key(), ["Pclass", "SibSp"], "Fare", keys)
    predictions = fit_predict(REGRESSORS["aft"].build(2), train, test)[1]
    low, high = (F.round(vector_to_array("quantiles")[i], 6) for i in range(2))
    return rounded(
        predictions.select(*keys, "label", "prediction", low.alias("low"), high.alias("high")),
        ["label", "prediction"],
    )


@query(
    "roc_of_logistic",
    with_p(
        """SELECT round(threshold, 4) AS threshold, round(sum(n) OVER w / sum(n) OVER (), 6) AS "FPR",
 round(sum(pos) OVER w / sum(pos) OVER (), 6) AS "TPR" FROM c WINDOW w AS (ORDER BY threshold DESC)
 UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""",
        ENCODED_CTE,
        SPLIT_CTE,
        "m AS (SELECT female, avg(Survived) AS threshold FROM s WHERE part = 0 GROUP BY female)",
        """c AS (SELECT threshold, sum(Survived) AS pos, sum(1 - Survived) AS n
 FROM s JOIN m USING (female) WHERE part = 1 GROUP BY threshold)""",
    ),
)
def roc_of_logistic(spark, sf_dir):
    predictions = _classify(spark, sf_dir, "logistic", ["female"])
    scored = predictions.select("label", vector_to_array("probability")[1].alias("score"))
    curve = rounded(evaluate.roc_curve(scored), ["threshold"], 4)
    return rounded(curve, ["FPR", "TPR"])


@query(
    "metrics_of_tree_regressor",
    with_p(
        f"""SELECT round(sqrt(avg((Survived - mean) ** 2)), 6) AS rmse, round(avg(abs(Survived - mean)), 6) AS mae,
 round(1 - avg((Survived - mean) ** 2) / var_pop(Survived), 6) AS r2
 FROM s JOIN m USING ({CELL_SQL}) WHERE part = 1""",
        ENCODED_CTE,
        SPLIT_CTE,
        CELLS_CTE,
    ),
)
def metrics_of_tree_regressor(spark, sf_dir):
    train, test = parts(spark, sf_dir, CELL)
    predictions = fit_predict(REGRESSORS["decision_tree"].build(len(CELL)), train, test)[1]
    return rounded(evaluate.regression_metrics(predictions), ["rmse", "mae", "r2"])


# At the optimum of a Weibull survival model with e = exp((ln t - line) / scale), e and the event flag agree
# in the mean of every feature.
@query(
    "fit_aft_moments",
    with_p(
        """SELECT 'Pclass' AS feature, round(avg(Pclass * Survived), 3) AS mean FROM s WHERE part = 0
 UNION ALL SELECT 'SibSp', round(avg(SibSp * Survived), 3) FROM s WHERE part = 0
 UNION ALL SELECT 'one', round(avg(Survived), 3) FROM s WHERE part = 0""",
        f"s AS (SELECT *, {PART_SQL} AS part FROM p WHERE Fare > 0)",
    ),
)
def fit_aft_moments(spark, sf_dir):
    df = passengers(spark, sf_dir).where("Fare > 0")
    df = df.select("PassengerId", F.col("Survived").alias("censor"), "Fare", "Pclass", "SibSp")
    part = hash_split(df, [0.7, 0.3], 1, passenger_key())[0]
    train = training_table(to_label(part, "Fare", ["Pclass", "SibSp"], ["censor"]))
    estimator = REGRESSORS["aft"].build(2, maxIter=300, tol=1e-12)
    stages = [*feature_pipeline(["Pclass", "SibSp"]).getStages(), estimator]
    model, fitted = fit_predict(Pipeline(stages=stages), train, train)
    e = F.pow(F.col("label") / F.col("prediction"), 1 / model.stages[-1].scale)
    columns = {"Pclass": F.col("Pclass"), "SibSp": F.col("SibSp"), "one": F.lit(1.0)}
    means = fitted.agg(*[F.round(F.avg(x * e), 3).alias(name) for name, x in columns.items()])
    return means.unpivot([], list(columns), "feature", "mean")


# Monotone regression by its min-max formula over the distinct feature values.
@query(
    "fit_isotonic",
    with_p(
        """SELECT PassengerId, Survived AS label, round(fitted, 6) AS prediction
 FROM p JOIN iso ON floor(p.Fare) = iso.x""",
        """g AS (SELECT floor(Fare) AS x, sum(Survived) AS s, count(*) AS n FROM p GROUP BY 1)""",
        """c AS (SELECT x, s, n, sum(s) OVER (ORDER BY x) AS cs, sum(n) OVER (ORDER BY x) AS cn
 FROM g)""",
        """spans AS (SELECT v.x, a.x AS first, min((b.cs - a.cs + a.s) / (b.cn - a.cn + a.n)) AS low
 FROM c v JOIN c a ON a.x <= v.x JOIN c b ON b.x >= v.x GROUP BY v.x, a.x)""",
        "iso AS (SELECT x, max(low) AS fitted FROM spans GROUP BY x)",
    ),
)
def fit_isotonic(spark, sf_dir):
    df = passengers(spark, sf_dir).select(
        "PassengerId",
        F.col("Survived").alias("label"),
        F.floor("Fare").cast("double").alias("features"),
    )
    predictions = fit_predict(REGRESSORS["isotonic"].build(1), df, df)[1]
    return rounded(predictions.select("PassengerId", "label", "prediction"), ["prediction"])

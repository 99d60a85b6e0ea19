"""Cross-validated search with five folds and the declared grids, and the comparison of all models.

On one flag every model ranks the rows alike, so the metrics of whole grids are known.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tabloom.catalog.cleaning import passenger_key
from tabloom.catalog.fitting import CELL, CELL_SQL
from tabloom.catalog.registry import ENCODED_CTE, FOLD_SQL, PART_SQL, query, rounded, with_p
from tabloom.operators.evaluate import confidence_summary
from tabloom.operators.features import feature_pipeline, to_label
from tabloom.operators.models import CLASSIFIERS
from tabloom.operators.split import hash_split
from tabloom.operators.tuning import cross_validate
from tabloom.plans.clean import clean, encode
from tabloom.plans.compare import compare_models
from tabloom.schemas import AREA_COLUMN, FEATURES, TARGET
from tabloom.sources.passengers import passengers
from tabloom.sources.shared import materialize, training_table


def _search(spark, sf_dir, name, features=FEATURES, grid=None, target=None, **options):
    raw = passengers(spark, sf_dir)
    df = clean(raw, "mean", ["PassengerId"]) if "Age" in features else encode(raw, ["PassengerId"])
    df = df if target is None else df.withColumn(TARGET, target)
    part = hash_split(training_table(df), (0.7, 0.3), 1, passenger_key())[0]
    train = training_table(to_label(part, TARGET, features, ["PassengerId"]))
    stages = feature_pipeline(features).getStages()
    found = cross_validate(
        CLASSIFIERS[name], train, len(features), passenger_key(), grid=grid, prepare=stages, **options
    )
    rows = [
        (i, json.dumps({name: str(value) for name, value in entry.items()}, separators=(",", ":")), float(metric), found.parameters)
        for i, (entry, metric) in enumerate(zip(found.maps, found.metrics))
    ]
    result = spark.createDataFrame(rows, "entry int, parameters string, metric double, best string")
    return rounded(result, ["metric"])


@query("cv_logistic")
def cv_logistic(spark, sf_dir):
    return _search(spark, sf_dir, "logistic")


@query("cv_random_forest")
def cv_random_forest(spark, sf_dir):
    return _search(spark, sf_dir, "random_forest")


@query("cv_gbt")
def cv_gbt(spark, sf_dir):
    return _search(spark, sf_dir, "gbt")


@query("cv_decision_tree")
def cv_decision_tree(spark, sf_dir):
    return _search(spark, sf_dir, "decision_tree")


# A tree grown out on the cells predicts their majority, so the metric of each fold is known.
@query(
    "cv_decision_tree_cells",
    with_p(
        """SELECT entry, parameters, metric, 'maxDepth: 5 - maxBins: 4' AS best
 FROM (SELECT round(avg(f1), 6) AS metric FROM scored), (VALUES
 (0, '{"maxDepth":"5","maxBins":"4"}'), (1, '{"maxDepth":"5","maxBins":"6"}')) v(entry, parameters)""",
        ENCODED_CTE,
        f"s AS (SELECT *, {PART_SQL} AS part, {FOLD_SQL} AS fold FROM e)",
        f"""m AS (SELECT {CELL_SQL}, held, CAST(avg(Survived) > 0.5 AS DOUBLE) AS prediction
 FROM s, (VALUES (0), (1), (2), (3), (4)) h(held) WHERE part = 0 AND fold <> held GROUP BY ALL)""",
        f"""x AS (SELECT held, Survived AS label, prediction FROM s JOIN m USING ({CELL_SQL})
 WHERE part = 0 AND fold = held)""",
        """k AS (SELECT held, c.label, count(*) FILTER (x.label = c.label) AS support,
 2.0 * count(*) FILTER (x.label = c.label AND x.prediction = c.label)
 / (count(*) FILTER (x.label = c.label) + count(*) FILTER (x.prediction = c.label)) AS f1
 FROM x, (SELECT DISTINCT label FROM x) c GROUP BY held, c.label)""",
        "scored AS (SELECT held, sum(support * f1) / sum(support) AS f1 FROM k GROUP BY held)",
    ),
)
def cv_decision_tree_cells(spark, sf_dir):
    grid = {"maxDepth": [5], "maxBins": [4, 6]}
    return _search(spark, sf_dir, "decision_tree", CELL, grid)


# With one flag every model that prefers it ranks the rows alike, so a fold's area follows from its counts.
_FOLDS_CTE = f"s AS (SELECT *, {PART_SQL} AS part, {FOLD_SQL} AS fold FROM e)"
_AREAS_CTE = """areas AS (SELECT fold, 0.5 + 0.5 * (avg(female) FILTER (Survived = 1) - avg(female) FILTER (Survived = 0))
 AS area FROM s WHERE part = 0 GROUP BY fold)"""


def _flag_sql(best, columns, *values):
    """The twin of a search on one flag: every map of the grid has the same area."""
    pairs = " || ', ' || ".join(f"""'"{c}":"' || {c} || '"'""" for c in columns).replace(", ' || '", ",' || '")
    grid = ", ".join(f"(VALUES {', '.join(f'({i}, {v!r})' for i, v in enumerate(vs))}) g{n}(i{n}, {c})" for n, (c, vs) in enumerate(zip(columns, values)))
    entry = "0"
    for n, vs in enumerate(values):
        entry = f"({entry}) * {len(vs)} + i{n}"
    return with_p(
        f"""SELECT CAST({entry} AS INTEGER) AS entry, '{{' || {pairs} || '}}' AS parameters,
 round((SELECT avg(area) FROM areas), 6) AS metric, '{best}' AS best FROM {grid}""",
        ENCODED_CTE,
        _FOLDS_CTE,
        _AREAS_CTE,
    )


@query(
    "cv_logistic_flag",
    _flag_sql(
        "regParam: 0.0 - MaxIter: 1 - elasticNetParam: 0.0",
        ["regParam", "elasticNetParam", "maxIter"],
        ["0.0", "0.01", "0.02", "0.03", "0.04", "0.05", "0.06", "0.07", "0.08", "0.09"], ["0.0", "1.0"], ["1", "5", "10"],
    ),
)
def cv_logistic_flag(spark, sf_dir):
    return _search(spark, sf_dir, "logistic", ["female"])


@query(
    "cv_random_forest_flag",
    _flag_sql(
        "maxDepth: 2 - maxBins: 20 - numTrees: 5",
        ["maxDepth", "maxBins", "numTrees"], ["2", "4", "6"], ["20", "60"], ["5", "20"],
    ),
)
def cv_random_forest_flag(spark, sf_dir):
    return _search(spark, sf_dir, "random_forest", ["female"])


@query(
    "cv_gbt_flag",
    _flag_sql("maxDepth: 1 - maxIter: 7", ["maxDepth", "maxIter"], ["1", "10", "20", "30"], ["7", "10", "14", "18"]),
)
def cv_gbt_flag(spark, sf_dir):
    return _search(spark, sf_dir, "gbt", ["female"])


@query("cv_mlp")
def cv_mlp(spark, sf_dir):
    return _search(spark, sf_dir, "mlp")


# Every fold's perceptron must reproduce the exclusive-or of two flags on the rows that it hasn't seen.
@query(
    "cv_mlp_xor",
    with_p(
        """SELECT 0 AS entry, '{}' AS parameters, round(avg(held), 6) AS metric, 'unspecified' AS best FROM scored""",
        ENCODED_CTE,
        """x AS (SELECT CAST(CAST('0x' || substr(md5('fold 2:' || CAST(CAST(PassengerId AS BIGINT) AS VARCHAR)), 1, 8)
 AS BIGINT) % 5 AS INTEGER) AS fold, female <> low AS target, (female + low) % 2 = 1 AS found FROM e)""",
        "scored AS (SELECT fold, avg(CAST(target = found AS DOUBLE)) AS held FROM x GROUP BY fold)",
    ),
)
def cv_mlp_xor(spark, sf_dir):
    target = (F.col("female") != F.col("low")).cast("double")
    return _search(spark, sf_dir, "mlp", ["female", "low"], target=target, seed=2, maxIter=400)


# All grids on one flag: the areas and the majorities of the flag's two values are known. Naive Bayes with one
# feature has nothing but its prior.
@query(
    "compare_models_flag",
    with_p(
        f"""SELECT "Name", CASE WHEN ranks THEN round(area, 6) END AS "{AREA_COLUMN}",
 CASE WHEN counts THEN round(CASE WHEN "Name" = 'Naive Bayes' THEN prior ELSE flag END, 6) END AS "Accuracy", "Best_Param"
 FROM areas, hits, (VALUES
 ('Logistic Regression', true, false, 'standard'),
 ('Logistic Regression - Cross Validation', true, false, 'regParam: 0.0 - MaxIter: 1 - elasticNetParam: 0.0'),
 ('Random forest', true, true, 'standard'),
 ('Random forest - Cross Validation', true, true, 'maxDepth: 2 - maxBins: 20 - numTrees: 5'),
 ('Gradient-Boosted Tree Classifier', true, true, 'standard'),
 ('Gradient-Boosted Tree Classifier - Cross Validation', true, true, 'maxDepth: 1 - maxIter: 7'),
 ('Decision Tree Classifier', false, true, 'standard'),
 ('Decision Tree Classifier - Cross Validation', false, true, 'maxDepth: 4 - maxBins: 2'),
 ('Multilayer perceptron classifier', false, true, 'standard'),
 ('Multilayer perceptron classifier - Cross Validation', false, true, 'unspecified'),
 ('Naive Bayes', false, true, 'standard')) v("Name", ranks, counts, "Best_Param")""",
        ENCODED_CTE,
        f"s AS (SELECT *, {PART_SQL} AS part FROM e)",
        """areas AS (SELECT 0.5 + 0.5 * (avg(female) FILTER (Survived = 1) - avg(female) FILTER (Survived = 0)) AS area
 FROM s WHERE part = 1)""",
        "m AS (SELECT female, avg(Survived) > 0.5 AS likely FROM s WHERE part = 0 GROUP BY female)",
        "whole AS (SELECT avg(Survived) > 0.5 AS usual FROM s WHERE part = 0)",
        """hits AS (SELECT avg(CAST((Survived = 1) = likely AS DOUBLE)) AS flag,
 avg(CAST((Survived = 1) = usual AS DOUBLE)) AS prior FROM s JOIN m USING (female), whole WHERE part = 1)""",
    ),
)
def compare_models_flag(spark, sf_dir):
    df = encode(passengers(spark, sf_dir), ["PassengerId"]).withColumn("PassengerId", F.col("PassengerId").cast("bigint"))
    return rounded(compare_models(materialize(df), ["PassengerId"], features=["female"]).table, [AREA_COLUMN, "Accuracy"])


@query("compare_models")
def compare_models_query(spark, sf_dir):
    df = materialize(clean(passengers(spark, sf_dir), "mean", ["PassengerId"]))
    table = compare_models(df, ["PassengerId"]).table
    return rounded(table, [AREA_COLUMN, "Accuracy"])


@query("model_confidences")
def model_confidences(spark, sf_dir):
    df = materialize(clean(passengers(spark, sf_dir), "mean", ["PassengerId"]))
    return confidence_summary(compare_models(df, ["PassengerId"]).confidences)

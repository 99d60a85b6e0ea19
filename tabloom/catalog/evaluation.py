"""Evaluation operators on deterministic scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.registry import query, rounded, with_p
from tabloom.operators import evaluate
from tabloom.operators.features import assembler
from tabloom.sources.passengers import passengers, table

RULE_SQL = "CASE WHEN Fare > 25 THEN 1.0 ELSE 0.0 END"


def _scored(spark, sf_dir):
    return passengers(spark, sf_dir).select(
        F.col("Survived").alias("label"),
        F.col("Fare").alias("score"),
        F.when(F.col("Fare") > 25, 1.0).otherwise(0.0).alias("prediction"),
    )


def auc_sql(source: str) -> str:
    """Area from the counts per distinct score; ``source`` has the columns label and score."""
    return f"""c AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM ({source}) GROUP BY score),
 r AS (SELECT p, n, sum(n) OVER (ORDER BY score) - n AS below FROM c)
 SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) AS auc FROM r"""


_AUC_HEAD, _AUC_TAIL = auc_sql("SELECT Survived AS label, Fare AS score FROM p").split("\n SELECT", 1)


@query("auc", with_p("SELECT" + _AUC_TAIL, _AUC_HEAD))
def auc(spark, sf_dir):
    return rounded(evaluate.area_under_roc(_scored(spark, sf_dir)), ["auc"])


@query(
    "auc_of_text_length",
    "WITH "
    + auc_sql(
        """SELECT CAST(quality AS DOUBLE) AS label, CAST(n_chars AS DOUBLE) AS score
 FROM labels JOIN documents USING (doc_id)"""
    ),
)
def auc_of_text_length(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    lengths = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("score"))
    return rounded(evaluate.area_under_roc(labels.join(lengths, "doc_id")), ["auc"])


@query("accuracy", with_p(f"SELECT round(avg(CAST(Survived = {RULE_SQL} AS DOUBLE)), 6) AS accuracy FROM p"))
def accuracy(spark, sf_dir):
    return rounded(evaluate.accuracy(_scored(spark, sf_dir)), ["accuracy"])


@query(
    "weighted_f1",
    with_p(
        "SELECT round(sum(support * f1) / sum(support), 6) AS f1 FROM k",
        "x AS (SELECT Pclass AS label, 1 + SibSp % 3 AS prediction FROM p)",
        """k AS (SELECT c.label, count(*) FILTER (x.label = c.label) AS support,
 2.0 * count(*) FILTER (x.label = c.label AND x.prediction = c.label)
 / (count(*) FILTER (x.label = c.label) + count(*) FILTER (x.prediction = c.label)) AS f1
 FROM x, (SELECT DISTINCT label FROM x) c GROUP BY c.label)""",
    ),
)
def weighted_f1(spark, sf_dir):
    df = passengers(spark, sf_dir).select(
        F.col("Pclass").alias("label"), (1 + F.col("SibSp") % 3).alias("prediction")
    )
    return rounded(evaluate.weighted_f1(df), ["f1"])


@query(
    "roc_curve",
    with_p(
        """SELECT round(threshold, 6) AS threshold,
 round(sum(n) OVER w / sum(n) OVER (), 6) AS "FPR",
 round(sum(pos) OVER w / sum(pos) OVER (), 6) AS "TPR"
 FROM c WINDOW w AS (ORDER BY threshold DESC)
 UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""",
        """c AS (SELECT Fare AS threshold, sum(Survived) AS pos, sum(1 - Survived) AS n
 FROM p GROUP BY Fare)""",
    ),
)
def roc_curve(spark, sf_dir):
    return rounded(evaluate.roc_curve(_scored(spark, sf_dir)), ["threshold", "FPR", "TPR"])


@query(
    "roc_curve_thinned",
    with_p(
        """SELECT round(threshold, 6) AS threshold, round(x, 6) AS "FPR", round(y, 6) AS "TPR" FROM (
 SELECT *, row_number() OVER (PARTITION BY floor(x * 100), floor(y * 100) ORDER BY x, y) AS up,
 row_number() OVER (PARTITION BY floor(x * 100), floor(y * 100) ORDER BY x DESC, y DESC) AS down FROM r)
 WHERE up = 1 OR down = 1""",
        """c AS (SELECT Fare AS threshold, sum(Survived) AS pos, sum(1 - Survived) AS n
 FROM p GROUP BY Fare)""",
        """r AS (SELECT threshold, sum(n) OVER w / sum(n) OVER () AS x, sum(pos) OVER w / sum(pos) OVER () AS y
 FROM c WINDOW w AS (ORDER BY threshold DESC)
 UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE))""",
    ),
)
def roc_curve_thinned(spark, sf_dir):
    thinned = evaluate.thin_roc(evaluate.roc_curve(_scored(spark, sf_dir)), 100)
    return rounded(thinned, ["threshold", "FPR", "TPR"])


@query(
    "confidence",
    with_p(
        """SELECT PassengerId, round(greatest(Fare / 61, Age / 101, 1 - Fare / 61), 6) AS confidence
 FROM p WHERE Age IS NOT NULL"""
    ),
)
def confidence(spark, sf_dir):
    df = passengers(spark, sf_dir).where(F.col("Age").isNotNull())
    scores = df.select(
        "PassengerId",
        (F.col("Fare") / 61).alias("a"),
        (F.col("Age") / 101).alias("b"),
        (1 - F.col("Fare") / 61).alias("c"),
    )
    vectors = assembler(["a", "b", "c"], "probability").transform(scores)
    best = F.round(evaluate.confidence(), 6).alias("confidence")
    return vectors.select("PassengerId", best)


@query(
    "confidence_summary",
    with_p(
        """SELECT model, count(*) AS n, round(min(confidence), 6) AS minimum,
 round(quantile_cont(confidence, 0.25), 6) AS lower_quartile,
 round(quantile_cont(confidence, 0.5), 6) AS median,
 round(quantile_cont(confidence, 0.75), 6) AS upper_quartile,
 round(max(confidence), 6) AS maximum FROM x GROUP BY model""",
        """x AS (SELECT 'by fare' AS model, greatest(Fare / 51, 1 - Fare / 51) AS confidence FROM p
 UNION ALL SELECT 'by age', greatest(Age / 101, 1 - Age / 101) FROM p WHERE Age IS NOT NULL)""",
    ),
)
def confidence_summary(spark, sf_dir):
    df = passengers(spark, sf_dir)

    def scores(name, share):
        value = F.greatest(share, 1 - share).alias("confidence")
        return df.where(share.isNotNull()).select(F.lit(name).alias("model"), value)

    both = scores("by fare", F.col("Fare") / 51).unionByName(
        scores("by age", F.col("Age") / 101)
    )
    return rounded(evaluate.confidence_summary(both), list(evaluate.BOX))


@query(
    "regression_metrics",
    with_p(
        """SELECT round(sqrt(avg((Fare - Age) ** 2)), 6) AS rmse, round(avg(abs(Fare - Age)), 6) AS mae,
 round(1 - avg((Fare - Age) ** 2) / var_pop(Fare), 6) AS r2 FROM p WHERE Age IS NOT NULL"""
    ),
)
def regression_metrics(spark, sf_dir):
    df = passengers(spark, sf_dir).select(
        F.col("Fare").alias("label"), F.col("Age").alias("prediction")
    )
    return rounded(evaluate.regression_metrics(df), ["rmse", "mae", "r2"])

"""Evaluation as DataFrame operators. Each result is a DataFrame; none passes rows to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.keys import group_key
from tabloom.operators.attach import KEY
from tabloom.operators.ranks import grouped_quantiles, running_counts, sketched_quantiles
from tabloom.sources.shared import materialize

# What a box in a box plot shows.
BOX = {"minimum": 0.0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75, "maximum": 1.0}


def accuracy(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    """Share of rows predicted right, of all rows or for each group of ``by``.

    Here and below ``count`` is a column that says how many equal rows a row stands for.
    """
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    share = F.sum(hit * F.col(count)) / F.sum(count) if count else F.avg(hit)
    return df.groupBy(*by).agg(share.alias("accuracy"))


def weighted_f1(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    """F1 of each class, averaged with the number of rows that carry the class as weight.

    Of all rows, or for each group of ``by``.
    """
    n = F.sum(count) if count else F.count("*")
    cells = df.groupBy(*by, F.col(label).alias("l"), F.col(prediction).alias("p")).agg(n.alias("n"))
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(none)

    def side(value, labelled, predicted, hits):
        return F.struct(
            value.cast("double").alias("value"),
            labelled.alias("labelled"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    sides = F.array(
        side(F.col("l"), F.col("n"), none, hit), side(F.col("p"), none, F.col("n"), none)
    )
    classes = (
        cells.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, "s.value")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("labelled", "predicted", "hits")])
    )
    f1 = 2.0 * F.col("hits") / (F.col("labelled") + F.col("predicted"))
    return classes.groupBy(*by).agg((F.sum(F.col("labelled") * f1) / F.sum("labelled")).alias("f1"))


def _ranked_scores(df, label, score, ascending, rows_per_range, by=(), count=None):
    rows = F.col(count) if count else F.lit(1)
    positive = F.when(F.col(label) > 0.5, rows).otherwise(0)
    counts = materialize(
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(group_key(by).alias(KEY), F.col(score).cast("double").alias("threshold"))
        .agg(F.sum(positive).alias("pos"), F.sum(rows - positive).alias("neg"))
    )
    return running_counts(
        counts, "threshold", ["pos", "neg"], ascending=ascending, rows_per_range=rows_per_range
    )


def area_under_roc(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    rows_per_range: int = 1_000_000,
    by: Sequence[str] = (),
    count: str | None = None,
) -> DataFrame:
    """Exact area under the ROC curve, of all rows or for each group of ``by``.

    Equal scores count half. Null if a class is missing.
    """
    ranked = _ranked_scores(df, label, score, True, rows_per_range, by, count)
    won = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    pairs = F.max(F.col("total_pos").cast("double") * F.col("total_neg"))
    area = (F.sum(won) / F.nullif(pairs, F.lit(0.0))).alias("auc")
    if not by:
        return ranked.agg(area)
    return ranked.groupBy(KEY).agg(area).select(*[F.col(KEY)[c].alias(c) for c in by], "auc")


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "score", rows_per_range: int = 1_000_000
) -> DataFrame:
    """One point per distinct score, plus the start (0, 0) whose threshold is null."""
    ranked = _ranked_scores(df, label, score, False, rows_per_range)

    def rate(name):
        total = F.nullif(F.col(f"total_{name}"), F.lit(0))
        return (F.col(f"before_{name}") + F.col(name)) / total

    points = ranked.select("threshold", rate("neg").alias("FPR"), rate("pos").alias("TPR"))
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], points.schema)
    return start.unionByName(points)


def thin_roc(curve: DataFrame, cells: int = 1000) -> DataFrame:
    """At most ``4 * cells + 2`` points of a ``roc_curve``, however many scores there are.

    Kept are the first and the last point in each cell of a grid with ``cells`` steps a side. The curve rises, so it goes
    through at most ``2 * cells + 1`` cells, and the area below the kept points is off by at most ``1 / (2 * cells)``.
    Points of a curve that lacks a class have a rate that is null; they share a column or row of cells.
    """
    if cells < 1:
        raise ValueError("a grid has at least one cell")
    point, order = F.struct("threshold", "FPR", "TPR"), F.struct("FPR", "TPR")
    ends = curve.groupBy(F.floor(F.col("FPR") * cells).alias("x"), F.floor(F.col("TPR") * cells).alias("y")).agg(
        F.min_by(point, order).alias("first"), F.max_by(point, order).alias("last")
    )
    return ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("p")).select("p.*")


def confidence(probability: Column | str = "probability") -> Column:
    """Probability of the most likely class, over however many classes there are."""
    return F.array_max(vector_to_array(probability))


def confidence_summary(
    df: DataFrame,
    model: str = "model",
    value: str = "confidence",
    rows_per_range: int = 1_000_000,
    method: str = "exact",
    rank_error: float = 1e-4,
) -> DataFrame:
    """The five numbers of a box plot for each model.

    By ``exact`` order, or from a ``sketch`` of bounded size whose ranks are off by at most ``rank_error`` of the rows.
    """
    names = list(BOX)
    if method == "sketch":
        summary = sketched_quantiles(df, [model], value, list(BOX.values()), names, rank_error)
    elif method == "exact":
        summary = grouped_quantiles(df, [model], value, list(BOX.values()), names, rows_per_range=rows_per_range)
    else:
        raise ValueError(f"unknown method {method!r}")
    return summary.select(model, "n", *names)


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Root mean squared error, mean absolute error and R2 in one pass."""
    error = F.col(label) - F.col(prediction)
    squared = F.avg(error * error)
    return df.where(error.isNotNull()).agg(
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - squared / F.nullif(F.var_pop(label), F.lit(0.0))).alias("r2"),
    )

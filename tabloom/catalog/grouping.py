"""Grouped operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tabloom.catalog.registry import ENCODED_CTE, query, rounded, with_p
from tabloom.operators.grouped import (
    grouped_impute,
    grouped_map,
    grouped_standardize,
    missing_split,
)
from tabloom.plans.clean import encode
from tabloom.schemas import DUMMIES
from tabloom.sources.passengers import passengers, table

CELL = ["female", "low", "mid", "Very_low", "very_high", "high"]


def _ages(spark, sf_dir, strategy, features=(), **options):
    df = encode(passengers(spark, sf_dir), ["PassengerId"])
    df = df.select("PassengerId", "Pclass", *features, "Age")
    filled = grouped_impute(df, ["Pclass"], "Age", features, strategy, **options)
    return rounded(filled.select("PassengerId", "Pclass", "Age"), ["Age"])


@query(
    "missing_split",
    with_p(
        "SELECT PassengerId, Age, CASE WHEN Age IS NULL THEN 'missing' ELSE 'known' END AS side FROM p"
    ),
)
def missing_split_query(spark, sf_dir):
    known, missing = missing_split(passengers(spark, sf_dir).select("PassengerId", "Age"), "Age")
    known = known.withColumn("side", F.lit("known"))
    return known.unionByName(missing.withColumn("side", F.lit("missing")))


@query(
    "impute_mean",
    with_p(
        """SELECT PassengerId, Pclass,
 round(coalesce(Age, avg(Age) OVER (PARTITION BY Pclass)), 6) AS Age FROM p"""
    ),
)
def impute_mean(spark, sf_dir):
    return _ages(spark, sf_dir, "mean")


@query(
    "impute_median",
    with_p(
        """SELECT PassengerId, p.Pclass, round(coalesce(Age, middle), 6) AS Age
 FROM p JOIN m ON p.Pclass = m.Pclass""",
        "m AS (SELECT Pclass, quantile_cont(Age, 0.5) AS middle FROM p GROUP BY Pclass)",
    ),
)
def impute_median(spark, sf_dir):
    return _ages(spark, sf_dir, "median")


@query("impute_rf")
def impute_rf(spark, sf_dir):
    return _ages(spark, sf_dir, "forest", DUMMIES)


# Trees without resampling that try every feature, grown out on 0/1 columns, predict the mean of the known
# rows with the same features.
CELL_AGES_SQL = with_p(
    """SELECT PassengerId, e.Pclass, round(coalesce(e.Age, m.mean), 6) AS Age FROM e JOIN m
 ON e.Pclass = m.Pclass AND e.female = m.female AND e.low = m.low AND e.mid = m.mid
 AND e."Very_low" = m."Very_low" AND e."very_high" = m."very_high" """,
    ENCODED_CTE,
    """m AS (SELECT Pclass, female, low, mid, "Very_low", "very_high", avg(Age) AS mean
 FROM e GROUP BY ALL)""",
)


@query("impute_rf_one_tree", CELL_AGES_SQL)
def impute_rf_one_tree(spark, sf_dir):
    return _ages(spark, sf_dir, "forest", CELL, trees=1, subset="all")


@query("impute_rf_cells", CELL_AGES_SQL)
def impute_rf_cells(spark, sf_dir):
    return _ages(spark, sf_dir, "forest", CELL, subset="all")


@query("impute_pooled_one_tree", CELL_AGES_SQL)
def impute_pooled_one_tree(spark, sf_dir):
    return _ages(spark, sf_dir, "pooled_forest", CELL, trees=1, subset="all")


@query("impute_level_cells", CELL_AGES_SQL)
def impute_level_cells(spark, sf_dir):
    return _ages(spark, sf_dir, "level_forest", CELL, subset="all")


# As many groups as tickets. Prices of every third passenger are missing; where no known price of the ticket has the flag
# of the passenger, the tree has not split.
TICKET_PRICE = "CASE WHEN PassengerId % 3 <> 0 THEN Fare * 10000 END"


@query(
    "impute_ticket_forests",
    with_p(
        """SELECT PassengerId, Ticket, round(coalesce(k.Price, s.mean, t.mean, (SELECT avg(Price) FROM k)), 6) AS Price
 FROM k LEFT JOIN s USING (Ticket, Sex) LEFT JOIN t USING (Ticket)""",
        f"k AS (SELECT PassengerId, Ticket, Sex, {TICKET_PRICE} AS Price FROM p)",
        "s AS (SELECT Ticket, Sex, avg(Price) AS mean FROM k GROUP BY ALL)",
        "t AS (SELECT Ticket, avg(Price) AS mean FROM k GROUP BY ALL)",
    ),
)
def impute_ticket_forests(spark, sf_dir):
    df = passengers(spark, sf_dir).select(
        "PassengerId", "Ticket", F.expr(TICKET_PRICE).alias("Price"), (F.col("Sex") == "female").cast("int").alias("flag")
    )
    filled = grouped_impute(df, ["Ticket"], "Price", ["flag"], "level_forest", subset="all")
    return rounded(filled.select("PassengerId", "Ticket", "Price"), ["Price"])


@query("impute_level_forest")
def impute_level_forest(spark, sf_dir):
    return _ages(spark, sf_dir, "level_forest", DUMMIES)


# A field NaN is a missing age like a null one.
NAN_AGES = "CASE WHEN PassengerId % 3 = 0 THEN CAST('NaN' AS DOUBLE) ELSE Age END"
NAN_KNOWN = "CASE WHEN PassengerId % 3 <> 0 THEN Age END"


@query(
    "impute_mean_nan",
    with_p(
        f"""SELECT PassengerId, Pclass,
 round(coalesce({NAN_KNOWN}, avg({NAN_KNOWN}) OVER (PARTITION BY Pclass)), 6) AS Age FROM p"""
    ),
)
def impute_mean_nan(spark, sf_dir):
    df = passengers(spark, sf_dir).select("PassengerId", "Pclass", F.expr(NAN_AGES).alias("Age"))
    return rounded(grouped_impute(df, ["Pclass"], "Age", (), "mean"), ["Age"])


@query(
    "impute_median_nan",
    with_p(
        f"""SELECT PassengerId, Pclass,
 round(coalesce({NAN_KNOWN}, quantile_cont({NAN_KNOWN}, 0.5) OVER (PARTITION BY Pclass)), 6) AS Age FROM p"""
    ),
)
def impute_median_nan(spark, sf_dir):
    df = passengers(spark, sf_dir).select("PassengerId", "Pclass", F.expr(NAN_AGES).alias("Age"))
    return rounded(grouped_impute(df, ["Pclass"], "Age", (), "median"), ["Age"])


@query(
    "grouped_zscore_nan",
    with_p(
        f"""SELECT PassengerId, Survived, CASE WHEN PassengerId % 3 <> 0 AND Age IS NOT NULL
 THEN round(({NAN_KNOWN} - avg({NAN_KNOWN}) OVER g) / stddev_pop({NAN_KNOWN}) OVER g, 6) END AS Age
 FROM p WINDOW g AS (PARTITION BY Survived)"""
    ),
)
def grouped_zscore_nan(spark, sf_dir):
    df = passengers(spark, sf_dir).select("PassengerId", "Survived", F.expr(NAN_AGES).alias("Age"))
    scaled = grouped_standardize(df, ["Survived"], ["Age"])
    return rounded(scaled.withColumn("Age", F.nanvl("Age", F.lit(None))), ["Age"])


@query("impute_pooled_forest")
def impute_pooled_forest(spark, sf_dir):
    return _ages(spark, sf_dir, "pooled_forest", DUMMIES)


@query(
    "grouped_zscore",
    with_p(
        """SELECT PassengerId, Survived,
 round((Fare - avg(Fare) OVER g) / stddev_pop(Fare) OVER g, 6) AS Fare,
 round((Age - avg(Age) OVER g) / stddev_pop(Age) OVER g, 6) AS Age
 FROM p WINDOW g AS (PARTITION BY Survived)"""
    ),
)
def grouped_zscore(spark, sf_dir):
    df = passengers(spark, sf_dir).select("PassengerId", "Survived", "Fare", "Age")
    return rounded(grouped_standardize(df, ["Survived"], ["Fare", "Age"]), ["Fare", "Age"])


@query(
    "grouped_zscore_balance",
    """SELECT c_custkey, c_mktsegment, round((c_acctbal - avg(c_acctbal) OVER g)
 / stddev_pop(c_acctbal) OVER g, 6) AS c_acctbal
 FROM customer WINDOW g AS (PARTITION BY c_mktsegment)""",
)
def grouped_zscore_balance(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return rounded(grouped_standardize(df, ["c_mktsegment"], ["c_acctbal"]), ["c_acctbal"])


@query(
    "grouped_map",
    with_p(
        """SELECT PassengerId, Embarked,
 round(Fare - avg(Fare) OVER (PARTITION BY Embarked), 6) AS above_mean FROM p"""
    ),
)
def grouped_map_query(spark, sf_dir):
    def above_mean(batch):
        return batch.assign(above_mean=batch["Fare"] - batch["mean_fare"])

    df = passengers(spark, sf_dir).select("PassengerId", "Embarked", "Fare")
    schema = "PassengerId double, Embarked string, above_mean double"
    statistics = {"mean_fare": F.avg("Fare")}
    return rounded(grouped_map(df, ["Embarked"], above_mean, schema, statistics), ["above_mean"])


@query(
    "grouped_map_whole",
    with_p(
        """SELECT Ticket, round(list_reduce(list(Fare ORDER BY PassengerId), lambda a, x: 0.75::DOUBLE * a + 0.25::DOUBLE * x), 6)
 AS smoothed FROM p GROUP BY Ticket"""
    ),
)
def grouped_map_whole(spark, sf_dir):
    def smooth(frames):
        ticket, level = None, None
        for frame in frames:
            for ticket, fare in zip(frame["Ticket"], frame["Fare"]):
                level = fare if level is None else 0.75 * level + 0.25 * fare
        yield pd.DataFrame({"Ticket": [ticket], "smoothed": [level]})

    df = passengers(spark, sf_dir).select("PassengerId", "Ticket", "Fare")
    found = grouped_map(df, ["Ticket"], smooth, "Ticket string, smoothed double", order=["PassengerId"])
    return rounded(found, ["smoothed"])

"""The passenger table, derived from the ``orders`` table of the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The same text runs in Spark SQL and in DuckDB.
PASSENGERS_SQL = """
SELECT CAST(o_orderkey AS DOUBLE) AS PassengerId,
 CASE WHEN (CASE WHEN o_totalprice / 10000 + CASE WHEN o_orderkey % 2 = 0 THEN 15 ELSE 0 END > 30 THEN 1 ELSE 0 END)
        <> (CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END)
      THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Survived,
 CAST(1 + o_custkey % 3 AS DOUBLE) AS Pclass,
 concat('Passenger, No ', CAST(o_orderkey AS VARCHAR(20))) AS Name,
 CASE WHEN o_orderkey % 2 = 0 THEN 'female' ELSE 'male' END AS Sex,
 CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(1 + (o_custkey * 7) % 80 AS DOUBLE) END AS Age,
 CAST(o_orderkey % 4 AS DOUBLE) AS SibSp, CAST(o_custkey % 4 AS DOUBLE) AS Parch,
 concat('T', CAST(o_custkey AS VARCHAR(20))) AS Ticket, o_totalprice / 10000 AS Fare,
 CASE WHEN o_orderkey % 7 = 0 THEN concat('C', CAST(o_custkey % 100 AS VARCHAR(20))) END AS Cabin,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderstatus = 'O' THEN 'S'
      WHEN o_orderstatus = 'F' THEN 'C' ELSE 'Q' END AS Embarked
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PASSENGERS_SQL, orders=table(spark, sf_dir, "orders"))


def passengers_cte() -> str:
    """The table as the first common table expression of a DuckDB query."""
    return f"p AS ({PASSENGERS_SQL.format(orders='orders')})"

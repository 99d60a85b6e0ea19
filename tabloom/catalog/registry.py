"""Registration of queries and the SQL fragments that their twins share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.sources.passengers import passengers_cte


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function from session and data folder to a DataFrame."""

    def add(run):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Doubles rounded for the comparison of two engines, which sum in different orders."""
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


FAMILY_SQL = """CASE WHEN SibSp + Parch + 1 <= 1 THEN 'loner'
 WHEN SibSp + Parch + 1 <= 4 THEN 'small' WHEN SibSp + Parch + 1 IS NOT NULL THEN 'large' END"""

FARE_SQL = """CASE WHEN Fare <= 4 THEN 'Very_low' WHEN Fare <= 10 THEN 'low' WHEN Fare <= 20 THEN 'mid'
 WHEN Fare <= 45 THEN 'high' WHEN Fare IS NOT NULL THEN 'very_high' END"""

ENGINEERED_CTE = f"""f AS (SELECT PassengerId, Survived, Pclass, Sex, Age, Embarked,
 {FAMILY_SQL} AS family, {FARE_SQL} AS fare_group FROM p)"""


def dummy_sql(col: str, value: str, kind: str = "DOUBLE") -> str:
    flag = f"CASE WHEN {col} = '{value}' THEN 1 ELSE 0 END"
    return f'CAST({flag} AS {kind}) AS "{value}"'


_DUMMIES_SQL = ", ".join(
    [dummy_sql("Sex", v) for v in ("female", "male")]
    + [dummy_sql("Embarked", v) for v in ("Q", "C", "S")]
    + [dummy_sql("fare_group", v) for v in ("low", "mid", "Very_low", "very_high", "high")]
)

ENCODED_CTE = (
    f"{ENGINEERED_CTE}, e AS (SELECT PassengerId, Survived, {_DUMMIES_SQL}, Pclass, Age FROM f)"
)

# The part of the 70/30 split and the fold, from the same hash as on the Spark side.
PART_SQL = """CASE WHEN CAST('0x' || substr(md5('1:' || CAST(CAST(PassengerId AS BIGINT) AS VARCHAR)), 1, 8)
 AS BIGINT) < 3006477107 THEN 0 ELSE 1 END"""
FOLD_SQL = """CAST(CAST('0x' || substr(md5('fold 1:' || CAST(CAST(PassengerId AS BIGINT) AS VARCHAR)), 1, 8)
 AS BIGINT) % 5 AS INTEGER)"""


def with_p(select: str, *ctes: str) -> str:
    """A DuckDB query on the passenger table ``p`` and further common table expressions."""
    return f"WITH {', '.join([passengers_cte(), *ctes])} {select}"

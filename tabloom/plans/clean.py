"""From the raw table to the clean table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.buckets import family_group, family_size, fare_group
from tabloom.operators.columns import one_hot
from tabloom.operators.grouped import grouped_impute
from tabloom.schemas import CLEAN_COLUMNS, DUMMIES

# The categories that the clean schema has columns for.
CLEAN_CATEGORIES = {
    "Sex": ("female", "male"),
    "Embarked": ("Q", "C", "S"),
    "fare_group": ("low", "mid", "Very_low", "very_high", "high"),
}


def feature_engineering(df: DataFrame) -> DataFrame:
    """Add ``family`` and ``fare_group`` and drop the columns that they replace or that go unused.

    A null fare or family size gives a null group.
    """
    return (
        df.withColumn("family_size", family_size("SibSp", "Parch"))
        .withColumn("family", family_group("family_size"))
        .withColumn("fare_group", fare_group("Fare"))
        .drop("Name", "Ticket", "SibSp", "Parch", "family_size", "Fare", "Cabin")
    )


def encode(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Feature stage, 0/1 columns and the clean columns as doubles; missing ages stay missing."""
    encoded = one_hot(feature_engineering(df), list(CLEAN_CATEGORIES), CLEAN_CATEGORIES)
    return encoded.select(*keys, *[F.col(c).cast("double").alias(c) for c in CLEAN_COLUMNS])


def clean(
    df: DataFrame, impute: str = "forest", keys: Sequence[str] = (), **options: Any
) -> DataFrame:
    """The clean table. Missing ages are filled inside each ``Pclass`` by the given strategy.

    ``keys`` stay in front of the clean columns, for a split by hash; ``options`` go to
    ``grouped_impute``.
    """
    return grouped_impute(encode(df, keys), ["Pclass"], "Age", DUMMIES, impute, **options)

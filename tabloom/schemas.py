"""Declared table schemas. Nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of the raw table, by position.
RAW_FIELDS = (
    ("PassengerId", T.DoubleType()),
    ("Survived", T.DoubleType()),
    ("Pclass", T.DoubleType()),
    ("Name", T.StringType()),
    ("Sex", T.StringType()),
    ("Age", T.DoubleType()),
    ("SibSp", T.DoubleType()),
    ("Parch", T.DoubleType()),
    ("Ticket", T.StringType()),
    ("Fare", T.DoubleType()),
    ("Cabin", T.StringType()),
    ("Embarked", T.StringType()),
)

# The columns of the clean table and of the features made from it, in order.
TARGET = "Survived"
DUMMIES = ("female", "male", "Q", "C", "S", "low", "mid", "Very_low", "very_high", "high")
FEATURES = (*DUMMIES, "Pclass", "Age")
CLEAN_COLUMNS = (TARGET, *FEATURES)

# Fixed value: the heading of the area column in the comparison table.
AREA_COLUMN = "Test_SET (Area Under ROC)"

RAW_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in RAW_FIELDS])
CLEAN_SCHEMA = T.StructType([T.StructField(name, T.DoubleType()) for name in CLEAN_COLUMNS])
COMPARISON_SCHEMA = T.StructType(
    [
        T.StructField("Name", T.StringType()),
        T.StructField(AREA_COLUMN, T.DoubleType()),
        T.StructField("Accuracy", T.DoubleType()),
        T.StructField("Best_Param", T.StringType()),
    ]
)

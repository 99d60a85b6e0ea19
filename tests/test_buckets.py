import math

import pytest
from pyspark.sql import functions as F

from tabloom.functions.buckets import (
    bucketize,
    cabin_estimator,
    family_group,
    family_size,
    fare_group,
)


def labels(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    return [r[0] for r in df.select("i", expression("x").alias("y")).orderBy("i").select("y").collect()]


def test_family_group_at_its_edges(spark):
    values = [0.0, 1.0, 1.5, 2.0, 4.0, 4.5, 5.0, 11.0, None]
    expected = ["loner", "loner", "small", "small", "small", "large", "large", "large", None]
    assert labels(spark, values, family_group) == expected


def test_fare_group_at_its_edges(spark):
    values = [-1.0, 4.0, 4.01, 10.0, 10.01, 20.0, 20.01, 45.0, 45.01, math.nan, None]
    expected = ["Very_low", "Very_low", "low", "low", "mid", "mid", "high", "high"]
    assert labels(spark, values, fare_group) == [*expected, "very_high", "very_high", None]


def test_cabin_bands_open_at_their_edge(spark):
    values = [15.9, 16.0, 26.9, 27.0, 38.0, 47.0, 52.9, 53.0, 53.9, 54.0, 115.9, 116.0, None]
    expected = ["G", "F", "F", "T", "A", "E", "E", "D", "D", "C", "C", "B", None]
    assert labels(spark, values, cabin_estimator) == expected


def test_fare_group_of_text(spark):
    df = spark.createDataFrame([("7.25",), (" 30 ",), ("none",), (None,)], "x string")
    assert [r[0] for r in df.select(fare_group("x")).collect()] == ["low", "high", None, None]


def test_family_size_keeps_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (0.0, 0.0)], "s double, p double")
    result = df.select(family_size("s", "p").alias("n"))
    assert [r[0] for r in result.collect()] == [4.0, None, 1.0]
    assert result.schema["n"].dataType.typeName() == "double"


def test_bucketize_checks_its_arguments(spark):
    with pytest.raises(ValueError, match="labels"):
        bucketize(F.lit(1), [1, 2], ["a", "b"])
    with pytest.raises(ValueError, match="rise"):
        bucketize(F.lit(1), [2, 1], ["a", "b", "c"])

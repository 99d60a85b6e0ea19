import pytest
from pyspark.sql import functions as F

from tabloom.operators.split import fold_number, hash_split, random_split


def test_hash_split_does_not_depend_on_partitioning(spark):
    df = spark.range(10_000)
    one = hash_split(df.repartition(1), [0.7, 0.3], 1, "id")
    many = hash_split(df.repartition(13), [0.7, 0.3], 1, "id")
    for a, b in zip(one, many):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert 6_800 < one[0].count() < 7_200
    assert one[0].count() + one[1].count() == 10_000
    other = hash_split(df, [0.7, 0.3], 2, "id")[0]
    assert not other.exceptAll(one[0]).isEmpty()


def test_hash_split_into_many_parts_is_complete(spark):
    parts = hash_split(spark.range(5_000), [1, 2, 0, 1], 3, F.col("id"))
    counts = [part.count() for part in parts]
    assert sum(counts) == 5_000 and counts[2] == 0
    assert abs(counts[1] - 2_500) < 200


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "a string, b int")
    assert sum(part.count() for part in hash_split(df, [0.5, 0.5], 1, ["a", "b"])) == 3


def test_bad_weights(spark):
    with pytest.raises(ValueError, match="weights"):
        hash_split(spark.range(1), [0.0, 0.0], 1, "id")


def test_folds_are_even_and_independent_of_the_split(spark):
    train, _ = hash_split(spark.range(20_000), [0.7, 0.3], 1, "id")
    folds = train.groupBy(fold_number(5, 1, "id").alias("f")).count().collect()
    assert sorted(r["f"] for r in folds) == [0, 1, 2, 3, 4]
    assert all(abs(r["count"] - 2_800) < 300 for r in folds)


def test_random_split_is_complete(spark):
    parts = random_split(spark.range(1_000), [0.7, 0.3], 1)
    assert sum(part.count() for part in parts) == 1_000

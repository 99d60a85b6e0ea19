import pytest

from tabloom.operators.columns import categories, category_index, one_hot, sparse_one_hot


@pytest.fixture(scope="module")
def df(spark):
    rows = [("a", 1.0, "x"), ("b", None, "x"), (None, 2.0, "x")]
    return spark.createDataFrame(rows, "s string, n double, other string")


def test_categories_keep_null(df):
    assert {r[0] for r in categories(df, "s").collect()} == {"a", "b", None}


def test_dummies_stand_in_front_and_null_gives_zeros(df):
    result = one_hot(df, ["s"], {"s": ["a", "b"]})
    assert result.columns == ["a", "b", "s", "n", "other"]
    assert {r["s"]: (r["a"], r["b"]) for r in result.collect()} == {
        "a": (1, 0),
        "b": (0, 1),
        None: (0, 0),
    }
    assert result.schema["a"].dataType.typeName() == "integer"


def test_null_category_is_all_zero_and_there_once(df):
    result = one_hot(df, ["s", "n"], {"s": ["a", "b", None], "n": [1.0, 2.0, None]}, null_category=True)
    assert result.columns[:5] == ["a", "b", "None", "1.0", "2.0"]
    assert {r["None"] for r in result.collect()} == {0}


def test_given_categories_need_no_job_and_may_be_unseen(spark, df):
    result = one_hot(df, ["s"], {"s": ["a", "z"]})
    assert result.columns[:2] == ["a", "z"]
    assert {r["z"] for r in result.collect()} == {0}


def test_names_that_differ_by_case_need_a_prefix(spark):
    df = spark.createDataFrame([("low", "Low"), ("s", "t")], "a string, b string")
    known = {"a": ["low", "s"], "b": ["Low", "t"]}
    with pytest.raises(ValueError, match="prefix"):
        one_hot(df, ["a", "b"], known)
    result = one_hot(df, ["a", "b"], known, prefix=True)
    assert result.columns[:4] == ["a_low", "a_s", "b_Low", "b_t"]


def test_a_category_named_like_a_column_needs_a_prefix(df):
    with pytest.raises(ValueError, match="prefix"):
        one_hot(df, ["s"], {"s": ["OTHER"]})


def test_a_column_without_categories_raises(df):
    with pytest.raises(ValueError, match="other"):
        one_hot(df, ["s", "other"], {"s": ["a"]})


@pytest.mark.parametrize("broadcast_bytes", [8_000_000, 0])
def test_sparse_dummies_equal_the_plain_ones(spark, df, broadcast_bytes):
    indexes = {c: category_index(df, c) for c in ("s", "n")}
    assert [tuple(r) for r in indexes["s"].orderBy("index").collect()] == [("a", 1, 0), ("b", 1, 1)]
    result = sparse_one_hot(df, indexes, "v", broadcast_bytes)
    assert result.columns == [*df.columns, "v"]
    plain = one_hot(df, ["s", "n"], {"s": ["a", "b"], "n": [1.0, 2.0]})
    expected = {(r["s"], r["n"]): [float(x) for x in r[:4]] for r in plain.collect()}
    assert {(r["s"], r["n"]): list(r["v"].toArray()) for r in result.collect()} == expected
    with pytest.raises(ValueError, match="already"):
        sparse_one_hot(df, indexes, "Other", broadcast_bytes)
    assert sparse_one_hot(df.where("false"), indexes, "v").isEmpty()


def test_a_million_categories_and_a_hot_one(spark):
    from pyspark.sql import functions as F

    value = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    rows = spark.range(0, 1_500_000, 1, 8).select("id", value.alias("c"))
    index = category_index(rows, "c", rows_per_range=200_000)
    size = 1_000_001
    assert index.count() == size
    numbers = index.agg(F.min("index"), F.max("index"), F.countDistinct("index"), F.max("rows")).first()
    assert tuple(numbers) == (0, size - 1, size, 500_000)
    found = sparse_one_hot(rows, {"c": index}).where("id IN (0, 1, 2, 1499999)").orderBy("id").collect()
    assert [(r["dummies"].size, list(r["dummies"].indices)) for r in found] == [
        (size, [0]),
        (size, [1]),
        (size, [2]),
        (size, [size - 1]),
    ]

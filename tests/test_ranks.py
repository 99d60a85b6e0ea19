import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions.keys import group_key
from tabloom.operators.attach import KEY
from tabloom.operators.ranks import grouped_quantiles, running_counts
from tabloom.sources.shared import materialize

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    """Two groups of very different size; a third of all rows carry the same value."""
    return (
        spark.range(0, 6000, 1, 5)
        .withColumn("g", F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.lit("big")))
        .withColumn("v", F.when(F.col("id") % 3 == 0, 12.5).otherwise(F.exp(F.col("id") % 700 / 30)))
    )


@pytest.mark.parametrize("rows_per_range", [1_000_000, 100, 7])
def test_quantiles_are_exact_for_any_number_of_ranges(values, rows_per_range):
    result = grouped_quantiles(values, ["g"], "v", PROBABILITIES, rows_per_range=rows_per_range)
    source = values.toPandas()
    rows = {r["g"]: r for r in result.collect()}
    assert len(rows) == 2
    for group, part in source.groupby("g", dropna=False):
        row = rows[group if isinstance(group, str) else None]
        assert row["n"] == len(part)
        expected = np.quantile(part["v"], PROBABILITIES)
        np.testing.assert_allclose([row[f"q{i}"] for i in range(len(PROBABILITIES))], expected)


def test_quantiles_of_the_whole_table_and_of_infinities(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, "inf", "-inf")] + [(None,)], "v double")
    row = grouped_quantiles(df, [], "v", [0.0, 0.5, 1.0], rows_per_range=2).first()
    assert (row["n"], row["q0"], row["q1"], row["q2"]) == (6, float("-inf"), 2.5, float("inf"))


def test_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert grouped_quantiles(df, [], "v", [0.5]).count() == 0


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("rows_per_range", [1_000_000, 50])
def test_running_counts_equal_brute_force(values, ascending, rows_per_range):
    counts = materialize(
        values.groupBy(group_key(["g"]).alias(KEY), F.col("v").alias("value")).agg(
            F.count("*").alias("n")
        )
    )
    ranked = running_counts(counts, "value", ["n"], ascending, rows_per_range)
    found = ranked.select(F.col(KEY)["g"].alias("g"), "value", "n", "before_n", "total_n").toPandas()
    for _, part in found.groupby("g", dropna=False):
        part = part.sort_values("value", ascending=ascending)
        np.testing.assert_array_equal(part["before_n"], part["n"].cumsum() - part["n"])
        assert set(part["total_n"]) == {part["n"].sum()}


def test_ranges_share_the_work(values):
    counts = materialize(
        values.groupBy(group_key([]).alias(KEY), F.col("v").alias("value")).agg(
            F.count("*").alias("n")
        )
    )
    plan = running_counts(counts, "value", ["n"], rows_per_range=50)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    assert "value_range_" in text

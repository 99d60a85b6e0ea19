import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators.attach import attach, stored_bytes
from tabloom.operators.grouped import (
    grouped_impute,
    grouped_map,
    grouped_reduce,
    grouped_standardize,
    per_group,
)

SCHEMA = "id long, g string, x double, y double"


@pytest.fixture(scope="module")
def skewed(spark):
    """2500 groups, a hot one with a third of the rows, a null one, and copies of one row."""
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None)
    return (
        spark.range(0, 9000, 1, 6)
        .withColumn("g", hot.otherwise(F.concat(F.lit("g"), F.col("id") % 2500)))
        .withColumn("x", F.when(F.col("id") % 9 == 0, 7.0).otherwise(F.col("id") * 37 % 101 / 3))
        .withColumn("y", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("x") * 2 + F.col("id") % 5))
    )


def frame(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("broadcast_bytes", [8_000_000, 0])
def test_scaling_equals_brute_force_with_and_without_broadcast(skewed, broadcast_bytes):
    result = frame(grouped_standardize(skewed, ["g"], ["x", "y"], broadcast_bytes))
    source = frame(skewed)
    for c in ("x", "y"):
        grouped = source.groupby("g", dropna=False)[c]
        deviation = grouped.transform(lambda s: s.std(ddof=0)).replace(0.0, 1.0)
        # A deviation of rounding noise may be 0 in one engine only.
        keep = deviation > 1e-9
        expected = (source[c] - grouped.transform("mean")) / deviation
        np.testing.assert_allclose(result[c][keep], expected[keep], atol=1e-9)
    assert len(result) == len(source)


def test_hot_groups_are_not_shuffled(skewed):
    plan = grouped_standardize(skewed, ["g"], ["x"], 0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Union" in text and "LeftAnti" in text


def test_even_groups_are_shuffled_once(spark):
    df = spark.range(0, 9000, 1, 6).selectExpr("id", "cast(id % 3000 as string) as g", "id * 1.0D as x")
    result = grouped_standardize(df, ["g"], ["x"], 0)
    assert "Union" not in result._jdf.queryExecution().executedPlan().toString()
    assert result.count() == 9000
    assert abs(result.agg(F.sum("x")).first()[0]) < 1e-6


def test_constant_group_scales_to_zero_and_nulls_stay(spark):
    df = spark.createDataFrame([(1, "a", 5.0, None), (2, "a", 5.0, 1.0)], SCHEMA)
    rows = frame(grouped_standardize(df, ["g"], ["x", "y"]))
    assert list(rows["x"]) == [0.0, 0.0]
    assert math.isnan(rows["y"][0]) and rows["y"][1] == 0.0


@pytest.mark.parametrize("strategy", ["mean", "median"])
@pytest.mark.parametrize("broadcast_bytes", [8_000_000, 0])
def test_imputation_equals_brute_force(skewed, strategy, broadcast_bytes):
    result = frame(grouped_impute(skewed, ["g"], "y", (), strategy, broadcast_bytes=broadcast_bytes))
    source = frame(skewed)
    fill = source.groupby("g", dropna=False)["y"].transform(strategy)
    whole = getattr(source["y"], strategy)()
    expected = source["y"].fillna(fill).fillna(whole)
    np.testing.assert_allclose(result["y"], expected, atol=1e-9)
    pd.testing.assert_frame_equal(result[["id", "g", "x"]], source[["id", "g", "x"]])


@pytest.mark.parametrize("strategy", ["mean", "median", "forest", "pooled_forest"])
def test_groups_without_known_or_without_missing_targets(spark, strategy):
    rows = [(i, "full", float(i % 2), float(i)) for i in range(6)]
    rows += [(10 + i, "empty", 1.0, None) for i in range(3)]
    rows += [(20 + i, None, float(i % 2), None if i == 0 else 3.0) for i in range(4)]
    result = frame(grouped_impute(spark.createDataFrame(rows, SCHEMA), ["g"], "y", ["x"], strategy))
    assert len(result) == 13
    assert list(result["y"][:6]) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert result["y"].notna().all()
    known = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 3.0, 3.0, 3.0]
    if strategy != "pooled_forest":
        assert result["y"][9] == 3.0
        middle = np.mean(known) if strategy != "median" else np.median(known)
        np.testing.assert_allclose(result["y"][6:9], middle)


@pytest.mark.parametrize("strategy", ["mean", "median", "forest", "pooled_forest"])
def test_nothing_known_leaves_nulls(spark, strategy):
    df = spark.createDataFrame([(1, "a", 1.0, None), (2, "b", 1.0, None)], SCHEMA)
    result = grouped_impute(df, ["g"], "y", ["x"], strategy)
    assert result.count() == 2 and result.where("y IS NOT NULL").isEmpty()


def test_forest_changes_only_missing_values_and_repeats(skewed):
    df = skewed.withColumn("g", F.when(F.col("g") == "hot", 1.0).otherwise(2.0))
    options = dict(strategy="forest", trees=5, seed=3)
    first = frame(grouped_impute(df, ["g"], "y", ["x"], **options))
    again = frame(grouped_impute(df, ["g"], "y", ["x"], **options))
    pd.testing.assert_frame_equal(first, again)
    source = frame(df)
    known = source["y"].notna()
    np.testing.assert_array_equal(first["y"][known], source["y"][known])
    for group, rows in source[known].groupby("g"):
        filled = first["y"][(source["g"] == group) & ~known]
        assert filled.between(rows["y"].min(), rows["y"].max()).all()
    # y follows x closely, so the forest has to do far better than the mean.
    truth = source["x"] * 2 + source["id"] % 5
    missing = ~known
    assert (first["y"] - truth)[missing].abs().mean() < 3.0


def test_forest_needs_features(skewed):
    with pytest.raises(ValueError, match="features"):
        grouped_impute(skewed, ["g"], "y", (), "forest")
    with pytest.raises(ValueError, match="unknown"):
        grouped_impute(skewed, ["g"], "y", ["x"], "mode")


def test_pooled_forest_takes_many_groups(skewed):
    result = grouped_impute(skewed, ["g"], "y", ["x"], "pooled_forest", trees=3)
    assert result.count() == 9000 and result.where("y IS NULL").isEmpty()


@pytest.mark.parametrize("broadcast_bytes", [8_000_000, 0])
def test_map_with_statistics_takes_any_group_size(skewed, broadcast_bytes):
    def share(batch):
        return batch.assign(share=batch["x"] / batch["whole"])

    result = frame(
        grouped_map(
            skewed.select("id", "g", "x"),
            ["g"],
            share,
            "share double, id long",
            {"whole": F.sum("x")},
            broadcast_bytes=broadcast_bytes,
        )
    )
    source = frame(skewed)
    expected = source["x"] / source.groupby("g", dropna=False)["x"].transform("sum")
    np.testing.assert_allclose(result["share"], expected)


def test_map_of_whole_groups_has_a_null_group_and_an_order(skewed):
    def count(frames):
        n, group, last = 0, None, None
        for frame in frames:
            ids = frame["id"].tolist()
            assert ids == sorted(ids) and (last is None or last <= ids[0])
            n, group, last = n + len(frame), frame["g"].iloc[0], ids[-1]
        yield pd.DataFrame({"n": [n], "g": [group]})

    sizes = grouped_map(skewed, ["g"], count, "g string, n long", order=["id"])
    expected = skewed.groupBy("g").agg(F.count("*").alias("n"))
    assert sizes.exceptAll(expected).isEmpty() and expected.exceptAll(sizes).isEmpty()


def test_forest_takes_any_number_of_groups_and_small_ones(spark):
    rows = [(g, i, float(g), None if i == 0 else float(g)) for g in range(60) for i in range(4)]
    df = spark.createDataFrame(rows, "g int, id int, x double, y double")
    for bootstrap in (False, True):
        filled = grouped_impute(df.where("g < 3"), ["g"], "y", ["x"], trees=2, bootstrap=bootstrap)
        assert filled.count() == 12 and filled.where("y IS NULL").isEmpty()
    filled = grouped_impute(df, ["g"], "y", ["x"], trees=1, parallelism=8)
    assert filled.count() == 240 and filled.where("y <> g OR y IS NULL").isEmpty()


def test_forest_does_not_depend_on_the_partitions(skewed):
    df = skewed.withColumn("g", F.lit(1))
    found = [
        frame(grouped_impute(df.repartition(n), ["g"], "y", ["x"], trees=3, bootstrap=True)) for n in (2, 7)
    ]
    pd.testing.assert_frame_equal(*found)


@pytest.mark.parametrize("strategy", ["mean", "median", "forest", "pooled_forest"])
def test_nan_is_missing_and_the_target_a_double(spark, strategy):
    rows = [(1, 1.0, 2.0), (1, 1.0, float("nan")), (1, 1.0, None), (1, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    filled = grouped_impute(df, ["g"], "y", ["x"], strategy, trees=2)
    assert sorted(r.y for r in filled.collect()) == [2.0, 3.0, 3.0, 4.0]
    whole = df.where("y = y OR y IS NULL").withColumn("y", F.nanvl("y", F.lit(None)).cast("int"))
    assert dict(grouped_impute(whole, ["g"], "y", ["x"], strategy, trees=2).dtypes)["y"] == "double"


@pytest.mark.parametrize("rows_per_state", [10_000, 4])
def test_reduce_equals_the_whole_groups_and_spreads_a_hot_one(spark, rows_per_state):
    rows = [(None if i % 7 == 0 else "hot" if i % 3 == 0 else f"g{i % 40}", float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(24)
    seen = spark.sparkContext.accumulator(0)

    def summarize(group):
        return pd.DataFrame({"n": [len(group)], "total": [group["v"].sum()], "top": [group["v"].max()]})

    def merge(states):
        seen.add(1 if len(states) > max(rows_per_state, 24) else 0)
        return pd.DataFrame({"n": [states["n"].sum()], "total": [states["total"].sum()], "top": [states["top"].max()]})

    def finish(state):
        return pd.DataFrame({"mean": state["total"] / state["n"], "top": state["top"]})

    found = grouped_reduce(
        df, ["k"], "n long, total double, top double", summarize, merge, finish, "mean double, top double", rows_per_state
    )
    whole = df.groupBy("k").agg(F.avg("v").alias("mean"), F.max("v").alias("top"))
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert seen.value == 0
    assert grouped_reduce(df.limit(0), ["k"], "n long, total double, top double", summarize, merge).count() == 0


def test_wide_statistics_are_not_broadcast(spark):
    df = spark.range(4000).selectExpr("id % 50 AS k", "CAST(id AS DOUBLE) AS v")
    per = per_group(df, ["k"], {"all_values": F.collect_list("v")})
    wide = attach(df, per, ["k"], broadcast_bytes=20_000)
    assert wide.where(F.size("all_values") != 80).isEmpty()
    assert per.agg(F.sum(stored_bytes(per, "all_values"))).first()[0] > 20_000
    narrow = per_group(df, ["k"], {"top": F.max("v")})
    assert "BroadcastHashJoin" in attach(df, narrow, ["k"], broadcast_bytes=20_000)._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("strategy", ["forest", "pooled_forest"])
def test_forests_of_counted_rows_are_those_of_all_rows(spark, monkeypatch, strategy):
    from tabloom.operators import grouped

    df = spark.range(4000).selectExpr(
        "id", "id % 2 as g", "cast(id % 3 as double) as x", "cast(id % 5 % 2 as double) as y",
        "case when id % 7 > 0 then cast(id % 3 * 10 + id % 11 + id % 2 as double) end as t",
    )
    fill = lambda: grouped.grouped_impute(df, ["g"], "t", ["x", "y"], strategy, trees=5)
    plain = {r["id"]: r["t"] for r in fill().collect()}
    sizes, build = [], grouped.RandomForestRegressor.fit

    def fit(self, rows, params=None):
        sizes.append(rows.count())
        return build(self, rows, params) if params else build(self, rows)

    monkeypatch.setattr(grouped.RandomForestRegressor, "fit", fit)
    monkeypatch.setattr(grouped, "COUNTED_FROM", 1000)
    counted = {r["id"]: r["t"] for r in fill().collect()}
    assert sizes and max(sizes) <= 2 * 3 * 2 * 11
    assert counted.keys() == plain.keys() and all(counted[i] == pytest.approx(plain[i], abs=1e-9) for i in plain)


def test_many_whole_groups_come_in_one_batch(spark):
    from tabloom.operators.grouped import grouped_map

    rows = [(k, i, None if k == "b" and i == 1 else 2**60 + i, None if k == "c" else i == 0) for k in ["a", "b", None, "c"] for i in range(3)]
    rows += [("nan", 0, 1, True)]
    df = spark.createDataFrame(rows, "k string, i int, n long, f boolean").repartition(5)

    def seen(frames):
        for frame in frames:
            kinds = f"{frame['n'].dtype} {frame['f'].dtype} {list(frame.index)}"
            yield frame[["k"]].head(1).assign(order=",".join(map(str, frame["i"])), last=str(frame["n"].iloc[-1]), kinds=kinds)

    found = grouped_map(df, ["k"], seen, "k string, order string, last string, kinds string", order=["i"])
    found = {r["k"]: (r["order"], r["last"], r["kinds"]) for r in found.collect()}
    last = str(2**60 + 2)
    assert found["a"] == ("0,1,2", last, "int64 bool [0, 1, 2]") and found[None] == found["a"]
    assert found["b"][0] == "0,1,2" and found["b"][2].startswith("float64 bool")
    assert found["c"] == ("0,1,2", last, "int64 object [0, 1, 2]") and len(found) == 5

    def some(frames):
        yield next(frames)[["k"]].head(1).assign(order="", last="", kinds="")

    # A function need not read all; a group longer than a batch goes on in further frames.
    large = spark.range(25_000).selectExpr("if(id < 24000, 'large', cast(id as string)) as k", "cast(id as int) as i", "id as n", "true as f")
    assert grouped_map(large, ["k"], some, found_schema := "k string, order string, last string, kinds string").count() == 1001
    size = lambda frames: iter([pd.DataFrame({"k": ["x"], "order": [str(sum(map(len, frames)))], "last": [""], "kinds": [""]})])
    sums = [int(r["order"]) for r in grouped_map(large, ["k"], size, found_schema, order=["i"]).collect()]
    assert sorted(sums) == [1] * 1000 + [24000]

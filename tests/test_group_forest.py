"""Forests of all groups at once against a plain recursive tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators.grouped import grouped_impute


def grow(x, y, q, depth):
    """Predictions of one tree for the rows ``q``; the first best of all splits, every value a cut."""
    mean = y.sum() / len(y)
    best = (0.0, None, None)
    for f in range(x.shape[1]) if depth else ():
        for cut in np.unique(x[:, f]):
            left = x[:, f] <= cut
            a, b = left.sum(), (~left).sum()
            if not b:
                continue
            ma, mb = y[left].sum() / a, y[~left].sum() / b
            gain = a * b / (a + b) * (ma - mb) * (ma - mb)
            if abs(ma - mb) > 1e-12 * (abs(ma) + abs(mb)) and gain > best[0]:
                best = (gain, f, cut)
    if best[1] is None:
        return np.full(len(q), mean)
    known, asked = x[:, best[1]] <= best[2], q[:, best[1]] <= best[2]
    result = np.empty(len(q))
    result[asked] = grow(x[known], y[known], q[asked], depth - 1)
    result[~asked] = grow(x[~known], y[~known], q[~asked], depth - 1)
    return result


@pytest.fixture(scope="module")
def rows(spark):
    """200 groups, one of them with a third of the rows, one null, some without a known or a missing target."""
    rng = np.random.default_rng(3)
    made = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"g{rng.integers(200)}"
        a, b, c = int(rng.integers(6)), int(rng.integers(5)), int(rng.integers(2))
        gap = g == "g7" or (g != "g8" and rng.random() < 0.2)
        made.append((i, g, float(a), float(b), c, None if gap else float(a * a - 3 * b * c + rng.integers(4)), "x"))
    return made


SCHEMA = "id long, g string, a double, b double, c int, y double, note string"


def brute(rows, depth):
    whole = np.mean([r[5] for r in rows if r[5] is not None])
    expected = {}
    for g in {r[1] for r in rows}:
        known = [r for r in rows if r[1] == g and r[5] is not None]
        asked = [r for r in rows if r[1] == g and r[5] is None]
        expected |= {r[0]: r[5] for r in known}
        if not asked:
            continue
        if known:
            x = np.array([r[2:5] for r in known], float)
            q = np.array([r[2:5] for r in asked], float)
            found = grow(x, np.array([r[5] for r in known]), q, depth)
        else:
            found = [whole] * len(asked)
        expected |= {r[0]: float(v) for r, v in zip(asked, found)}
    return expected


@pytest.mark.parametrize("depth,broadcast_bytes", [(4, 8_000_000), (3, 0)])
def test_equal_trees_match_a_recursive_tree_of_every_group(spark, rows, depth, broadcast_bytes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    result = grouped_impute(
        df, ["g"], "y", ["a", "b", "c"], "level_forest", trees=3, depth=depth, subset="all", broadcast_bytes=broadcast_bytes
    )
    assert result.columns == df.columns
    found = {r["id"]: r["y"] for r in result.collect()}
    expected = brute(rows, depth)
    assert found.keys() == expected.keys() and len(found) == len(rows)
    assert max(abs(found[i] - expected[i]) for i in found) < 1e-9


def test_trees_that_try_other_features_differ_and_repeat(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)

    def ages(parts, **options):
        filled = grouped_impute(df.repartition(parts), ["g"], "y", ["a", "b", "c"], "level_forest", depth=4, **options)
        return dict(filled.select("id", F.round("y", 9)).collect())

    forest = ages(3, trees=10)
    assert forest == ages(7, trees=10)
    assert forest != ages(3, trees=10, seed=2)
    assert forest != ages(3, trees=1)
    gaps = [r for r in rows if r[5] is None and r[1] == "hot"]
    level = np.mean([r[5] for r in rows if r[5] is not None and r[1] == "hot"])
    truth = np.array([r[2] ** 2 - 3 * r[3] * r[4] + 1.5 for r in gaps])
    error = np.mean((np.array([forest[r[0]] for r in gaps]) - truth) ** 2)
    assert error < 0.5 * np.mean((level - truth) ** 2)


def test_missing_features_nothing_known_and_no_rows(spark):
    rows = [("a", None, 1.0), ("a", float("nan"), 1.0), ("a", 5.0, 9.0), ("a", None, None), ("a", 6.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    filled = grouped_impute(df, ["g"], "y", ["x"], "level_forest", trees=2, subset="all")
    assert sorted(r["y"] for r in filled.collect()) == [1.0, 1.0, 1.0, 9.0, 9.0]
    unknown = df.withColumn("y", F.lit(None).cast("double"))
    assert grouped_impute(unknown, ["g"], "y", ["x"], "level_forest").where("y IS NULL").count() == 5
    assert grouped_impute(df.where("false"), ["g"], "y", ["x"], "level_forest").isEmpty()


def test_options_that_it_does_not_have_are_refused(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0)], "g string, x double, y double")
    for options in ({"bootstrap": True}, {"subset": "most"}, {"trees": 0}):
        with pytest.raises(ValueError):
            grouped_impute(df, ["g"], "y", ["x"], "level_forest", **options)

import pytest
from pyspark.sql import functions as F

from tabloom.operators.evaluate import confidence_summary
from tabloom.plans.clean import clean, encode, feature_engineering
from tabloom.plans.compare import compare_models
from tabloom.schemas import AREA_COLUMN, CLEAN_COLUMNS, CLEAN_SCHEMA, COMPARISON_SCHEMA, RAW_SCHEMA
from tabloom.sources.passengers import passengers
from tests.conftest import SMALL

ROWS = [
    (1.0, 0.0, 3.0, "A", "male", 22.0, 1.0, 0.0, "t", 7.25, None, "S"),
    (2.0, 1.0, 3.0, "B", "female", None, None, 0.0, "t", None, None, None),
    (3.0, None, 1.0, "C", "female", None, 4.0, 2.0, "t", 99.0, "C1", "Q"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, RAW_SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_stage(raw):
    result = feature_engineering(raw)
    assert result.columns == [
        "PassengerId", "Survived", "Pclass", "Sex", "Age", "Embarked", "family", "fare_group",
    ]
    rows = {r["PassengerId"]: (r["family"], r["fare_group"]) for r in result.collect()}
    assert rows == {1.0: ("small", "low"), 2.0: (None, None), 3.0: ("large", "very_high")}


def test_clean_table(raw):
    result = clean(raw, "forest", trees=3)
    assert result.columns == list(CLEAN_COLUMNS)
    assert [f.dataType for f in result.schema] == [f.dataType for f in CLEAN_SCHEMA]
    rows = {tuple(r[c] for c in CLEAN_COLUMNS[1:]) for r in result.collect()}
    low, none, very_high = [1.0, 0.0, 0.0, 0.0, 0.0], [0.0] * 5, [0.0, 0.0, 0.0, 1.0, 0.0]
    assert rows == {
        (0.0, 1.0, 0.0, 0.0, 1.0, *low, 3.0, 22.0),
        (1.0, 0.0, 0.0, 0.0, 0.0, *none, 3.0, 22.0),
        (1.0, 0.0, 1.0, 0.0, 0.0, *very_high, 1.0, 22.0),
    }


def test_cleaning_stays_native_and_reads_only_its_columns(spark):
    text = plan(encode(passengers(spark, SMALL)))
    assert "Python" not in text and "Exchange" not in text
    filled = plan(clean(passengers(spark, SMALL), "mean"))
    assert "Exchange hashpartitioning" not in filled and "BroadcastHashJoin" in filled
    few = plan(encode(passengers(spark, SMALL)).select("Pclass", "Age"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in few


def test_known_filter_reaches_the_scan(spark, tmp_path):
    from tabloom.operators.grouped import missing_split

    passengers(spark, SMALL).write.parquet(f"{tmp_path}/p")
    known, missing = missing_split(spark.read.parquet(f"{tmp_path}/p").select("Age"), "Age")
    assert "PushedFilters: [IsNotNull(Age)]" in plan(known)
    # NaN is missing, too, and can't be pushed down; a column of whole numbers has none.
    whole = spark.read.parquet(f"{tmp_path}/p").select(F.col("Ticket"))
    assert "PushedFilters: [IsNull(Ticket)]" in plan(missing_split(whole, "Ticket")[1])


def test_comparison_table(people):
    grids = {
        "logistic": {"regParam": [0.0], "maxIter": [2]},
        "random_forest": {"maxDepth": [2], "numTrees": [2]},
        "gbt": {"maxDepth": [1], "maxIter": [2]},
        "decision_tree": {"maxDepth": [2]},
    }
    found = compare_models(people, ["PassengerId"], grids=grids, folds=2)
    assert found.table.schema == COMPARISON_SCHEMA
    rows = found.table.collect()
    assert len(rows) == 11
    # Which metrics each model is measured by.
    measured = {
        r["Name"]: (r[AREA_COLUMN] is not None, r["Accuracy"] is not None) for r in rows
    }
    for title, flags in {
        "Logistic Regression": (True, False),
        "Random forest": (True, True),
        "Gradient-Boosted Tree Classifier": (True, True),
        "Decision Tree Classifier": (False, True),
        "Multilayer perceptron classifier": (False, True),
    }.items():
        assert measured.pop(title) == flags
        assert measured.pop(f"{title} - Cross Validation") == flags
    assert measured == {"Naive Bayes": (False, True)}
    assert rows[0]["Best_Param"] == "standard" and rows[10]["Best_Param"] == "standard"
    assert rows[1]["Best_Param"] == "regParam: 0.0 - MaxIter: 2 - elasticNetParam: 0.0"
    assert rows[9]["Best_Param"] == "unspecified"
    assert rows[0][AREA_COLUMN] > 0.8

    boxes = confidence_summary(found.confidences).collect()
    assert len(boxes) == 11 and len({r["n"] for r in boxes}) == 1
    assert all(0.33 <= r["minimum"] <= r["median"] <= r["maximum"] <= 1.0 for r in boxes)
    assert found.confidences.where(F.col("confidence").isNull()).isEmpty()


def test_comparison_takes_any_grid_and_may_be_empty(people):
    found = compare_models(people, ["PassengerId"], ["svc"], grids={"svc": {"maxIter": [2, 4]}}, folds=2, keep_submodels=True)
    assert [r["Name"] for r in found.table.collect()] == [
        "Linear Support Vector Machine",
        "Linear Support Vector Machine - Cross Validation",
    ]
    assert found.confidences.isEmpty()
    assert [len(models) for models in found.searches["svc"].submodels] == [2, 2]
    assert compare_models(people, ["PassengerId"], []).table.isEmpty()


def test_interrupted_comparison_goes_on_from_its_store(spark, people, tmp_path, monkeypatch):
    from tabloom.plans import compare

    fits = []

    def counted(name, stop_at=None):
        real = getattr(compare, name)

        def run(*args, **options):
            if len(fits) == stop_at:
                raise RuntimeError("lost")
            fits.append(name)
            return real(*args, **options)

        return run

    models = ["logistic", "naive_bayes", "decision_tree"]
    options = {"grids": {"logistic": {"maxIter": [2, 4]}, "decision_tree": {"maxDepth": [2]}}, "folds": 2}
    with monkeypatch.context() as patch:
        for name in ("fit_predict", "cross_validate"):
            patch.setattr(compare, name, counted(name, stop_at=3))
        with pytest.raises(RuntimeError, match="lost"):
            compare_models(people, ["PassengerId"], models, store=f"{tmp_path}/s", **options)
    assert fits == ["fit_predict", "cross_validate", "fit_predict"]
    fits.clear()
    for name in ("fit_predict", "cross_validate"):
        monkeypatch.setattr(compare, name, counted(name))
    found = compare_models(people.repartition(3), ["PassengerId"], models, store=f"{tmp_path}/s", **options)
    assert fits == ["fit_predict", "cross_validate"]
    fresh = compare_models(people, ["PassengerId"], models, **options)
    assert found.table.collect() == fresh.table.collect()
    assert sorted(found.confidences.collect()) == sorted(fresh.confidences.collect())
    for name, search in fresh.searches.items():
        stored = found.searches[name]
        assert (stored.maps, stored.metrics, stored.best, stored.fits) == (
            search.maps,
            search.metrics,
            search.best,
            search.fits,
        )
    with pytest.raises(ValueError, match="other rows or parameters"):
        compare_models(people, ["PassengerId"], models, store=f"{tmp_path}/s", **options | {"seed": 2})
    with pytest.raises(ValueError, match="other rows or parameters"):
        compare_models(people.where("Age < 40"), ["PassengerId"], models, store=f"{tmp_path}/s", **options)


def test_comparison_of_a_large_table_counts_its_rows_once(spark, people, monkeypatch):
    from tabloom.operators import tuning

    rows = people.select("PassengerId", "Survived", "female", "Pclass", "low").localCheckpoint()
    options = {"features": ["female", "Pclass", "low"], "folds": 2, "models": ["logistic", "gbt", "decision_tree", "naive_bayes"]}
    options["grids"] = {"logistic": {"regParam": [0.0, 0.1]}, "gbt": {"maxDepth": [2, 3], "maxIter": [3]}, "decision_tree": {"maxDepth": [2]}}
    plain = compare_models(rows, ["PassengerId"], **options)
    counts = []
    real = tuning.counted_rows
    monkeypatch.setattr(tuning, "ROWS_PER_PART", 500)
    monkeypatch.setattr(tuning, "MOST_WEIGHT", 1 / 50)
    monkeypatch.setattr(tuning, "counted_rows", lambda df: counts.append(df) or real(df))
    found = compare_models(rows, ["PassengerId"], **options)
    assert len(counts) == 3 + 2  # all rows, those of two folds, and held ones: each search counted its own before
    for mine, theirs in zip(found.table.collect(), plain.table.collect(), strict=True):
        assert mine["Name"] == theirs["Name"] and mine["Best_Param"] == theirs["Best_Param"]
        for metric in (AREA_COLUMN, "Accuracy"):
            assert mine[metric] == (theirs[metric] if theirs[metric] is None else pytest.approx(theirs[metric], abs=1e-6))

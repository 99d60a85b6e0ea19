import glob
import time
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabloom.plans.clean import clean
from tabloom.schemas import CLEAN_COLUMNS, CLEAN_SCHEMA, RAW_SCHEMA
from tabloom.sources import shared
from tabloom.sources.passengers import passengers
from tabloom.sources.shared import brief_shuffles, discard, materialize, remove_tables, shared_folder, training_table
from tabloom.sources.tables import read_checked, read_table, write_table
from tests.conftest import SMALL

RAW_ROWS = [
    (1.0, 0.0, 3.0, 'Alder, "Mr" Finn', "male", 22.0, 1.0, 0.0, "A/5", 7.25, None, "S"),
    (2.0, 1.0, 1.0, "Birch, Mrs", "female", None, 1.0, 0.0, "PC", 71.2833, "C85", None),
]


def test_csv_keeps_rows_names_with_commas_and_nulls(spark, tmp_path):
    df = spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)
    write_table(df, f"{tmp_path}/raw")
    back = read_table(spark, f"{tmp_path}/raw", RAW_SCHEMA)
    assert sorted(back.collect()) == sorted(df.collect())
    assert back.schema == RAW_SCHEMA


def test_fields_are_typed_by_position(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n")
    rows = read_table(spark, str(tmp_path / "t.csv"), "k double, v string").collect()
    assert [tuple(r) for r in rows] == [(1.0, "x")]


def test_write_fails_on_an_existing_path(spark, tmp_path):
    df = spark.range(3)
    write_table(df, f"{tmp_path}/t", format="parquet")
    with pytest.raises(AnalysisException):
        write_table(df, f"{tmp_path}/t", format="parquet")
    write_table(df, f"{tmp_path}/t", format="parquet", mode="overwrite")
    assert read_table(spark, f"{tmp_path}/t", df.schema, format="parquet").count() == 3


def test_no_row_is_lost_between_cleaning_and_training(spark, tmp_path):
    raw = passengers(spark, SMALL)
    write_table(clean(raw, "mean"), f"{tmp_path}/clean")
    back = read_table(spark, f"{tmp_path}/clean", CLEAN_SCHEMA)
    assert back.count() == raw.count()
    assert back.columns == list(CLEAN_COLUMNS)
    assert back.where("Age IS NULL OR Survived IS NULL").isEmpty()


def test_stored_tables_lie_in_the_folder_of_the_session(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(10))
    assert all(folder in name for name in df.inputFiles())


def test_partitioned_store_reads_only_the_wanted_files(spark):
    df = materialize(spark.range(100).selectExpr("id", "cast(id % 4 as int) as g"), "g")
    part = df.where("g = 2")
    assert part.count() == 25
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(g" in plan


def test_training_table_is_dealt_by_its_rows_alone(spark):
    assert training_table(spark.range(0, 1000, 1, 1)).rdd.getNumPartitions() == 1
    parts = [
        training_table(spark.range(0, 35_000, 1, n)).withColumn("part", F.spark_partition_id()).collect() for n in (1, 6)
    ]
    assert parts[0] == parts[1] and len({row.part for row in parts[0]}) == 4


def test_large_training_tables_have_larger_parts():
    assert [shared.part_count(n) for n in (0, 1, 10_000, 10_001, 640_000)] == [1, 1, 1, 2, 64]
    assert [shared.part_count(n) for n in (640_001, 6_300_000, 12_800_000)] == [64, 64, 64]
    assert shared.part_count(37_800_000) == 189  # 3,780 parts of 10,000 rows would each report in every pass
    assert shared.part_count(400_000, 50_000) == 8


def test_equal_rows_are_dealt_evenly_by_a_column_of_their_own(spark):
    rows = spark.range(0, 40_000, 1, 3).selectExpr("cast(id % 2 as double) as label", "xxhash64(id) as deal")
    table = training_table(rows, deal="deal")
    assert table.columns == ["label"]
    sizes = [row["n"] for row in table.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 11_000  # by the label alone two of them would have all rows


def test_tables_of_the_application_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_folder", lambda spark: f"{tmp_path}")
    materialize(spark.range(5))
    assert glob.glob(f"{tmp_path}/tabloom-*/table-*")
    assert remove_tables(spark)
    assert not glob.glob(f"{tmp_path}/tabloom-*")


def test_only_stored_tables_are_discarded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_folder", lambda spark: f"{tmp_path}")
    one, two = materialize(spark.range(5)), materialize(spark.range(7))
    derived = one.where("id > 1")
    discard(derived, spark.range(3))
    assert len(glob.glob(f"{tmp_path}/tabloom-*/table-*")) == 2 and derived.count() == 3
    discard(one, one)
    assert len(glob.glob(f"{tmp_path}/tabloom-*/table-*")) == 1 and two.count() == 7
    remove_tables(spark)


def test_shuffle_files_go_with_their_query(spark):
    def files():
        kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in kept.mkString(",").split(",") if "/shuffle_" in name}

    def left():
        until = time.time() + 20
        while (more := files() - before) and time.time() < until:
            time.sleep(0.1)
        return more

    df = spark.range(1000).repartition(5, "id")
    before, setting = files(), spark.conf.get(shared.SHUFFLE_CLEANUP, None)
    with pytest.raises(ZeroDivisionError), brief_shuffles(spark):
        stored = materialize(df)
        assert not left()
        assert stored.count() == 1000 and not left()
        raise ZeroDivisionError
    assert spark.conf.get(shared.SHUFFLE_CLEANUP, None) == setting


def test_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    lines = ["k,v,w", "1,x,2.5", "2,y", "3,z,1.0,more", "four,u,1.0", "5,,", '6,"a,b",7']
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    good, bad = read_checked(spark, str(tmp_path / "t.csv"), "k int, v string, w double")
    assert sorted(tuple(r) for r in good.collect()) == [(1, "x", 2.5), (5, None, None), (6, "a,b", 7.0)]
    assert sorted(r["line"] for r in bad.collect()) == ["2,y", "3,z,1.0,more", "four,u,1.0"]
    assert all(r["file"].endswith("t.csv") for r in bad.collect())
    assert good.select("v").count() == 3 and bad.count() == 3


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("v,k\nx,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_checked(spark, str(tmp_path / "t.csv"), "k int, v string")
    (tmp_path / "empty.csv").write_text("k,v\n")
    assert [part.count() for part in read_checked(spark, str(tmp_path / "empty.csv"), "k int, v string")] == [0, 0]
    with pytest.raises(ValueError):
        read_checked(spark, str(tmp_path / "t.csv"), "k int, malformed_line_ string")


def test_cluster_session_has_to_name_a_shared_folder():
    named = {}
    context = SimpleNamespace(master="spark://somewhere:7077", getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: named.get(name, default)), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)
    named["spark.checkpoint.dir"] = "hdfs://somewhere/shared/"
    assert shared_folder(session) == "hdfs://somewhere/shared"

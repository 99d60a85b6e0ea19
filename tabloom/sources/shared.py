"""Intermediate tables in the folder that all executors share.

A table that several later jobs read is written once to this folder. That cuts the lineage, so a
lost executor costs a re-read and not a recomputation, and Spark knows its size from the files.
Results that are still to be run may read these tables, so whoever owns the folder removes an
application's tables when it has ended. Who knows that nothing reads a table any more discards it before.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

ROWS_PER_PART = 10_000
#: Larger tables keep this number of parts until each has ``MOST_ROWS``: every task of every pass of a fit reports to the driver.
PARTS = 64
MOST_ROWS = 200_000
#: Makes Spark delete a query's shuffle files when it has ended, not when the driver next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: For tables of whole texts, which take a third less disk than in Spark's default, for little time.
TEXT_CODEC = "zstd"

#: Paths of the stored tables by the frames that ``materialize`` gave out.
_stored: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else the checkpoint folder already set.

    A local session that names neither uses a folder below its warehouse. On a cluster that might be a folder of
    one machine, so there one of the two has to be named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        spark.sparkContext.setCheckpointDir(f"{warehouse}/tabloom-shared")
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tabloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    """A fresh path below the shared folder; all paths of one application lie together."""
    return f"{application_folder(spark)}/table-{uuid.uuid4().hex}"


def written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written ``path`` to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"), "_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _deleted(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)


def remove_tables(spark: SparkSession) -> bool:
    """Delete the tables that this application has stored; call it once no result needs them."""
    return _deleted(spark, application_folder(spark))


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once all that was derived from them is stored; others are left."""
    for table in tables:
        path = _stored.pop(table, None)
        if path:
            _deleted(table.sparkSession, path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run within go when their query ends: for work that stores all its results."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(
    df: DataFrame, partition_by: str | None = None, schema: StructType | None = None, codec: str | None = None
) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and return the table read back.

    With ``partition_by`` a filter on that column reads only the matching files. The rows are
    rebalanced first, or every task would write a small file for every value; adaptive execution
    splits the partition of a frequent value over many tasks. ``schema`` is what the stored fields are read as, if
    not as they are: a struct as the type that is stored as one. ``codec`` compresses the files, if not the session's.
    """
    spark = df.sparkSession
    path = new_path(spark)
    if partition_by and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    table = spark.read.schema(schema or df.schema).parquet(path)
    _stored[table] = path
    return table


def part_count(rows: int, rows_per_part: int = ROWS_PER_PART) -> int:
    """Parts for ``rows`` rows: of ``rows_per_part`` rows up to ``PARTS`` parts, then larger, of ``MOST_ROWS`` rows at most."""
    parts = math.ceil(rows / rows_per_part)
    return max(1, min(parts, max(PARTS, math.ceil(rows / MOST_ROWS))))


def spread(df: DataFrame, rows: int, rows_per_part: int = ROWS_PER_PART, deal: str | None = None) -> DataFrame:
    """``df`` in partitions of about ``rows_per_part`` rows (more in large tables), for work repeated on them.

    The number of partitions follows from the number of rows alone, rows go to them by the hash of their
    plain columns and are sorted there. So a fit that draws rows by partition gives the same model
    on every machine and however the rows came. Few different rows would meet in few partitions: several partitions
    are dealt by the column ``deal`` instead, if there is one, which is then dropped.
    """
    plain = [f.name for f in df.schema if isinstance(f.dataType, (NumericType, StringType, BooleanType)) and f.name != deal]
    parts = part_count(rows, rows_per_part)
    if deal and parts > 1:
        return df.repartition(parts, deal).sortWithinPartitions(deal).drop(deal)
    df = df.drop(deal) if deal else df
    return df.repartition(parts, *plain).sortWithinPartitions(*plain) if plain else df.repartition(parts)


def training_table(df: DataFrame, rows_per_part: int = ROWS_PER_PART, deal: str | None = None) -> DataFrame:
    """Table for fits that read it several times: stored as it is, dealt out evenly whenever it is read."""
    stored = materialize(df)
    return spread(stored, stored.count(), rows_per_part, deal)

"""Table scan and table write with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tabloom.sources.shared import materialize

LINE = "malformed_line_"
FILE = "malformed_file_"


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    header: bool = True,
    format: str = "csv",
    **options: str,
) -> DataFrame:
    """Scan ``path`` with the declared schema. CSV fields get their types by position."""
    reader = spark.read.format(format).schema(schema).options(**options)
    if format == "csv":
        reader = reader.option("header", header)
    return reader.load(path)


def read_checked(
    spark: SparkSession, path: str, schema: StructType | str, header: bool = True, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV table that fit ``schema``, and the others as ``line`` and ``file``.

    A row is set aside if it has too few or too many fields, or a field that is not of its type. Empty fields are null
    and fit. A header whose names or order differ from the schema's is an error. Both parts come from one scan, whose
    result is stored.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if {LINE, FILE} & {name.lower() for name in declared.names}:
        raise ValueError(f"a column may not be called {LINE!r} or {FILE!r}")
    reader = spark.read.options(**options).option("header", header).option("enforceSchema", not header)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    rows = reader.schema(StructType([*declared.fields]).add(LINE, StringType())).csv(path)
    stored = materialize(rows.withColumn(FILE, F.input_file_name()))
    fits = F.col(LINE).isNull()
    others = stored.where(~fits).select(F.col(LINE).alias("line"), F.col(FILE).alias("file"))
    return stored.where(fits).select(*declared.names), others


def write_table(
    df: DataFrame,
    path: str,
    header: bool = True,
    mode: str = "errorifexists",
    format: str = "csv",
    **options: str,
) -> None:
    """Write ``df`` as a folder, one file per partition and with a header line in each CSV file."""
    writer = df.write.format(format).mode(mode).options(**options)
    if format == "csv":
        writer = writer.option("header", header)
    writer.save(path)

"""Categories and 0/1 columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.functions.keys import group_key
from tabloom.operators.attach import BROADCAST_BYTES, KEY, ROWS, attach
from tabloom.operators.ranks import running_counts
from tabloom.sources.shared import materialize


def categories(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column, null included."""
    return df.select(col).distinct()


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    categories: Mapping[str, Sequence],
    null_category: bool = False,
    prefix: bool = False,
) -> DataFrame:
    """Put one 0/1 column per category in front of the old columns; none is left out.

    A null value gives 0 in all of them. With ``null_category`` a null among the categories has a
    column too, named ``None`` and always 0. ``categories`` names the values of every column, as for
    ``categories(df, col)``, so no job runs; one that the data lacks is a zero column. ``prefix`` names the new columns ``column_category``.
    """
    cols = list(cols)
    unnamed = [c for c in cols if c not in categories]
    if unnamed:
        raise ValueError(f"no categories given for {unnamed}")

    def name(col, category):
        return f"{col}_{category}" if prefix else str(category)

    dummies = {}
    taken = Counter(c.lower() for c in df.columns)
    for col in cols:
        for value in categories[col]:
            label = name(col, value)
            if value is None and (not null_category or label in dummies):
                continue
            taken[label.lower()] += 1
            dummies[label] = F.when(F.col(col) == F.lit(value), 1).otherwise(0).alias(label)
    clashes = sorted(label for label, count in taken.items() if count > 1)
    if clashes:
        raise ValueError(f"column names would not be unique: {clashes}; pass prefix=True")
    return df.select(*dummies.values(), *df.columns)


def category_index(df: DataFrame, col: str, rows_per_range: int = 1_000_000) -> DataFrame:
    """Stored table of the ``value``s of a column, null left out, numbered from 0 in ``index`` by their order.

    ``rows`` counts the rows with the value. Values are counted with map-side combine and numbered range by range.
    """
    counts = materialize(df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("rows")))
    keyed = counts.select(group_key([]).alias(KEY), "value", F.lit(1).alias("one"))
    numbers = running_counts(keyed, "value", ["one"], rows_per_range=rows_per_range)
    numbered = numbers.select("value", F.col("before_one").cast("bigint").alias("index"))
    return materialize(counts.join(numbered, "value").select("value", "rows", "index"))


def sparse_one_hot(
    df: DataFrame,
    indexes: Mapping[str, DataFrame],
    output: str = "dummies",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``one_hot`` for columns of any number of values: one sparse vector column, no list of values on the driver.

    ``indexes`` has a table as from ``category_index`` for every column; their numbers follow one another in the vector, in
    the order of the columns. A null, and a value that is not in the table, gives 0 in all places. The result is a stored
    table: a vector is read back from the fields it is made of.
    """
    if output.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"there is a column {output!r} already")
    offset, places, result = 0, [], df
    for i, (col, index) in enumerate(indexes.items()):
        values = index.select("value", "rows", "index").withColumnsRenamed({"value": col, "rows": ROWS})
        lookup = materialize(
            values.select(group_key([col]).alias(KEY), ROWS, (F.col("index") + offset).cast("int").alias(f"place_{i}_"))
        )
        result = attach(result, lookup, [col], broadcast_bytes)
        places.append(f"place_{i}_")
        offset += index.count()
    if offset >= 2**31:
        raise ValueError(f"a vector has fewer than 2^31 places, not {offset}")
    found = F.array_compact(F.array(*places).cast("array<int>"))
    # The fields that a sparse vector is stored as.
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(offset).alias("size"),
        found.alias("indices"),
        F.transform(found, lambda _: F.lit(1.0)).alias("values"),
    )
    read_as = StructType([*df.schema.fields]).add(output, VectorUDT())
    return materialize(result.select(*df.columns, vector.alias(output)), schema=read_as)

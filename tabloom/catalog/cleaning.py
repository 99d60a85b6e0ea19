"""Sources, projection, scalar expressions and the clean table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.registry import (
    ENCODED_CTE,
    ENGINEERED_CTE,
    FAMILY_SQL,
    FARE_SQL,
    FOLD_SQL,
    PART_SQL,
    dummy_sql,
    query,
    rounded,
    with_p,
)
from tabloom.functions.buckets import cabin_estimator, family_group, family_size, fare_group
from tabloom.operators.columns import categories, category_index, one_hot, sparse_one_hot
from tabloom.operators.features import to_label
from tabloom.operators.split import fold_number, part_number, random_split
from tabloom.plans.clean import clean, encode, feature_engineering
from tabloom.schemas import CLEAN_COLUMNS, CLEAN_SCHEMA, DUMMIES, FEATURES, RAW_SCHEMA
from tabloom.sources.passengers import passengers, table
from tabloom.sources.shared import materialize, new_path
from tabloom.sources.tables import read_checked, read_table, write_table

def passenger_key():
    """The key as an integer, whose text is the same in every engine."""
    return F.col("PassengerId").cast("bigint")


def quoted(names):
    return ", ".join(f'"{name}"' for name in names)


@query("scan_csv", with_p("SELECT * REPLACE (round(Fare, 6) AS Fare) FROM p"))
def scan_csv(spark, sf_dir):
    path = new_path(spark)
    passengers(spark, sf_dir).write.csv(path, header=True)
    return rounded(read_table(spark, path, RAW_SCHEMA), ["Fare"])


@query("csv_roundtrip", with_p(f"SELECT {quoted(CLEAN_COLUMNS)} FROM e", ENCODED_CTE))
def csv_roundtrip(spark, sf_dir):
    path = new_path(spark)
    write_table(encode(passengers(spark, sf_dir)), path)
    return read_table(spark, path, CLEAN_SCHEMA)


@query("select_clean", with_p(f"SELECT {quoted(CLEAN_COLUMNS)} FROM e", ENCODED_CTE))
def select_clean(spark, sf_dir):
    return encode(passengers(spark, sf_dir))


@query(
    "drop_columns",
    with_p("SELECT PassengerId, Survived, Pclass, Sex, Age, SibSp, Parch, Embarked FROM p"),
)
def drop_columns(spark, sf_dir):
    return passengers(spark, sf_dir).drop("Name", "ticket", "Fare", "Cabin", "absent")


@query(
    "label_select",
    with_p(f"SELECT Survived AS label, {quoted(FEATURES)} FROM e", ENCODED_CTE),
)
def label_select(spark, sf_dir):
    return to_label(encode(passengers(spark, sf_dir)), "Survived", FEATURES)


@query(
    "family_size",
    with_p("SELECT PassengerId, CAST(SibSp + Parch + 1 AS DOUBLE) AS family_size FROM p"),
)
def family_size_query(spark, sf_dir):
    size = family_size("SibSp", "Parch").alias("family_size")
    return passengers(spark, sf_dir).select("PassengerId", size)


@query(
    "family_group",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 1 THEN 'loner'
 WHEN l_linenumber <= 4 THEN 'small' ELSE 'large' END AS family FROM lineitem""",
)
def family_group_query(spark, sf_dir):
    family = family_group("l_linenumber").alias("family")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", family)


@query("family_of_passenger", with_p(f"SELECT PassengerId, {FAMILY_SQL} AS family FROM p"))
def family_of_passenger(spark, sf_dir):
    family = family_group(family_size("SibSp", "Parch")).alias("family")
    return passengers(spark, sf_dir).select("PassengerId", family)


@query("fare_group", with_p(f"SELECT PassengerId, {FARE_SQL} AS fare_group FROM p"))
def fare_group_query(spark, sf_dir):
    fare = fare_group("Fare").alias("fare_group")
    return passengers(spark, sf_dir).select("PassengerId", fare)


@query(
    "fare_group_of_size",
    f"SELECT p_partkey, {FARE_SQL.replace('Fare', 'p_size')} AS fare_group FROM part",
)
def fare_group_of_size(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fare_group("p_size").alias("fare_group"))


@query(
    "cabin_estimator",
    """SELECT event_id, CASE WHEN value < 16 THEN 'G' WHEN value < 27 THEN 'F' WHEN value < 38 THEN 'T'
 WHEN value < 47 THEN 'A' WHEN value < 53 THEN 'E' WHEN value < 54 THEN 'D' WHEN value < 116 THEN 'C'
 ELSE 'B' END AS cabin FROM events""",
)
def cabin_estimator_query(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", cabin_estimator("value").alias("cabin"))


@query(
    "fare_from_string",
    with_p(
        f"SELECT PassengerId, {FARE_SQL} AS fare_group FROM t",
        """t AS (SELECT PassengerId, TRY_CAST(CASE WHEN Embarked IS NULL THEN 'none'
 ELSE CAST(Fare AS VARCHAR) END AS DOUBLE) AS Fare FROM p)""",
    ),
)
def fare_from_string(spark, sf_dir):
    text = F.when(F.col("Embarked").isNull(), "none").otherwise(F.col("Fare").cast("string"))
    return passengers(spark, sf_dir).select("PassengerId", fare_group(text).alias("fare_group"))


@query(
    "drop_nulls",
    with_p(
        """SELECT PassengerId, Age, Embarked FROM p
 WHERE Age IS NOT NULL AND Embarked IS NOT NULL"""
    ),
)
def drop_nulls(spark, sf_dir):
    df = passengers(spark, sf_dir).select("PassengerId", "Age", "Embarked")
    return df.na.drop(subset=["Age", "Embarked"])


@query("distinct_categories", with_p("SELECT DISTINCT Embarked FROM p"))
def distinct_categories(spark, sf_dir):
    return categories(passengers(spark, sf_dir), "Embarked")


@query(
    "one_hot",
    with_p(
        "SELECT PassengerId, "
        + ", ".join(
            [dummy_sql("Sex", v, "INTEGER") for v in ("female", "male")]
            + [dummy_sql("family", v, "INTEGER") for v in ("large", "loner", "small")]
            + [dummy_sql("Embarked", v, "INTEGER") for v in ("C", "Q", "S")]
            + ['0 AS "None"']
            + [
                dummy_sql("fare_group", v, "INTEGER")
                for v in ("Very_low", "high", "low", "mid", "very_high")
            ]
        )
        + ", Sex, family, Embarked, fare_group FROM f",
        ENGINEERED_CTE,
    ),
)
def one_hot_query(spark, sf_dir):
    df = feature_engineering(passengers(spark, sf_dir)).drop("Survived", "Pclass", "Age")
    known = {"family": ("large", "loner", "small"), "Embarked": ("C", "Q", "S", None)}
    known |= {"Sex": ("female", "male"), "fare_group": ("Very_low", "high", "low", "mid", "very_high")}
    return one_hot(df, ["Sex", "family", "Embarked", "fare_group"], known, null_category=True)


@query(
    "category_index",
    with_p(
        """SELECT Ticket AS value, count(*) AS rows, row_number() OVER (ORDER BY Ticket) - 1 AS index
 FROM p GROUP BY Ticket"""
    ),
)
def category_index_query(spark, sf_dir):
    return category_index(passengers(spark, sf_dir), "Ticket")


@query(
    "sparse_one_hot",
    with_p(
        """SELECT PassengerId, '(' || (SELECT count(*) + 3 FROM t) || ',[' || t.i
 || CASE Embarked WHEN 'C' THEN ',' || (SELECT count(*) FROM t) WHEN 'Q' THEN ',' || (SELECT count(*) + 1 FROM t)
 WHEN 'S' THEN ',' || (SELECT count(*) + 2 FROM t) ELSE '' END
 || CASE WHEN Embarked IS NULL THEN '],[1.0])' ELSE '],[1.0,1.0])' END AS dummies FROM p JOIN t USING (Ticket)""",
        "t AS (SELECT Ticket, row_number() OVER (ORDER BY Ticket) - 1 AS i FROM p GROUP BY Ticket)",
    ),
)
def sparse_one_hot_query(spark, sf_dir):
    df = passengers(spark, sf_dir).select("PassengerId", "Ticket", "Embarked")
    found = sparse_one_hot(df, {c: category_index(df, c) for c in ("Ticket", "Embarked")})
    return found.select("PassengerId", F.col("dummies").cast("string").alias("dummies"))


@query("feature_engineering", with_p("SELECT * FROM f", ENGINEERED_CTE))
def feature_engineering_query(spark, sf_dir):
    return feature_engineering(passengers(spark, sf_dir))


@query(
    "clean_mean",
    with_p(
        f"""SELECT Survived, {quoted(DUMMIES)}, Pclass,
 round(coalesce(Age, avg(Age) OVER (PARTITION BY Pclass)), 6) AS Age FROM e""",
        ENCODED_CTE,
    ),
)
def clean_mean(spark, sf_dir):
    return rounded(clean(passengers(spark, sf_dir), "mean"), ["Age"])


@query("clean_rf")
def clean_rf(spark, sf_dir):
    return rounded(clean(passengers(spark, sf_dir), "forest"), ["Age"])


@query("hash_split", with_p(f"SELECT PassengerId, {PART_SQL} AS part FROM p"))
def hash_split_query(spark, sf_dir):
    part = part_number([0.7, 0.3], 1, passenger_key()).alias("part")
    return passengers(spark, sf_dir).select("PassengerId", part)


# Which rows go where is Spark's own choice: every row in one part, and parts of about the wanted size.
@query(
    "random_split",
    with_p("SELECT count(*) AS n, count(DISTINCT PassengerId) AS ids, 0 AS in_both, true AS seven_to_three FROM p"),
)
def random_split_query(spark, sf_dir):
    stored = materialize(passengers(spark, sf_dir).select("PassengerId"))
    train, test = (part.withColumn("part", F.lit(i)) for i, part in enumerate(random_split(stored, [0.7, 0.3], 1)))
    per_id = train.unionByName(test).groupBy("PassengerId").agg(
        F.count("*").alias("rows"), F.count_distinct("part").alias("parts"), F.sum("part").alias("tests")
    )
    return per_id.agg(
        F.sum("rows").alias("n"),
        F.count("*").alias("ids"),
        F.sum(F.when(F.col("parts") > 1, 1).otherwise(0)).cast("int").alias("in_both"),
        (F.abs(F.sum("tests") / F.sum("rows") - 0.3) < 0.03).alias("seven_to_three"),
    )


@query("fold_assign", with_p(f"SELECT PassengerId, {FOLD_SQL} AS fold FROM p"))
def fold_assign(spark, sf_dir):
    fold = fold_number(5, 1, passenger_key()).alias("fold")
    return passengers(spark, sf_dir).select("PassengerId", fold)


# The same text runs in Spark SQL and in DuckDB: lines too short, too long, or with a text for a number.
LINES_SQL = """SELECT CAST(PassengerId AS BIGINT) AS id, Sex, CAST(Age AS BIGINT) AS age, CAST(PassengerId AS BIGINT) % 10 AS kind,
 concat(CAST(CAST(PassengerId AS BIGINT) AS VARCHAR(20)), CASE CAST(PassengerId AS BIGINT) % 10 WHEN 0 THEN '' WHEN 1 THEN concat(',', Sex, ',old')
 ELSE concat(',', Sex, ',', coalesce(CAST(CAST(Age AS BIGINT) AS VARCHAR(20)), '')) END,
 CASE CAST(PassengerId AS BIGINT) % 10 WHEN 2 THEN ',more' ELSE '' END) AS line FROM {p}"""


@query(
    "scan_checked",
    with_p(
        """SELECT kind > 2 AS fits, CASE WHEN kind > 2 THEN id END AS id, CASE WHEN kind > 2 THEN Sex END AS sex,
 CASE WHEN kind > 2 THEN age END AS age, CASE WHEN kind <= 2 THEN line END AS line FROM l""",
        f"l AS ({LINES_SQL.format(p='p')})",
    ),
)
def scan_checked(spark, sf_dir):
    path = new_path(spark)
    lines = spark.sql(LINES_SQL, p=passengers(spark, sf_dir))
    lines.select("line").write.text(path)
    good, bad = read_checked(spark, path, "id bigint, sex string, age bigint", header=False)
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("id", "bigint"), ("sex", "string"), ("age", "bigint"))]
    good = good.select(F.lit(True).alias("fits"), "*", F.lit(None).cast("string").alias("line"))
    return good.unionByName(bad.select(F.lit(False).alias("fits"), *none, "line"))

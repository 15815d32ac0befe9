"""Raw inputs (S1, S2) and the test-data stand-ins.

``read_csv`` is the header-CSV scan of the reference's import step, with an
explicit schema (inference only on request) and an optional pandas-style
null-token mapping.  ``read_table`` loads the driver's parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw books header and the tokens pandas reads as null.
BOOK_SCHEMA = T.StructType(
    [
        T.StructField("Name", T.StringType()),
        T.StructField("Author", T.StringType()),
        T.StructField("User Rating", T.DoubleType()),
        T.StructField("Reviews", T.LongType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Year", T.LongType()),
        T.StructField("Genre", T.StringType()),
    ]
)
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """Scan one of the given tables.

    ``spread_by`` (the caller's choice, for tables known to be a single row
    group, which cannot be split) hash-partitions an under-split scan by that
    key so per-row work runs on every slot.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread_by is not None:
        return spread(df, spread_by)
    return df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` by ``key`` only when its scan is under-split."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots, key)
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = BOOK_SCHEMA,
    infer: bool = False,
    pandas_nulls: bool = False,
    multi_line: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """S1 — header CSV with RFC-4180 quoting; malformed rows are kept.

    A field that does not parse is null; with ``corrupt_column`` the row's text
    is kept in a column of that name (null for good rows).  Files are split
    between tasks unless ``multi_line`` says that quoted fields may hold line
    breaks (then a file is one task).  With ``pandas_nulls`` the usual pandas
    null spellings become SQL nulls (string columns are read as text first,
    then mapped and cast).
    """
    reader = (
        spark.read.option("header", True)
        # a schema is applied by position: check it against the header
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )
    if pandas_nulls and schema is not None:
        text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        df = reader.schema(text_schema).csv(path)
        out = []
        for f in schema.fields:
            c = F.col(f"`{f.name}`")
            c = F.when(c.isin(PANDAS_NULL_TOKENS), F.lit(None)).otherwise(c)
            out.append((c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).alias(f.name))
        return df.select(*out)
    if schema is not None and not infer:
        if corrupt_column is not None:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def profile(df: DataFrame) -> DataFrame:
    """S2 — one row: row count, column count and the comma-joined column names."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(", ".join(df.columns)).alias("column_names"),
    )


def books_from_part(part: DataFrame) -> DataFrame:
    """Raw book rows built from ``part`` (the test-data stand-in, FIXTURES §3).

    ``Name`` carries injected dirt (a BEL control character and a double
    space) so that the cleaning path is exercised on every row.
    """
    return part.select(
        F.col("p_partkey").alias("row_key"),
        F.concat(F.col("p_name"), F.lit("\x07  "), F.col("p_brand")).alias("Name"),
        F.col("p_brand").alias("Author"),
        (F.col("p_size") / F.lit(9.0)).alias("User Rating"),
        F.col("p_partkey").alias("Reviews"),
        F.col("p_retailprice").alias("Price"),
        (F.lit(1880) + F.col("p_size") * F.lit(5)).cast("long").alias("Year"),
        F.col("p_type").alias("Genre"),
    )

"""Table readers and their reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from larder.functions.scalar import to_id
from larder.sources import schemas
from larder.sources.schemas import schema


def read_raw_csv(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """CSV with header as text columns; empty text is NULL."""
    text = StructType.fromDDL(", ".join(f"`{f.name}` string" for f in columns.fields))
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("nullValue", "").schema(text).csv(path)


def typed(raw: DataFrame, columns: StructType) -> DataFrame:
    """Cast text to the declared types; unreadable values become NULL and ``17.0`` is a valid id."""
    return raw.select(
        *[
            (to_id(f.name) if isinstance(f.dataType, LongType) else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in columns.fields
        ]
    )


BAD_LINE = "_bad_line"
QUOTES = r'(?<!\\)"'
FIELD_ENDS = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_checked_csv(spark: SparkSession, path: str, columns: StructType) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected lines) of CSV files with headers: each line that isn't blank or a header is in one of them.

    Rejected are lines with too few or too many fields, or with a quote that is never closed, as (file, line, n_fields,
    reason). A line is a record: quoted line ends aren't supported. Values that a type can't hold are NULL, as in `typed`.
    """
    names = [f.name for f in columns.fields]
    text = StructType([StructField(n, StringType()) for n in [*names, BAD_LINE]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "nullValue": ""}
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"))
    is_header = F.lower(F.regexp_replace("line", r'[\s"]', "")) == ",".join(names).lower()
    lines = lines.where((F.trim("line") != "") & ~is_header)
    parsed = lines.withColumn("r", F.from_csv("line", F.lit(text.simpleString()[7:-1].replace(":", " ")), options))
    open_quote = F.regexp_count("line", F.lit(QUOTES)) % 2 == 1
    bad = open_quote | F.col(f"r.{BAD_LINE}").isNotNull()
    n_fields = F.size(F.split("line", FIELD_ENDS, -1))
    reason = F.when(open_quote, "broken quotes").when(n_fields < len(names), "missing fields").otherwise("extra fields")
    rejected = parsed.where(bad).select("file", "line", n_fields.alias("n_fields"), reason.alias("reason"))
    return typed(parsed.where(~bad).select("r.*").drop(BAD_LINE), columns), rejected


def read_table_csv(spark: SparkSession, directory: str, table: str) -> DataFrame:
    columns = schema(table)
    return typed(read_raw_csv(spark, find_table(spark, directory, table, ("csv",)), columns), columns)


def read_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """A Parquet table, its column names trimmed and in lower case."""
    return normalise_columns(spark.read.parquet(find_table(spark, directory, table, ("parquet",))))


def find_table(spark: SparkSession, directory: str, table: str, formats: Sequence[str] = ("parquet", "csv")) -> str:
    """Path of a table whatever its case, as a file or folder, with or without extension."""
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {s.getPath().getName().lower(): s.getPath().toString() for s in files.listStatus(root)}
    for f in formats:
        for candidate in (f"{table.lower()}.{f}", table.lower()):
            if candidate in names:
                return names[candidate]
    raise FileNotFoundError(f"no {' or '.join(formats)} table {table} in {directory}")


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def infer_schema(spark: SparkSession, path: str) -> DataFrame:
    """Column names and types Spark infers for a CSV file."""
    inferred = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.createDataFrame(inferred.dtypes, "column string, type string")


def validate_types(df: DataFrame, declared: StructType) -> DataFrame:
    """Declared against actual type per declared column."""
    actual = dict(df.dtypes)
    rows = [
        (f.name, f.dataType.simpleString(), actual.get(f.name), actual.get(f.name) == f.dataType.simpleString())
        for f in declared.fields
    ]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string, ok boolean")


def parse_failures(raw: DataFrame, declared: StructType) -> DataFrame:
    """Cells with text that the declared type cannot hold, per column, in one pass."""
    cast = typed(raw.select(*[F.col(f.name) for f in declared.fields]), declared)
    both = raw.select(
        *[F.col(f.name).isNotNull().alias(f"_t_{f.name}") for f in declared.fields],
        *[
            (to_id(f.name) if isinstance(f.dataType, LongType) else F.col(f.name).try_cast(f.dataType)).isNull().alias(f"_n_{f.name}")
            for f in declared.fields
        ],
    )
    counts = both.agg(*[F.count_if(F.col(f"_t_{c}") & F.col(f"_n_{c}")).alias(c) for c in cast.columns])
    return _unpivot(counts, cast.columns, "n_bad")


def _unpivot(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in columns])
    return one_row.select(F.explode(entries).alias("e")).select("e.*")


def ingestion_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and input partitions per table."""
    frames = []
    for name, df in tables.items():
        per_partition = df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("c"))
        frames.append(
            per_partition.agg(F.sum("c").alias("rows"), F.count("*").alias("partitions")).select(
                F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("n_cols"), "partitions"
            )
        )
    return reduce(DataFrame.unionByName, frames)


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The profile of every table."""
    return reduce(DataFrame.unionByName, [profile(tables[t]).withColumn("table", F.lit(t)) for t in schemas.TABLES])


def profile(df: DataFrame) -> DataFrame:
    """Type, row count and NULL count per column, in one pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col("_rows").alias("n_rows"), F.col(c).alias("n_null")) for c, t in df.dtypes]
    )
    return counts.select(F.explode(entries).alias("e")).select("e.*")

"""Table and report writers."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from larder.sources import schemas


def write_table(df: DataFrame, directory: str, name: str) -> str:
    path = f"{directory}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


class Written(NamedTuple):
    """A table that has been written, and what was counted on the way."""

    path: str
    rows: int
    columns: int
    partitions: int
    seconds: float


def write_measured(df: DataFrame, directory: str, name: str) -> Written:
    """Write a table; rows are counted by an observation of the write itself, so the frame is evaluated once."""
    path, seen = f"{directory}/{name}", Observation(f"write_{name}")
    began = time.monotonic()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(F.spark_partition_id()).alias("last")) if df.columns else df
    counted.write.mode("overwrite").parquet(path)
    seconds = time.monotonic() - began
    return Written(path, seen.get["rows"] or 0, len(df.columns), 1 + (seen.get["last"] if seen.get["last"] is not None else -1), seconds)


def written_report(spark: SparkSession, written: Mapping[str, Written]) -> DataFrame:
    """Rows, columns, partitions and elapsed time per written table."""
    rows = [(name, w.rows, w.columns, w.partitions, round(w.seconds, 3)) for name, w in written.items()]
    return spark.createDataFrame(rows, "table string, rows long, n_cols int, partitions int, seconds double")


def check_written(spark: SparkSession, written: Written) -> DataFrame:
    """Rows counted while writing against rows read back, which the file footers tell."""
    back = spark.read.parquet(written.path).agg(F.count("*").alias("rows_back"))
    return back.select(F.lit(written.rows).cast("long").alias("rows_in"), "rows_back", (F.col("rows_back") == written.rows).alias("ok"))


def write_bucketed(df: DataFrame, path: str, key: str, table: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """A table in buckets of `key`, sorted within, registered under a name; tables of equal buckets join without an exchange.

    The frame is dealt by the key into as many tasks as buckets first, so that a bucket is one sorted file.
    """
    rows = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort)
    rows.format("parquet").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_partitioned(df: DataFrame, directory: str, name: str, ts: str, n: int = 8, salt: str | None = None) -> str:
    """Parquet partitioned by calendar month.

    Rows are spread over ``n`` tasks per month by the salt column, so a month holding most
    rows is written by several tasks.
    """
    path = f"{directory}/{name}"
    month = F.date_format(ts, "yyyy-MM")
    spread = F.pmod(F.xxhash64(salt or ts), F.lit(n))
    df.withColumn("month", month).repartition("month", spread).write.mode("overwrite").partitionBy("month").parquet(path)
    return path


def in_windows(facts: DataFrame, windows: DataFrame, ts: str, start: str, end: str, month: str = "month") -> DataFrame:
    """Each window with the facts of its days, both ends included; facts are a table partitioned by month.

    A window is a row per month that it touches, so the join is on the partition column and Spark reads, at run time,
    only the months that some window has. Windows without a start or an end hold nothing.
    """
    first, last = (F.trunc(F.col(c).cast("date"), "month") for c in (start, end))
    months = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    touched = windows.withColumn("_month", F.explode(months)).withColumn("_month", F.date_format("_month", "yyyy-MM"))
    own = facts.withColumn(month, F.col(month).cast("string"))
    joined = own.join(touched, F.col(month) == F.col("_month"))
    return joined.where(F.to_date(ts).between(F.col(start).cast("date"), F.col(end).cast("date"))).drop("_month")


def write_quarantine(df: DataFrame, directory: str, step: str) -> str:
    return write_table(df, f"{directory}/quarantine", step)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with header. ``single_file`` is for reports of known small size only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def readback_check(df: DataFrame, path: str) -> DataFrame:
    """Rows written against rows read back."""
    back = df.sparkSession.read.parquet(path)
    written = df.agg(F.count("*").alias("rows_in"))
    return written.withColumn("rows_back", back.agg(F.count("*")).scalar()).withColumn(
        "ok", F.col("rows_in") == F.col("rows_back")
    )


def export_sample(df: DataFrame, key: str, rows: int = 500) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(key).limit(rows)


def export_samples(tables: Mapping[str, DataFrame], directory: str, rows: int = 500) -> DataFrame:
    """A CSV file with the first rows of every table by its key; the rows written per table."""
    parts = []
    for name in schemas.TABLES:
        sample = tables[name].orderBy(*schemas.PRIMARY_KEYS[name], *tables[name].columns).limit(rows)
        back = sample.sparkSession.read.option("header", True).csv(write_csv(sample, f"{directory}/{name}.csv", single_file=True))
        parts.append(back.agg(F.lit(name).alias("table"), F.count("*").alias("rows")))
    return reduce(DataFrame.unionByName, parts)


def publishable(df: DataFrame, target: StructType, max_len: Mapping[str, int] | None = None) -> DataFrame:
    """Columns of the target table: missing ones as NULL, unreadable values as NULL, long text cut."""
    limits = max_len or {}
    out = []
    for f in target.fields:
        c = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in limits and isinstance(f.dataType, StringType):
            c = F.substring(c, 1, limits[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)


def publish(df: DataFrame, path: str, target: StructType, max_len: Mapping[str, int] | None = None) -> str:
    """Full refresh of a result table."""
    publishable(df, target, max_len).write.mode("overwrite").parquet(path)
    return path


def rejected_casts(df: DataFrame, target: StructType) -> DataFrame:
    """(column, value, rows): texts that a column of the target table can't hold, with the number of rows."""
    pairs = [
        F.struct(F.lit(f.name).alias("column"), F.col(f.name).cast("string").alias("value"), F.col(f.name).try_cast(f.dataType).isNull().alias("bad"))
        for f in target.fields
        if f.name in df.columns
    ]
    found = df.select(F.explode(F.array(*pairs)).alias("e")).select("e.*").where("bad AND value IS NOT NULL")
    return found.groupBy("column", "value").agg(F.count("*").alias("rows"))


class Published:
    """A result table that readers never see half-written: each version is a folder, and a manifest names the current one.

    A version is written aside, with its rejected casts, and becomes current by one rename of the manifest; a run that
    fails leaves the manifest, and so the readers, at the version before. Older versions stay until `prune`.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def publish(self, df: DataFrame, target: StructType, max_len: Mapping[str, int] | None = None) -> str:
        """Write a new version and make it current; returns its name."""
        number = max((int(v.split("-")[0]) for v in self.versions()), default=0) + 1
        version = f"{number:06d}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.root}/versions/{version}"
        publishable(df, target, max_len).write.parquet(f"{folder}/rows")
        rejected_casts(df, target).write.parquet(f"{folder}/rejected")
        self._switch({"version": version, "schema": target.json()})
        return version

    def _switch(self, manifest: Mapping[str, str]) -> None:
        aside = self._path(f"{self.root}/manifest-{uuid.uuid4().hex}")
        out = self._files.create(aside, False)
        out.write(json.dumps(dict(manifest)).encode())
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(aside, self._path(f"{self.root}/manifest"), options)

    def versions(self) -> list[str]:
        """Names of all versions that were written or begun, oldest first."""
        folder = self._path(f"{self.root}/versions")
        return sorted(s.getPath().getName() for s in self._files.listStatus(folder)) if self._files.exists(folder) else []

    def manifest(self) -> dict[str, str]:
        at = self._path(f"{self.root}/manifest")
        if not self._files.exists(at):
            raise FileNotFoundError(f"nothing is published in {self.root}")
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.root}/manifest").collect()))

    def read(self, part: str = "rows") -> DataFrame:
        """The current version, or its rejected casts with part "rejected"."""
        return self.spark.read.parquet(f"{self.root}/versions/{self.manifest()['version']}/{part}")

    def prune(self, keep: int = 2) -> list[str]:
        """Delete all but the current version and the `keep` - 1 before it; also what failed runs left."""
        current = self.manifest()["version"]
        older = [v for v in self.versions() if v < current]
        gone = [v for v in self.versions() if v != current and v not in older[max(0, len(older) - keep + 1) :]] if keep > 1 else [v for v in self.versions() if v != current]
        for version in gone:
            self._files.delete(self._path(f"{self.root}/versions/{version}"), True)
        return gone


class Reports:
    """Named reports that may be extracted as CSV."""

    def __init__(self, reports: Mapping[str, Callable[[], DataFrame]]):
        self._reports = dict(reports)

    def extract(self, name: str, path: str) -> str:
        if name not in self._reports:
            raise KeyError(f"unknown report {name}; known: {sorted(self._reports)}")
        return write_csv(self._reports[name](), path, single_file=True)

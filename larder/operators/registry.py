"""A registry of fitted models that lasts: a log of commits on shared storage, read as a table.

Each commit is one JSON file with a running number, made by an operation that fails if the number is taken: a new
hard link on a local disk, a rename that doesn't overwrite elsewhere. A writer reads the log, checks its request against
it, and commits under the next number; if another was quicker it reads and checks anew. So a (name, version, pipeline)
is registered once, and a name has one active version per pipeline, whoever writes at the same time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIPELINES = ("spark", "python")  # fixed values: the pipelines that train models
ATTEMPTS = 100

COMMIT = "number long, action string, name string, version string, pipeline string, trained_at string, metrics map<string,double>"


class DuplicateVersion(ValueError):
    """The version of this model is registered already."""


class UnknownVersion(KeyError):
    """No such version is registered."""


def version_order(version: Column) -> Column:
    """A sort key by the numbers in a version, so that 10 follows 9 and 1.10 follows 1.9; then by the text."""
    numbers = F.transform(F.regexp_extract_all(version, F.lit(r"(\d+)"), 1), lambda x: x.cast("decimal(38,0)"))
    return F.struct(numbers.alias("numbers"), version.alias("text"))


class Registry:
    """Model versions under a folder that all writers share."""

    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)) -> None:
        self.spark, self.root, self._clock = spark, root.rstrip("/"), clock
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(f"{self.root}/log")
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._folder)

    def log(self) -> DataFrame:
        """All commits, numbered from 1 without gaps."""
        return self.spark.read.schema(COMMIT).option("pathGlobFilter", "*.json").json(f"{self.root}/log")

    def _last(self) -> int:
        names = (s.getPath().getName() for s in self._files.listStatus(self._folder))
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=0)

    def _commit(self, entry: Mapping[str, object], check: Callable[[DataFrame], None]) -> int:
        """Add the entry after a check of the log as it is then; returns its number."""
        for _ in range(ATTEMPTS):
            number = self._last() + 1
            check(self.log().where(F.col("number") < number))
            if self._create(number, json.dumps({"number": number, **entry})):
                return number
        raise TimeoutError(f"{ATTEMPTS} commits in a row were overtaken")

    def _create(self, number: int, text: str) -> bool:
        """Whether the commit with this number could be made; false if there is one."""
        aside, at = self._path(f"{self.root}/.{uuid.uuid4().hex}"), self._path(self._folder, f"{number:012d}.json")
        out = self._files.create(aside, False)
        out.write(text.encode())
        out.close()
        jvm = self.spark._jvm
        try:
            if self._files.getUri().getScheme() == "file":
                link, made = (jvm.java.nio.file.Path.of(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.String, 0)) for p in (at, aside))
                jvm.java.nio.file.Files.createLink(link, made)
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
                context.rename(aside, at, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Py4JJavaError as failed:
            if "FileAlreadyExists" in failed.java_exception.getClass().getName():
                return False
            raise
        finally:
            self._files.delete(aside, False)

    def register(
        self, name: str, version: str, pipeline: str, metrics: Mapping[str, float] | None = None, trained_at: str | None = None, active: bool = False
    ) -> int:
        """Add a version; an error if it is registered or something is missing. An active one takes the place of another."""
        if not name or not version or pipeline not in PIPELINES:
            raise ValueError(f"a model needs a name, a version and one of the pipelines {PIPELINES}")

        def is_new(log: DataFrame) -> None:
            if not self._entries(log, name, version, pipeline).isEmpty():
                raise DuplicateVersion(f"{name} {version} ({pipeline})")

        entry = {
            "action": "register_active" if active else "register",
            "name": name,
            "version": version,
            "pipeline": pipeline,
            "trained_at": trained_at or self._clock().isoformat(),
            "metrics": {k: float(v) for k, v in (metrics or {}).items()},
        }
        return self._commit(entry, is_new)

    def activate(self, name: str, version: str, pipeline: str) -> int:
        """Make a registered version the active one of its name and pipeline."""

        def is_known(log: DataFrame) -> None:
            if self._entries(log, name, version, pipeline).isEmpty():
                raise UnknownVersion(f"{name} {version} ({pipeline})")

        return self._commit({"action": "activate", "name": name, "version": version, "pipeline": pipeline}, is_known)

    @staticmethod
    def _entries(log: DataFrame, name: str, version: str, pipeline: str) -> DataFrame:
        same = (F.col("name") == name) & (F.col("version") == version) & (F.col("pipeline") == pipeline)
        return log.where(F.col("action").startswith("register") & same)

    def models(self) -> DataFrame:
        """(name, version, pipeline, metrics, trained_at, registered, is_active) of every version."""
        log = self.log()
        registered = log.where(F.col("action").startswith("register"))
        made_active = log.where(F.col("action").isin("activate", "register_active"))
        current = made_active.groupBy("name", "pipeline").agg(F.max_by("version", "number").alias("current"))
        joined = registered.join(current, ["name", "pipeline"], "left")
        return joined.select(
            "name", "version", "pipeline", "metrics", "trained_at", F.col("number").alias("registered"), F.coalesce(F.col("version") == F.col("current"), F.lit(False)).alias("is_active")
        )

    def history(self, pipeline: str | None = None) -> DataFrame:
        """The versions with their place in their name's order, versions compared by their numbers."""
        rows = self.models() if pipeline is None else self.models().where(F.col("pipeline") == pipeline)
        order = Window.partitionBy("name", "pipeline").orderBy(version_order(F.col("version")))
        return rows.withColumn("place", F.row_number().over(order))

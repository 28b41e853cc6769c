"""The warehouse tables as parquet folders, partitioned by day."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast import schemas


@dataclass(frozen=True)
class TableSpec:
    schema: T.StructType
    stamp: str
    """Column whose date is the partition."""


# The tables, their layouts and partitioning stamps.
TABLES = {
    "actuals": TableSpec(schemas.ACTUALS, "hour"),
    "predictions": TableSpec(schemas.PREDICTIONS, "target_timestamp"),
    "errors": TableSpec(schemas.ERRORS, "target_timestamp"),
    "metrics_by_hour": TableSpec(schemas.HOUR_METRICS, "target_timestamp"),
    "metrics_by_day": TableSpec(schemas.DAY_METRICS, "target_date"),
    "rolling_7d": TableSpec(schemas.ROLLING, "metric_date"),
    "rolling_7d_by_zone": TableSpec(schemas.ROLLING_BY_ZONE, "metric_date"),
}

INPUTS = ("actuals", "predictions")
VERSIONS = "number bigint, folder string"
FIRST = "first"
"""Folder of a table that was only ever appended to."""


class Warehouse:
    """Tables under one shared base path; predictions and actuals under ``inputs`` where it is
    given, so that versions of the monitoring tables share them. The partition column ``day`` is never exposed.

    Every table has a list of versions beside it, and its newest one is the table. A replaced table is written
    whole as a new version, and only then listed: until that moment, and after a failed write, readers see the old one. Old
    versions stay until someone removes their folders. A table has one writer at a time.

    ``days`` of :meth:`read` is a literal range, so only those folders are listed and read.
    """

    def __init__(self, spark: SparkSession, base: str, inputs: str | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        self.inputs = (inputs or base).rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.inputs if name in INPUTS else self.base}/{name}"

    def _parquet(self, schema: T.StructType | str, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _version(self, name: str) -> tuple[int, str]:
        """Number and folder of the version in use. The list has a row for each time the table was replaced."""
        listed = self._parquet(VERSIONS, f"{self.path(name)}-versions")
        newest = None if listed is None else listed.agg(F.max(F.struct("number", "folder"))).first()[0]
        return (0, FIRST) if newest is None else (newest["number"], newest["folder"])

    def _folder(self, name: str) -> str:
        return f"{self.path(name)}/{self._version(name)[1]}"

    def _files(self, name: str) -> DataFrame | None:
        stored = T.StructType([*TABLES[name].schema.fields, T.StructField("day", T.DateType())])
        return self._parquet(stored, self._folder(name))

    def exists(self, name: str) -> bool:
        return self._files(name) is not None

    def read(self, name: str, days: tuple | None = None) -> DataFrame:
        """The table, or the range of days of it; empty before the first write."""
        spec, df = TABLES[name], self._files(name)
        if df is None:
            return self.spark.createDataFrame([], spec.schema)
        if days is not None:
            df = df.filter(F.col("day").between(F.lit(days[0]), F.lit(days[1])))
        return df.select(*spec.schema.fieldNames())

    def newest(self, name: str) -> DataFrame:
        """The last day of the table. Finding it reads the day of each folder and no column of the files."""
        df = self._files(name)
        day = None if df is None else df.agg(F.max("day")).first()[0]
        return self.read(name, None if day is None else (day, day))

    def _placed(self, name: str, df: DataFrame) -> DataFrame:
        # Rebalancing puts a day's rows together, so that tasks do not each write a file per
        # day, and lets AQE cut a day that outgrows one task.
        spec = TABLES[name]
        return (schemas.conform(df, spec.schema).withColumn("day", F.to_date(spec.stamp))
                .hint("rebalance", "day"))

    def append(self, name: str, df: DataFrame) -> None:
        self._placed(name, df).write.mode("append").partitionBy("day").parquet(self._folder(name))

    def replace(self, name: str, df: DataFrame, guard: Callable[[DataFrame], None] | None = None) -> None:
        """Truncate and load, as a new version; ``df`` may read the table itself. ``guard`` sees what was written
        before it is listed: if it raises, the old version stays the table."""
        number, folder = self._version(name)[0] + 1, f"v-{uuid.uuid4().hex}"
        self._placed(name, df).write.partitionBy("day").parquet(f"{self.path(name)}/{folder}")
        if guard is not None:
            guard(self.spark.read.schema(TABLES[name].schema).parquet(f"{self.path(name)}/{folder}"))
        listed = self.spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(folder).alias("folder")).coalesce(1)
        listed.write.mode("append").parquet(f"{self.path(name)}-versions")

    def replace_days(self, name: str, df: DataFrame) -> None:
        """Replace only the days present in ``df``; it may read the table it writes."""
        (self._placed(name, df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(self._folder(name)))

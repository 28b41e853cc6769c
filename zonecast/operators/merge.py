"""Keyed maintenance of the monitoring tables.

``insert_only`` keeps what is stored, ``upsert`` replaces it. Null keys match nothing.
The ``*_changes`` functions compute what one hour or day of one model adds; the tables
that hold them are written by :mod:`zonecast.plans.cycle`.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.stamps import instant
from zonecast.operators import monitoring, rolling
from zonecast.schemas import ZONE

# What identifies a row of each table.
ERROR_KEY = ("target_timestamp", ZONE, "model_version")
HOUR_KEY = ("target_timestamp", "model_version")
DAY_KEY = ("target_date", "model_version")
ROLLING_KEY = ("metric_date", "model_version")
ROLLING_ZONE_KEY = ("metric_date", ZONE, "model_version")


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not stored yet; repeated source rows are kept."""
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(new_rows(target, source, keys))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace the stored rows of their key. A repeated source key fails the job."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    checked = source.withColumn("copies", F.when(
        known & (copies > 1), F.raise_error(F.lit("several source rows for one key"))).otherwise(copies))
    checked = checked.filter(F.col("copies") >= 1).drop("copies")
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(checked)


def _at_hour(df: DataFrame, hour: datetime, model_version: str) -> DataFrame:
    return df.filter((F.col("target_timestamp") == instant(hour))
                     & (F.col("model_version") == model_version))


def error_changes(
    predictions: DataFrame, actuals: DataFrame, hour: datetime, model_version: str,
) -> DataFrame:
    # The hour is repeated for the actuals so that both scans are pruned.
    seen = actuals.filter(F.col("hour") == instant(hour))
    return monitoring.prediction_errors(_at_hour(predictions, hour, model_version), seen)


def hour_changes(errors: DataFrame, hour: datetime, model_version: str) -> DataFrame:
    return monitoring.metrics_by_hour(_at_hour(errors, hour, model_version))


def day_changes(errors: DataFrame, hour: datetime, model_version: str) -> DataFrame:
    start = F.date_trunc("day", instant(hour))
    stamp = F.col("target_timestamp")
    day = errors.filter((stamp >= start) & (stamp < start + F.make_dt_interval(days=F.lit(1)))
                        & (F.col("model_version") == model_version))
    return monitoring.metrics_by_day(day)


def merge_errors(errors, predictions, actuals, hour: datetime, model_version: str) -> DataFrame:
    changes = error_changes(predictions, actuals, hour, model_version)
    # Only rows of this hour and model can hold one of the new keys.
    return errors.unionByName(new_rows(_at_hour(errors, hour, model_version), changes, ERROR_KEY))


def merge_hour_metrics(table, errors, hour: datetime, model_version: str) -> DataFrame:
    changes = hour_changes(errors, hour, model_version)
    return table.unionByName(new_rows(_at_hour(table, hour, model_version), changes, HOUR_KEY))


def merge_day_metrics(table, errors, hour: datetime, model_version: str) -> DataFrame:
    return upsert(table, day_changes(errors, hour, model_version), DAY_KEY)


def merge_rolling(table, errors, hour: datetime, model_version: str) -> DataFrame:
    return upsert(table, rolling.rolling_7d_at(errors, hour, model_version), ROLLING_KEY)


def merge_rolling_by_zone(table, errors, hour: datetime, model_version: str) -> DataFrame:
    return upsert(table, rolling.rolling_7d_by_zone_at(errors, hour, model_version), ROLLING_ZONE_KEY)

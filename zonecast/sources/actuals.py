"""Reads of the actuals and predictions tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.stamps import hours, instant
from zonecast.schemas import ACTUALS, conform


def as_actuals(demand: DataFrame) -> DataFrame:
    """Hourly demand in the layout of the actuals table: the zone as text."""
    return conform(demand, ACTUALS)


def latest_hour(actuals: DataFrame) -> DataFrame:
    return actuals.agg(F.max("hour").alias("latest_hour"))


def require_latest_hour(actuals: DataFrame) -> datetime:
    """The latest hour on the driver: one value, which later scans use as a literal bound."""
    latest = latest_hour(actuals).select(F.col("latest_hour").cast("timestamp_ntz")).first()[0]
    if latest is None:
        raise ValueError("the actuals table holds no hours")
    return latest


def latest_actuals(actuals: DataFrame, lookback_hours: int, latest: datetime | None = None) -> DataFrame:
    """Rows from ``lookback_hours`` before the latest hour on, that hour included.

    With ``latest`` given the bound is a literal and prunes partitions; without it the
    maximum is a scalar subquery.
    """
    bound = latest_hour(actuals).scalar() if latest is None else instant(latest)
    return actuals.filter(F.col("hour") >= bound - hours(lookback_hours))


def next_hour_actuals(demand: DataFrame, actuals: DataFrame) -> DataFrame:
    """The rows of ``demand`` one hour after the newest actuals, ready to append."""
    following = latest_hour(actuals).scalar() + hours(1)
    return as_actuals(demand.filter(F.col("hour") == following))


def prediction_exists(predictions: DataFrame, target: datetime, model_version: str) -> bool:
    return not predictions.filter(
        (F.col("target_timestamp") == instant(target))
        & (F.col("model_version") == model_version)).isEmpty()


def without_existing(new: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions whose (target, model) is not stored yet, as a set operation.

    A key stands for the rows of all zones; the distinct keys, combined in the map tasks, are few.
    """
    key = ["target_timestamp", "model_version"]
    return new.join(predictions.select(*key).distinct(), key, "left_anti").select(*new.columns)

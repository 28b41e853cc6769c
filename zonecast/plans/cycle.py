"""The hourly cycle: append actuals, insert errors and hour metrics, refresh day and rolling rows.

Many hours are applied as one set. That gives the result of running them one by one in
order: inserts of different hours have different keys, and a day or rolling row, refreshed
at 23:00, only reads errors up to that hour.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.stamps import instant
from zonecast.operators import merge, monitoring, rolling
from zonecast.schemas import ACTUALS, ZONE, conform
from zonecast.session import stored
from zonecast.sources.actuals import require_latest_hour
from zonecast.sources.tables import Warehouse


def run_hour(
    warehouse: Warehouse, demand: DataFrame, model_version: str | None = None, again: datetime | None = None,
) -> None:
    """Apply the hour after the newest actuals. ``demand`` must have rows for it.

    ``again`` names an hour to repeat, for a run that stopped between its writes.
    """
    following = again or require_latest_hour(warehouse.newest("actuals")) + timedelta(hours=1)
    rows = demand.filter(F.col("hour") == instant(following))
    if rows.isEmpty():
        raise ValueError(f"no demand rows for {following}")
    apply_actuals(warehouse, rows, model_version)


def apply_actuals(
    warehouse: Warehouse, demand: DataFrame, model_version: str | None = None, in_parts: bool = False,
) -> None:
    """Apply all hours of ``demand``. Safe to repeat: stored keys are left alone and day and
    rolling rows are recomputed. Two dates reach the driver, for pruning the tables.

    ``in_parts`` is for cells of an hour that arrive at different times, in any order: hour rows are replaced too, and
    so are the day rows, and the rolling rows up to six days later, whose 23:00 is stored."""
    # Every step below reads the hours: they are evaluated once.
    rows = stored(conform(demand, ACTUALS), "hours")
    first, last = rows.agg(F.to_date(F.min("hour")), F.to_date(F.max("hour"))).first()
    if first is None:
        return
    span = (first, last)
    warehouse.append("actuals", merge.new_rows(
        warehouse.read("actuals", span), rows, ("hour", ZONE)))
    # Spark sizes them by the rows they come from and would shuffle the tables they are met with: a row an hour is handed to every task.
    stamps = F.broadcast(stored(rows.select(F.col("hour").alias("target_timestamp")).distinct().coalesce(1), "stamps"))
    _insert_errors(warehouse, stamps, span, model_version)
    _store_hour_metrics(warehouse, stamps, span, model_version, in_parts)
    _refresh_days(warehouse, stamps, span, model_version, in_parts)


def _of_model(df: DataFrame, model_version: str | None) -> DataFrame:
    return df if model_version is None else df.filter(F.col("model_version") == model_version)


def _insert_errors(warehouse: Warehouse, stamps: DataFrame, span: tuple[date, date], model_version) -> None:
    predictions = _of_model(warehouse.read("predictions", span), model_version)
    changes = monitoring.prediction_errors(
        predictions.join(stamps, "target_timestamp", "left_semi"), warehouse.read("actuals", span))
    warehouse.append("errors", merge.new_rows(warehouse.read("errors", span), changes, merge.ERROR_KEY))


def _store_hour_metrics(warehouse: Warehouse, stamps: DataFrame, span, model_version, in_parts: bool) -> None:
    errors = _of_model(warehouse.read("errors", span), model_version)
    changes = monitoring.metrics_by_hour(errors.join(stamps, "target_timestamp", "left_semi"))
    table = warehouse.read("metrics_by_hour", span)
    if in_parts:
        warehouse.replace_days("metrics_by_hour", merge.upsert(table, stored(changes, "hour-metrics"), merge.HOUR_KEY))
    else:
        warehouse.append("metrics_by_hour", merge.new_rows(table, changes, merge.HOUR_KEY))


def _ended_days(warehouse: Warehouse, stamps: DataFrame, span, in_parts: bool) -> tuple[DataFrame, DataFrame]:
    """Days whose day rows, and whose rolling rows, are due: their 23:00 is among the hours or, for
    hours in parts, among the stored actuals. Calendar days of the span only."""
    def days(stamp: str) -> Column:
        return F.to_date(stamp).alias("day")

    if not in_parts:
        ended = F.broadcast(stamps.filter(F.hour("target_timestamp") == 23).select(days("target_timestamp")).distinct())
        return ended, ended
    closed = warehouse.read("actuals", span).filter(F.hour("hour") == 23).select(days("hour")).distinct()
    touched = stamps.select(days("target_timestamp")).distinct()
    reached = touched.select(F.explode(F.sequence("day", F.date_add("day", rolling.DAYS - 1))).alias("day")).distinct()
    # A row a calendar day, read by four steps.
    ended, windows = (stored(closed.join(F.broadcast(some), "day", "left_semi").coalesce(1), "ended-days") for some in (touched, reached))
    return F.broadcast(ended), F.broadcast(windows)


def _refresh_days(warehouse: Warehouse, stamps: DataFrame, span, model_version, in_parts: bool) -> None:
    """Rolling rows, then day rows, of the days that have ended."""
    reach = timedelta(days=rolling.DAYS - 1)
    if in_parts:
        span = (span[0], span[1] + reach)
    ended, windows = _ended_days(warehouse, stamps, span, in_parts)
    recent = _of_model(warehouse.read("errors", (span[0] - reach, span[1])), model_version)
    today = _of_model(warehouse.read("errors", span), model_version)
    of_day = today.withColumn("day", F.to_date("target_timestamp")).join(ended, "day", "left_semi")
    for name, changes, keys in (
        ("rolling_7d", rolling.rolling_7d(recent, windows), merge.ROLLING_KEY),
        ("rolling_7d_by_zone", rolling.rolling_7d_by_zone(recent, windows), merge.ROLLING_ZONE_KEY),
        ("metrics_by_day", monitoring.metrics_by_day(of_day), merge.DAY_KEY),
    ):
        # An update reads its source twice, for the keys and for the rows.
        warehouse.replace_days(name, merge.upsert(warehouse.read(name, span), stored(changes, name), keys))


def rebuild(warehouse: Warehouse) -> None:
    """All monitoring tables from the predictions and actuals, at a base that has none yet.

    A rebuild is a new version, ``Warehouse(spark, new_base, inputs=old_base)``: the tables in
    use stay whole until readers move to it.
    """
    if warehouse.exists("errors"):
        raise ValueError(f"{warehouse.base} holds monitoring tables: rebuild at a new base")
    warehouse.replace("errors", monitoring.prediction_errors(
        warehouse.read("predictions"), warehouse.read("actuals")))
    errors = warehouse.read("errors")
    warehouse.replace("metrics_by_hour", monitoring.metrics_by_hour(errors))
    warehouse.replace("metrics_by_day", monitoring.metrics_by_day(errors))
    warehouse.replace("rolling_7d", rolling.rolling_7d(errors))
    warehouse.replace("rolling_7d_by_zone", rolling.rolling_7d_by_zone(errors))


def create_views(warehouse: Warehouse) -> None:
    """The three monitoring views over the stored tables."""
    errors = warehouse.read("errors")
    # Names of the views.
    monitoring.metrics_overall(errors).createOrReplaceTempView("vw_overall_metrics")
    monitoring.metrics_by_zone(errors).createOrReplaceTempView("vw_prediction_metrics_groupby_zone")
    monitoring.latest_rolling(warehouse.read("rolling_7d")).createOrReplaceTempView(
        "vw_latest_prediction_metrics_rolling_7d")

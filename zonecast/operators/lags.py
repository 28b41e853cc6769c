"""Lagged samples: what was known ``lag + horizon - 1`` hours before the target hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.functions.calendar import TABULAR_CALENDAR, calendar_features
from zonecast.functions.stamps import hours
from zonecast.schemas import ZONE

DEFAULT_LAGS = (1, 2, 3, 24)
Calendar = bool | Sequence[int]
"""True: the calendar of the target hour. Hours before it: the calendar of each of them. False: none."""


def calendar_hours(calendar: Calendar) -> tuple[int, ...]:
    return (() if not calendar else (0,)) if isinstance(calendar, bool) else tuple(calendar)


def calendar_names(calendar: Calendar = True) -> list[str]:
    """Names of the calendar's columns, hour by hour."""
    return [f"{name}_{before}h_before" if before else name for before in calendar_hours(calendar) for name in TABULAR_CALENDAR]


def calendar_columns(calendar: Calendar) -> list[Column]:
    values = [c for before in calendar_hours(calendar) for c in calendar_features(F.col("target_timestamp") - hours(before) if before else F.col("target_timestamp"))]
    return [c.alias(name) for c, name in zip(values, calendar_names(calendar), strict=True)]


def check_lags(lags: Sequence[int], horizon: int = 1) -> None:
    if not lags:
        raise ValueError("give at least one lag")
    if min(lags) <= 0 or horizon <= 0:
        raise ValueError("lags and horizon are positive numbers of hours")


def lag_features(
    panel: DataFrame,
    lags: Sequence[int] = DEFAULT_LAGS,
    horizon: int = 1,
    value: str = "demand",
    calendar: Calendar = True,
) -> DataFrame:
    """One row per target hour and zone: the zone's lags, the target and its calendar.

    Rows of a ``split`` column never look into another split. The window runs on the zone,
    which the panel is already partitioned by; a group holds the hours of one zone.
    """
    check_lags(lags, horizon)
    split = ["split"] if "split" in panel.columns else []
    history = Window.partitionBy(ZONE, *split).orderBy("hour")
    shift = horizon - 1
    lagged = [F.lag(value, lag + shift).over(history).alias(f"lag_{lag}") for lag in lags]
    samples = panel.select(
        *split, F.col("hour").alias("target_timestamp"), ZONE, F.col(value).alias("target"), *lagged,
        F.lag("hour", max(lags) + shift).over(history).alias("oldest"))
    kept = samples.filter(F.col("oldest").isNotNull()).drop("oldest")
    return kept.select("*", *calendar_columns(calendar))


def inference_rows(
    panel: DataFrame,
    lags: Sequence[int] = DEFAULT_LAGS,
    horizon: int = 1,
    value: str = "demand",
    calendar: Calendar = True,
) -> DataFrame:
    """The one sample per zone whose lag 1 is the latest hour of the panel.

    A panel shorter than the longest lag fails the job. Only the hours the lags point at are read, and folded per zone in one aggregate.
    """
    check_lags(lags, horizon)
    latest = panel.agg(F.max("hour").alias("latest")).scalar()
    age = F.timestamp_diff("HOUR", F.col("hour"), F.col("latest")) + 1
    recent = (
        panel.withColumn("latest", latest)
        .filter(F.col("hour") > F.col("latest") - hours(max(lags)))
        .withColumn("age", age).filter(F.col("age").isin(*lags)))
    rows = recent.groupBy(ZONE, "latest").agg(
        *[F.max(F.when(F.col("age") == lag, F.col(value))).alias(f"lag_{lag}") for lag in lags])
    missing = F.raise_error(F.lit(f"not enough history: the longest lag needs {max(lags)} hours"))
    rows = rows.select(
        F.col("latest").alias("forecast_run_timestamp"),
        (F.col("latest") + hours(horizon)).alias("target_timestamp"),
        ZONE, *[F.coalesce(F.col(f"lag_{lag}"), missing).alias(f"lag_{lag}") for lag in lags])
    return rows.select("*", *calendar_columns(calendar))


Zones = Sequence[int] | DataFrame
"""Zones in order, as a list or as the distinct values of a frame's zone column in ascending order."""


def zone_positions(spark: SparkSession, zones: Zones) -> DataFrame:
    """The zones as rows with positions from 0. Numbering a frame takes one task over the distinct zones, which
    are the entries of one array of the wide rows."""
    if isinstance(zones, DataFrame):
        distinct = zones.select(F.col(ZONE).cast("int").alias(ZONE)).dropna().distinct()
        return distinct.select(ZONE, (F.row_number().over(Window.orderBy(ZONE)) - 1).alias("position"))
    return spark.createDataFrame(
        [(int(zone), position) for position, zone in enumerate(zones)], f"{ZONE} int, position int")


def whole_cells(cells: Column, zones: Zones) -> Column:
    """``cells``, sorted by position. An array that lacks a zone or holds one twice fails the job, as its
    values would stand under other zones' names."""
    if isinstance(zones, DataFrame):
        number = zones.agg(F.count_distinct(F.col(ZONE).cast("int"))).scalar()
    else:
        number = F.lit(len(zones))
    once = (F.size(cells) == number) & (F.size(F.array_distinct(cells["position"])) == number)
    return F.when(once, F.array_sort(cells)).otherwise(
        F.raise_error(F.lit("an hour does not hold every zone once")))


def lag_matrix(
    samples: DataFrame,
    zones: Zones,
    lags: Sequence[int] = DEFAULT_LAGS,
    calendar: Calendar = True,
    labels: bool = True,
) -> DataFrame:
    """One row per target hour: all zones' lags (lag by lag, zones in order), then the calendar.

    A row is as wide as the zone list. An hour without one row for each zone fails the job.
    """
    keys = [c for c in ("split", "forecast_run_timestamp", "target_timestamp") if c in samples.columns]
    cell = F.struct(
        "position", *[F.col(f"lag_{lag}") for lag in lags], *([F.col("target")] if labels else []))
    placed = samples.join(zone_positions(samples.sparkSession, zones), ZONE)
    hour = placed.groupBy(*keys).agg(F.collect_list(cell).alias("cells"))
    hour = hour.withColumn("cells", whole_cells(F.col("cells"), zones))
    blocks = [F.col(f"cells.lag_{lag}") for lag in lags]
    if calendar_hours(calendar):
        blocks.append(F.array(*calendar_columns(calendar)))
    return hour.select(
        *keys, F.concat(*blocks).alias("features"),
        *([F.col("cells.target").alias("labels")] if labels else []))


def feature_names(lags: Sequence[int], zones: Sequence[int], calendar: Calendar = True) -> list[str]:
    """Names of the :func:`lag_matrix` features, in their order."""
    names = [f"lag_{lag}_zone_{zone}" for lag in lags for zone in zones]
    return names + calendar_names(calendar)


def feature_name_rows(zones: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, calendar: Calendar = True) -> DataFrame:
    """Rows (position, feature) of :func:`feature_names`, for a zone list of any length."""
    placed = zone_positions(zones.sparkSession, zones)
    number = zones.agg(F.count_distinct(F.col(ZONE).cast("int"))).scalar().cast("int")
    blocks = F.array(*[F.struct(F.lit(block).alias("block"), F.lit(lag).alias("lag")) for block, lag in enumerate(lags)])
    rows = placed.select(ZONE, "position", F.inline(blocks)).select(
        (F.col("block") * number + F.col("position")).alias("position"),
        F.format_string("lag_%d_zone_%d", "lag", ZONE).alias("feature"))
    if not calendar_hours(calendar):
        return rows
    named = zones.sparkSession.createDataFrame(list(enumerate(calendar_names(calendar))), "position int, feature string")
    return rows.unionByName(named.select((len(lags) * number + F.col("position")).alias("position"), "feature"))

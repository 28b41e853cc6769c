"""Windows over whole hours: every zone's value plus the calendar, hour after hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.calendar import calendar_features, sequence_calendar
from zonecast.operators.lags import Zones, whole_cells, zone_positions
from zonecast.schemas import ZONE

WEEK = 168


def hour_vectors(
    panel: DataFrame,
    zones: Zones,
    value: str = "demand",
    calendar: bool = True,
    include_month: bool = True,
    holidays: Sequence[str] | None = None,
) -> DataFrame:
    """One row per hour: ``labels`` holds the zones in order, ``features`` adds the calendar.

    An hour without one row for each zone fails the job."""
    keys = [c for c in ("split", "hour") if c in panel.columns]
    placed = panel.join(zone_positions(panel.sparkSession, zones), ZONE)
    hour = placed.groupBy(*keys).agg(
        F.collect_list(F.struct("position", F.col(value).alias("value"))).alias("cells"))
    hour = hour.withColumn("cells", whole_cells(F.col("cells"), zones))
    labels = F.col("cells.value")
    block = F.array(*calendar_features("hour", sequence_calendar(include_month), holidays))
    return hour.select(*keys, labels.alias("labels"),
                       (F.concat(labels, block) if calendar else labels).alias("features"))


def _frames(
    vectors: DataFrame, back: int, ahead: int, frames: dict[str, tuple[str, int, int]],
) -> DataFrame:
    """Collect frames of neighbouring hours around each hour, for full frames only.

    One window over all hours would run in a single task. Hours are cut into blocks
    instead, and each hour is also handed to the blocks whose frames reach it, so a group
    holds a few weeks of hours however long the history is.
    """
    split = ["split"] if "split" in vectors.columns else []
    width = max(WEEK, 4 * (back + ahead))
    index = F.unix_timestamp("hour") / 3600

    def block(position: Column) -> Column:
        return F.floor(position / width)

    shared = (
        vectors.withColumn("index", index.cast("long"))
        .withColumn("home", block(F.col("index")))
        .withColumn("block", F.explode(F.sequence(
            block(F.col("index") - ahead), block(F.col("index") + back)))))
    order = Window.partitionBy("block", *split).orderBy("index")
    collected = shared.select(
        *split, "hour", "home", "block",
        *[F.collect_list(column).over(order.rowsBetween(start, end)).alias(name)
          for name, (column, start, end) in frames.items()])
    full = F.lit(True)
    for name, (_, start, end) in frames.items():
        full = full & (F.size(name) == end - start + 1)
    return collected.filter((F.col("home") == F.col("block")) & full).drop("home", "block")


def flat_windows(vectors: DataFrame, input_len: int, horizon: int = 1) -> DataFrame:
    """``input_len`` hours of features in one array, oldest first, for the target ``horizon`` ahead."""
    _check(input_len, horizon)
    back = input_len + horizon - 1
    windows = _frames(vectors, back, 0, {
        "past": ("features", -back, -horizon), "now": ("labels", 0, 0)})
    return windows.select(
        *[c for c in windows.columns if c in ("split",)], F.col("hour").alias("target_timestamp"),
        F.flatten("past").alias("features"), F.element_at("now", 1).alias("labels"))


def sequence_windows(vectors: DataFrame, input_len: int = 24, output_len: int = 1) -> DataFrame:
    """``x``: the past ``input_len`` hours of features; ``y``: the next ``output_len`` hours of labels."""
    _check(input_len, output_len)
    windows = _frames(vectors, input_len, output_len - 1, {
        "x": ("features", -input_len, -1), "y": ("labels", 0, output_len - 1)})
    return windows.withColumnRenamed("hour", "target_timestamp")


def _check(*lengths: int) -> None:
    if min(lengths) <= 0:
        raise ValueError("lengths and horizon are positive numbers of hours")

"""Dense hour x zone panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.stamps import hours
from zonecast.functions.months import in_months
from zonecast.schemas import ZONE

# One column, or one model, per zone: beyond this many zones the long form or the array form is the one to use.
MAX_WIDE_ZONES = 10_000
TASK_CELLS = 1 << 20
"""Cells of the panel that a task fills, if the number of tasks is asked for."""


def panel_span(sparse: DataFrame) -> Column:
    """First and last hour as a scalar subquery.

    The extremes carry the demand along so that the subquery needs the same columns as
    the panel itself and Spark reuses one exchange instead of counting the trips twice.
    """
    cell = F.struct("hour", "demand")
    ends = sparse.agg(F.struct(F.min(cell).alias("first"), F.max(cell).alias("last")).alias("ends"))
    return ends.scalar()


def panel_tasks(sparse: DataFrame) -> int:
    """Tasks for the panel of a stored table: so many that each fills a bounded number of cells, whatever the size of the table."""
    seconds = F.unix_seconds("hour")
    size = sparse.agg(F.approx_count_distinct(ZONE).alias("zones"), (F.max(seconds) - F.min(seconds)).alias("span")).first()
    cells = size["zones"] * (1 + (size["span"] or 0) // 3600)
    return max(int(sparse.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-cells // TASK_CELLS))


def full_panel(sparse: DataFrame, zones: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """One row per hour and zone between the first and last hour, 0 where nothing happened.

    No grid is joined. Every sparse row knows the next hour of its zone and expands into
    itself plus the empty hours up to it; the first row of a zone also covers the hours
    before it. The only shuffle moves sparse rows, by zone, and the lags that follow are
    computed on the same partitioning. A zone has at most one row per hour.

    ``zones`` forces a zone list: others are dropped, missing ones are all zero. The span of
    hours is that of the data before this choice.

    A second row for the same hour and zone fails the job.

    The sparse rows tell Spark little about the size of the panel; ``tasks`` is the number to deal the zones over, see :func:`panel_tasks`.
    """
    by_zone = Window.partitionBy(ZONE).orderBy("hour")
    sparse = sparse.filter(F.col("hour").isNotNull())
    ends = panel_span(sparse)
    if zones is None:
        cells = sparse.select("hour", ZONE, F.coalesce("demand", F.lit(0)).cast("double").alias("demand"))
    else:
        cells = zones.select(ZONE).join(sparse.select("hour", ZONE, "demand"), ZONE, "left").select(
            "hour", ZONE, F.coalesce("demand", F.lit(0)).cast("double").alias("demand"))
    if tasks is not None:
        cells = cells.repartition(tasks, ZONE)
    placed = (
        cells.withColumn("ends", ends)
        .withColumn("earlier", F.lag("hour").over(by_zone))
        .withColumn("later", F.lead("hour").over(by_zone)))
    runs = placed.select(
        ZONE, "hour", "demand",
        F.when(F.col("earlier").isNull(), F.col("ends.first.hour")).otherwise(F.col("hour")).alias("run_start"),
        F.when(F.col("later").isNull(), F.col("ends.last.hour"))
        .when(F.col("later") == F.col("hour"), F.raise_error(F.lit("duplicate hour and zone in panel input")))
        .otherwise(F.col("later") - hours(1)).alias("run_end"))
    filled = runs.select(
        ZONE, F.col("hour").alias("seen"), "demand",
        F.explode(F.sequence("run_start", "run_end", hours(1))).alias("hour"))
    return filled.select(
        "hour", ZONE,
        F.when(F.col("hour") == F.col("seen"), F.col("demand")).otherwise(0.0).alias("demand"))


def zone_order(df: DataFrame, limit: int = MAX_WIDE_ZONES) -> list[int]:
    """The zones of a frame in ascending order, on the driver. At most ``limit`` of them."""
    rows = df.select(ZONE).dropna().distinct().orderBy(ZONE).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} zones: use rows or arrays")
    return [row[0] for row in rows]


def panel_wide(panel: DataFrame, zones: Sequence[int], value: str = "demand") -> DataFrame:
    """One row per hour, one column per zone, in the given order."""
    return panel.groupBy("hour").pivot(ZONE, list(zones)).agg(F.first(value))


def melt_wide(wide: DataFrame, zones: Sequence[int], value: str = "demand") -> DataFrame:
    """Back from one column per zone to one row per zone."""
    return wide.unpivot("hour", [F.col(f"`{z}`") for z in zones], ZONE, value).withColumn(
        ZONE, F.col(ZONE).cast("int"))


def split_by_month(panel: DataFrame, splits: dict[str, tuple[str, str]]) -> DataFrame:
    """Label the rows of each inclusive month range; rows of no range are dropped."""
    ranges = {name: in_months(panel, "hour", *span) for name, span in splits.items()}
    return _label(panel, ranges)


def split_by_day(panel: DataFrame, splits: dict[str, tuple[str, str]]) -> DataFrame:
    """As :func:`split_by_month`, for half-open ranges of days."""
    hour = F.col("hour")
    ranges = {
        name: (hour >= F.lit(start).cast("timestamp")) & (hour < F.lit(end).cast("timestamp"))
        for name, (start, end) in splits.items()}
    return _label(panel, ranges)


def _label(panel: DataFrame, ranges: dict[str, Column]) -> DataFrame:
    label = F.coalesce(*[F.when(inside, F.lit(name)) for name, inside in ranges.items()])
    return panel.withColumn("split", label).filter(F.col("split").isNotNull())


def raw_targets(panel: DataFrame, skipped_hours: int) -> DataFrame:
    """The panel of one split without its first hours, which no sample can have as target."""
    first = panel.agg(F.min("hour").alias("first")).scalar()
    return panel.filter(F.col("hour") >= first + hours(skipped_hours))

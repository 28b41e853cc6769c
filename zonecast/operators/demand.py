"""Raw trips to sparse hourly demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.months import in_months
from zonecast.schemas import ZONE


def borough_zones(lookup: DataFrame, borough: str) -> DataFrame:
    """Zone ids of one borough; the name must match exactly."""
    return (lookup.filter(F.col("Borough") == borough)
            .select(F.col("LocationID").cast("int").alias(ZONE)).distinct())


def hourly_demand(
    trips: DataFrame,
    first_month: str,
    last_month: str,
    zones: DataFrame | None = None,
    license_num: str | None = None,
) -> DataFrame:
    """Trips per (hour, zone), cells without trips absent.

    Counting is combined in each map task, so a zone with a third of all trips costs its
    reducer no more rows than a quiet one. The zone filter is written after the count:
    Catalyst moves it below while the zone list is small enough to broadcast, and
    otherwise only counted cells, never raw trips, are shuffled for it.
    """
    if license_num is not None:
        trips = trips.filter(F.col("hvfhs_license_num") == license_num)
    counted = (
        trips.filter(in_months(trips, "request_datetime", first_month, last_month))
        .select("request_datetime", F.col(ZONE).cast("int").alias(ZONE))
        .dropna(subset=[ZONE])
        .groupBy(F.date_trunc("hour", "request_datetime").alias("hour"), ZONE)
        .agg(F.count(F.lit(1)).alias("demand")))
    return counted if zones is None else counted.join(zones.select(ZONE), ZONE, "left_semi").select(
        "hour", ZONE, "demand")

"""Raw trips to the monthly hourly-demand files, all months in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.operators.demand import borough_zones, hourly_demand
from zonecast.config import DataConfig
from zonecast.sources.actuals import as_actuals
from zonecast.sources.files import read_months, read_trips, read_zone_lookup, write_months
from zonecast.sources.tables import Warehouse


def prepare_demand(spark: SparkSession, raw: str, lookup: str, config: DataConfig) -> DataFrame:
    zones = None
    if config.borough is not None:
        zones = borough_zones(read_zone_lookup(spark, lookup), config.borough)
    trips = read_trips(spark, raw, config.process_start, config.process_end)
    return hourly_demand(trips, config.process_start, config.process_end, zones, config.keep_license)


def run(spark: SparkSession, raw: str, lookup: str, processed: str, config: DataConfig) -> None:
    write_months(prepare_demand(spark, raw, lookup, config), processed)


def load_actuals(spark: SparkSession, processed: str, warehouse: Warehouse, first: str, last: str) -> None:
    """Replace the actuals table by a range of processed months."""
    warehouse.replace("actuals", as_actuals(read_months(spark, processed, first, last)))

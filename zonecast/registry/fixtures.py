"""Demand tables derived from the driver's tables.

Trips are events: the licence is the event type, the zone the user. The zone lookup is
the customer table with the region of the customer's nation as borough, so zones and
trips grow with the data. Operators with one column or array entry per zone use the
nation of the customer as zone instead, a list that stays short.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.stamps import hours
from zonecast.operators.demand import hourly_demand
from zonecast.operators.lags import DEFAULT_LAGS, lag_features
from zonecast.operators.monitoring import prediction_errors
from zonecast.operators.panel import full_panel, panel_tasks, split_by_day
from zonecast.operators.scaling import fit_scaler
from zonecast.schemas import PREDICTIONS, ZONE, conform
from zonecast.session import prepare_session, shared_folder, stored
from zonecast.sources.tables import Warehouse

# Layouts of the driver's tables.
LAYOUTS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}

MONTH = "2024-01"
SPLITS = {
    "train": ("2024-01-01", "2024-01-21"),
    "validation": ("2024-01-21", "2024-01-26"),
    "test": ("2024-01-26", "2024-01-31"),
}


def naive_24():
    return F.col("lag_24")


def lag_mean():
    return (F.col("lag_1") + F.col("lag_2") + F.col("lag_3") + F.col("lag_24")) / 4


MODELS = {"naive_24": naive_24, "lagmean_1_2_3_24": lag_mean}


def stand_in_predictions(panel: DataFrame) -> DataFrame:
    """Two models anyone can recompute: the value a day ago and a mean of lags."""
    samples = lag_features(panel, DEFAULT_LAGS, calendar=False)
    made = F.array(*[F.struct(F.lit(name).alias("model_version"), value().alias("predicted_demand"))
                     for name, value in MODELS.items()])
    rows = samples.select("target_timestamp", ZONE, F.inline(made))
    return conform(rows.withColumn(
        "forecast_run_timestamp", F.col("target_timestamp") - hours(1)), PREDICTIONS)


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare_session(spark), sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(LAYOUTS[name]).parquet(self.path(name))

    @cached_property
    def trips(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_type").alias("hvfhs_license_num"), F.col("ts").alias("request_datetime"),
            F.col("user_id").cast("int").alias(ZONE))

    @cached_property
    def nations(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("nation"), F.trim("r_name").alias("Borough"))

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("int").alias(ZONE), F.col("c_nationkey").alias("nation"))

    @cached_property
    def zone_lookup(self) -> DataFrame:
        return self.customers.join(self.nations, "nation").select(
            F.col(ZONE).alias("LocationID"), "Borough")

    @cached_property
    def counted(self) -> DataFrame:
        """Hourly demand straight from the trips."""
        return hourly_demand(self.trips, MONTH, MONTH)

    @cached_property
    def hourly(self) -> DataFrame:
        """Hourly demand as the processed table the later stages read, so that each of their
        passes reads counted cells and none counts the trips again."""
        return stored(self.counted, "hourly")

    @cached_property
    def panel(self) -> DataFrame:
        return full_panel(self.hourly, tasks=panel_tasks(self.hourly))

    @cached_property
    def split_panel(self) -> DataFrame:
        return split_by_day(self.panel, SPLITS)

    @cached_property
    def scaler(self) -> DataFrame:
        """Fitted on the training days and kept, as a training run keeps it."""
        return stored(fit_scaler(self.split_panel.filter(F.col("split") == "train")), "scaler")

    @cached_property
    def nation_hourly(self) -> DataFrame:
        return self.hourly.join(self.customers, ZONE).groupBy("hour", F.col("nation").alias(ZONE)).agg(
            F.sum("demand").alias("demand"))

    @cached_property
    def nation_panel(self) -> DataFrame:
        return full_panel(self.nation_hourly)

    @cached_property
    def order_days(self) -> DataFrame:
        """Orders per day and customer: demand over several years, at midnights."""
        return self.table("orders").groupBy(
            F.date_trunc("hour", "o_orderdate").alias("hour"), F.col("o_custkey").cast("int").alias(ZONE)
        ).agg(F.count(F.lit(1)).alias("demand"))

    @cached_property
    def predictions(self) -> DataFrame:
        return stand_in_predictions(self.panel)

    @cached_property
    def errors(self) -> DataFrame:
        return prediction_errors(self.predictions, self.hourly)

    @cached_property
    def stored_errors(self) -> DataFrame:
        """For operators that read the error table more than once."""
        return stored(self.errors, "errors")

    @cached_property
    def monitored(self) -> Warehouse:
        """Errors as a stored table, for operators that read some of its days."""
        warehouse = Warehouse(self.spark, shared_folder(self.spark, "tables"))
        warehouse.replace("errors", self.errors)
        return warehouse

    @cached_property
    def stored_predictions(self) -> DataFrame:
        return stored(self.predictions, "predictions")

    @cached_property
    def stored_errors_dense(self) -> DataFrame:
        return stored(self.errors_dense, "errors")

    @cached_property
    def errors_dense(self) -> DataFrame:
        return prediction_errors(self.predictions, self.panel, dense=True)

    @cached_property
    def test_cells(self) -> DataFrame:
        """Lag-mean predictions of the test split beside their targets, zero hours included."""
        # One pass over the panel, so the trips are counted in it and not stored before.
        test = split_by_day(full_panel(self.counted), SPLITS).filter(F.col("split") == "test").drop("split")
        samples = lag_features(test, DEFAULT_LAGS, calendar=False)
        return samples.select(
            "target_timestamp", F.col(ZONE).alias("zone"), lag_mean().alias("predicted"),
            F.col("target").alias("actual"))

    @cached_property
    def importance(self) -> DataFrame:
        """Stand-in model importance: how strongly the target of a zone moves with its own lags
        and with the calendar."""
        samples = lag_features(self.panel, DEFAULT_LAGS)
        lags = [f"lag_{lag}" for lag in DEFAULT_LAGS]
        calendar = samples.columns[samples.columns.index("hour_sin"):]
        strengths = samples.groupBy(ZONE).agg(
            *[F.round(F.coalesce(F.abs(_correlation(name)), F.lit(0.0)), 6).alias(name)
              for name in (*lags, *calendar)])
        rows = F.array(*[
            F.struct(F.concat(F.lit(f"{name}_zone_"), F.col(ZONE).cast("string")).alias("feature"),
                     F.col(name).alias("importance")) for name in lags],
            *[F.struct(F.lit(name).alias("feature"), F.col(name).alias("importance")) for name in calendar])
        return strengths.select(F.col(ZONE).alias("target_zone"), F.inline(rows))


def _correlation(name: str):
    """Null where either side does not vary."""
    varies = (F.min(name) != F.max(name)) & (F.min("target") != F.max("target"))
    spread = F.stddev_pop(name) * F.stddev_pop("target")
    return F.when(varies, F.try_divide(F.covar_pop(name, "target"), spread))

"""One entry per operator: (spark, sf_dir) -> DataFrame, comparable with the SQL in ``oracles``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.stamps import instant
from zonecast.functions.calendar import calendar_features
from zonecast.functions.months import month_list
from zonecast.operators import (comparison, evaluation, importance, lags, merge, monitoring, panel, rolling, scaling,
                                sequences)
from zonecast.operators.demand import borough_zones, hourly_demand
from zonecast.plans import cycle, predict, train
from zonecast.config import BoostingConfig
from zonecast.registry.fixtures import LAYOUTS, MODELS, MONTH, Fixtures, lag_mean, naive_24
from zonecast.schemas import ZONE
from zonecast.session import shared_folder
from zonecast.sources import actuals, buckets, files, hour_blocks, sqlfiles
from zonecast.sources.tables import Warehouse
from zonecast.streaming import event_time, rolling_state
from zonecast.streaming.cycle_stream import run_cycle_stream
from zonecast.streaming.demand_stream import hourly_demand_stream, read_demand_stream, run_demand_stream

Query = Callable[[SparkSession, str], DataFrame]

HOUR = datetime(2024, 1, 25, 23)
"""The hour the merges apply: the last one of a day, so that every merge has work to do."""
MODEL = "lagmean_1_2_3_24"
LAST_DAY = datetime(2024, 1, 30)

QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Stamps without zone and doubles to six digits, as the SQL side has them.

    The rounding is half away from zero in double arithmetic; ``round`` goes through decimals
    row by row and took longer than the lags themselves.
    """
    def column(field: T.StructField) -> str:
        value = name = f"`{field.name}`"
        if isinstance(field.dataType, T.TimestampType):
            value = f"cast({name} as timestamp_ntz)"
        elif isinstance(field.dataType, T.DoubleType):
            value = f"signum({name}) * floor(abs({name} * 1e6D) + 0.5D) / 1e6D + 0.0D"
        return f"{value} as {name}"
    return df.selectExpr(*[column(field) for field in df.schema.fields])


def query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    QUERIES[build.__name__.rstrip("_")] = lambda spark, sf_dir: present(build(Fixtures(spark, sf_dir)))
    return build


def before(df: DataFrame, column: str, stamp: datetime) -> DataFrame:
    return df.filter(F.col(column) < instant(stamp))


# --- months, demand, actuals -------------------------------------------------------------

@query
def month_list_(fx):
    return month_list(fx.table("orders"), "o_orderdate")


@query
def load_months(fx):
    folder = shared_folder(fx.spark, "months")
    files.write_months(fx.order_days, folder)
    return files.read_months(fx.spark, folder, "1995-01", "2001-12")


@query
def hourly_demand_(fx):
    return fx.counted


@query
def hourly_demand_borough(fx):
    return hourly_demand(fx.trips, MONTH, MONTH, borough_zones(fx.zone_lookup, "ASIA"))


@query
def hourly_demand_license(fx):
    return hourly_demand(fx.trips, MONTH, MONTH, license_num="purchase")


@query
def borough_zones_(fx):
    return borough_zones(fx.zone_lookup, "ASIA")


@query
def actuals_load(fx):
    return actuals.as_actuals(fx.counted)


@query
def latest_timestamp(fx):
    return actuals.latest_hour(fx.counted)


@query
def latest_actuals(fx):
    return actuals.latest_actuals(actuals.as_actuals(fx.hourly), max(lags.DEFAULT_LAGS))


@query
def next_hour_actuals(fx):
    return actuals.next_hour_actuals(fx.hourly, before(fx.hourly, "hour", LAST_DAY))


@query
def prediction_exists(fx):
    stored = before(fx.predictions.filter(F.col("model_version") == MODEL), "target_timestamp", HOUR)
    return actuals.without_existing(fx.predictions, stored)


# --- panels and features -----------------------------------------------------------------

@query
def full_panel(fx):
    return fx.panel


@query
def align_zones(fx):
    return panel.full_panel(fx.hourly, borough_zones(fx.zone_lookup, "ASIA"))


@query
def panel_wide(fx):
    zones = panel.zone_order(fx.nations.withColumnRenamed("nation", ZONE))
    aligned = panel.full_panel(fx.nation_hourly, lags.zone_positions(fx.spark, zones))
    wide = panel.panel_wide(aligned, zones)
    return wide.select("hour", *[F.col(f"`{z}`").alias(f"zone_{z}") for z in zones])


@query
def panel_melted(fx):
    zones = panel.zone_order(fx.nation_hourly)
    return panel.melt_wide(panel.panel_wide(fx.nation_panel, zones), zones)


@query
def split_by_month(fx):
    return panel.split_by_month(fx.order_days, {
        "train": ("1995-01", "1998-12"), "validation": ("1999-01", "1999-12"), "test": ("2000-01", "2001-12")})


@query
def raw_targets(fx):
    test = fx.split_panel.filter(F.col("split") == "test").drop("split")
    return panel.raw_targets(test, max(lags.DEFAULT_LAGS))


@query
def time_features(fx):
    return fx.hourly.select("hour").distinct().select("hour", *calendar_features("hour"))


@query
def fit_scaler(fx):
    return scaling.fit_scaler(fx.split_panel.filter(F.col("split") == "train"))


@query
def fit_scaler_all(fx):
    return scaling.fit_scaler(fx.panel)


@query
def scaler_by_months(fx):
    """The scaler of all order days: months stored one time and the last year added later, none of them read again."""
    folder = shared_folder(fx.spark, "moments")
    last = F.col("hour") >= F.lit("2001-01-01").cast("timestamp")
    scaling.add_months(fx.order_days.filter(~last), folder)
    scaling.add_months(fx.order_days.filter(last), folder)
    return scaling.merged_scaler(scaling.read_moments(fx.spark, folder))


@query
def scaled_panel(fx):
    return scaling.scale(fx.split_panel, fx.scaler)


@query
def inverse_scaled(fx):
    scaler = scaling.fit_scaler(fx.panel)
    return scaling.unscale(scaling.scale(fx.panel, scaler), scaler)


@query
def lag_features(fx):
    return lags.lag_features(fx.split_panel)


@query
def lag_features_horizon_3(fx):
    return lags.lag_features(fx.split_panel, (1, 2, 24), horizon=3)


def _entries(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as rows, so that every entry is compared."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("part"), F.col(c).alias("values")) for c in columns])
    return df.select("target_timestamp", F.inline(entries)).select(
        "target_timestamp", "part", F.posexplode("values").alias("position", "value"))


@query
def lag_matrix(fx):
    zones = fx.nation_hourly.select(ZONE)
    samples = lags.lag_features(fx.nation_panel, calendar=False)
    return _entries(lags.lag_matrix(samples, zones), "features", "labels")


@query
def feature_names(fx):
    return lags.feature_name_rows(fx.nation_hourly.select(ZONE))


@query
def sequence_features(fx):
    vectors = sequences.hour_vectors(fx.nation_panel, fx.nation_hourly.select(ZONE))
    return vectors.select("hour", F.posexplode("features").alias("position", "value"))


@query
def flat_windows(fx):
    vectors = sequences.hour_vectors(fx.nation_panel, fx.nation_hourly.select(ZONE))
    return _entries(sequences.flat_windows(vectors, 24), "features", "labels")


@query
def sequence_windows(fx):
    vectors = sequences.hour_vectors(fx.nation_panel, fx.nation_hourly.select(ZONE))
    windows = sequences.sequence_windows(vectors)
    return _entries(windows.withColumns({"x": F.flatten("x"), "y": F.flatten("y")}), "x", "y")


def _stored_hours(fx) -> str:
    folder = shared_folder(fx.spark, "hours")
    hour_blocks.store_hours(sequences.hour_vectors(fx.nation_panel, fx.nation_hourly.select(ZONE)), folder)
    return folder


@query
def flat_samples_by_reference(fx):
    return _entries(hour_blocks.flat_samples(fx.spark, _stored_hours(fx), 24), "features", "labels")


@query
def sequence_samples_by_reference(fx):
    """Two days of hours and the six that follow."""
    samples = hour_blocks.sequence_samples(fx.spark, _stored_hours(fx), 48, 6)
    return _entries(samples.withColumns({"x": F.flatten("x"), "y": F.flatten("y")}), "x", "y")


# --- predictions -------------------------------------------------------------------------

@query
def batch_predictions(fx):
    return predict.batch_predictions(
        actuals.as_actuals(fx.hourly), fx.scaler, predict.column_predictor(lag_mean()), MODEL)


@query
def inference_row(fx):
    return lags.inference_rows(fx.panel)


@query
def next_hour_prediction(fx):
    """Lag 24 of the hour after the latest actuals; the stored predictions end one hour earlier."""
    recent = actuals.latest_actuals(actuals.as_actuals(fx.hourly), max(lags.DEFAULT_LAGS))
    return predict.next_hour_prediction(
        recent, fx.predictions, fx.scaler, predict.column_predictor(naive_24()), "naive_24")


# --- monitoring --------------------------------------------------------------------------

@query
def prediction_error(fx):
    return fx.errors


@query
def prediction_error_dense(fx):
    return fx.errors_dense


@query
def metrics_by_hour(fx):
    return monitoring.metrics_by_hour(fx.errors)


@query
def metrics_by_hour_dense(fx):
    return monitoring.metrics_by_hour(fx.errors_dense)


@query
def metrics_by_day(fx):
    return monitoring.metrics_by_day(fx.errors)


@query
def metrics_by_day_dense(fx):
    return monitoring.metrics_by_day(fx.errors_dense)


@query
def metrics_by_zone(fx):
    return monitoring.metrics_by_zone(fx.errors)


@query
def metrics_by_zone_dense(fx):
    return monitoring.metrics_by_zone(fx.errors_dense)


@query
def metrics_overall(fx):
    return monitoring.metrics_overall(fx.errors)


@query
def metrics_overall_dense(fx):
    return monitoring.metrics_overall(fx.errors_dense)


@query
def rolling_7d_bulk(fx):
    return rolling.rolling_7d(fx.errors)


@query
def rolling_7d_bulk_dense(fx):
    return rolling.rolling_7d(fx.errors_dense)


@query
def rolling_7d_byzone_bulk(fx):
    return rolling.rolling_7d_by_zone(fx.errors)


@query
def rolling_7d_byzone_bulk_dense(fx):
    return rolling.rolling_7d_by_zone(fx.errors_dense)


def _shifted(fx: Fixtures) -> DataFrame:
    """Errors at 0, 20 or 40 minutes past the hour, by zone."""
    shift = F.make_dt_interval(mins=F.col(ZONE).cast("int") % 3 * 20)
    return fx.stored_errors.withColumn("target_timestamp", F.col("target_timestamp") + shift)


@query
def rolling_7d_of_stamps(fx):
    return rolling.rolling_7d_of_stamps(_shifted(fx))


@query
def rolling_7d_byzone_of_stamps(fx):
    return rolling.rolling_7d_of_stamps(_shifted(fx), ZONE)


@query
def compare_versions(fx):
    return comparison.compare_versions(fx.errors, MODEL, "naive_24")


def _last_week(fx: Fixtures) -> DataFrame:
    """Errors of the seven days that end with the hour: predictions of these days meet actuals of these days."""
    first, last = (HOUR - timedelta(days=6)).date(), HOUR.date()
    return monitoring.prediction_errors(
        fx.predictions.filter(F.to_date("target_timestamp").between(first, last)), fx.hourly.filter(F.to_date("hour").between(first, last)))


@query
def rolling_7d_at(fx):
    return rolling.rolling_7d_at(_last_week(fx), HOUR, MODEL)


@query
def rolling_7d_byzone_at(fx):
    return rolling.rolling_7d_by_zone_at(_last_week(fx), HOUR, MODEL)


@query
def latest_rolling_7d(fx):
    return monitoring.latest_rolling(rolling.rolling_7d(fx.errors))


@query
def freshness(fx):
    return monitoring.freshness(fx.hourly, fx.predictions)


@query
def missing_predictions(fx):
    return monitoring.missing_predictions(fx.hourly, fx.predictions)


# --- evaluation and importance -----------------------------------------------------------

@query
def eval_overall(fx):
    return evaluation.evaluate_overall(fx.test_cells)


@query
def eval_overall_epsilon(fx):
    return evaluation.evaluate_overall(fx.test_cells, "epsilon", 0.5)


@query
def eval_per_zone(fx):
    return evaluation.evaluate_per_zone(fx.test_cells)


@query
def top_bottom_zones(fx):
    return evaluation.top_bottom_zones(present(evaluation.evaluate_per_zone(fx.test_cells)))


@query
def importance_by_feature(fx):
    return importance.importance_by_feature(fx.importance)


@query
def importance_by_lag(fx):
    return importance.importance_by(importance.importance_by_feature(fx.importance), "lag")


@query
def importance_by_zone(fx):
    return importance.importance_by(importance.importance_by_feature(fx.importance), "zone")


@query
def importance_by_type(fx):
    return importance.importance_by_type(importance.importance_by_feature(fx.importance))


# --- merges and the cycle ----------------------------------------------------------------

@query
def merge_prediction_error(fx):
    """The errors before the hour, with those of the hour inserted."""
    made = fx.stored_predictions
    stored = monitoring.prediction_errors(before(made, "target_timestamp", HOUR), before(fx.hourly, "hour", HOUR))
    return merge.merge_errors(stored, made, actuals.as_actuals(fx.hourly), HOUR, MODEL)


@query
def merge_metrics_by_hour(fx):
    stored = monitoring.metrics_by_hour(before(fx.stored_errors, "target_timestamp", HOUR))
    return merge.merge_hour_metrics(stored, fx.stored_errors, HOUR, MODEL)


@query
def merge_metrics_by_day(fx):
    stale = monitoring.metrics_by_day(before(fx.stored_errors, "target_timestamp", HOUR))
    return merge.merge_day_metrics(stale, fx.stored_errors, HOUR, MODEL)


@query
def merge_rolling_7d(fx):
    stale = rolling.rolling_7d(before(fx.stored_errors, "target_timestamp", LAST_DAY), reread=True).withColumn(
        "num_predictions", F.lit(0).cast("bigint"))
    return merge.merge_rolling(stale, fx.stored_errors, HOUR, MODEL)


@query
def merge_rolling_7d_byzone(fx):
    stale = rolling.rolling_7d_by_zone(before(fx.stored_errors, "target_timestamp", LAST_DAY), reread=True).withColumn(
        "num_predictions", F.lit(0).cast("bigint"))
    return merge.merge_rolling_by_zone(stale, fx.stored_errors, HOUR, MODEL)


def _stored_until(fx: Fixtures, stamp: datetime) -> Warehouse:
    warehouse = Warehouse(fx.spark, shared_folder(fx.spark, "warehouse"))
    warehouse.replace("predictions", fx.predictions)
    warehouse.replace("actuals", before(actuals.as_actuals(fx.hourly), "hour", stamp))
    cycle.rebuild(warehouse)
    return warehouse


@query
def hourly_cycle(fx):
    """Rolling rows after the last day was applied to tables rebuilt from the days before."""
    warehouse = _stored_until(fx, LAST_DAY)
    cycle.apply_actuals(warehouse, fx.hourly.filter(F.col("hour") >= instant(LAST_DAY)))
    return warehouse.read("rolling_7d")


@query
def stream_hourly_demand(fx):
    folder = shared_folder(fx.spark, "demand")
    # Several files, in no order of time, one a batch.
    arriving = shared_folder(fx.spark, "arriving")
    (fx.spark.read.schema(LAYOUTS["events"]).parquet(fx.path("events"))
     .repartitionByRange(4, F.col("ts").desc()).write.parquet(arriving))
    source = fx.spark.readStream.schema(LAYOUTS["events"]).option("maxFilesPerTrigger", 1).parquet(arriving)
    trips = source.select(
        F.col("ts").alias("request_datetime"), F.col("user_id").cast("int").alias(ZONE))
    run_demand_stream(hourly_demand_stream(trips), folder, shared_folder(fx.spark, "demand-checkpoint"))
    return read_demand_stream(fx.spark, folder)


def _streamed(fx: Fixtures) -> Warehouse:
    """The tables after the whole month of actuals arrived, the zones of every hour cut over several files and batches."""
    warehouse = Warehouse(fx.spark, shared_folder(fx.spark, "warehouse"))
    warehouse.replace("predictions", fx.predictions)
    arrivals = shared_folder(fx.spark, "arrivals")
    part = (F.col(ZONE) % 2 + 2 * F.floor(F.dayofmonth("hour") / 10)).cast("int")
    cells = fx.hourly.select("hour", ZONE, F.col("demand").cast("double").alias("demand"), part.alias("part"))
    checkpoint, batch = shared_folder(fx.spark, "cycle-checkpoint"), 3
    # Three parts are a batch, of as many files as they have: a run of its own, restarted from the checkpoint.
    for first in range(0, 8, batch):
        some = cells.filter(F.col("part").between(first, first + batch - 1))
        some.hint("rebalance", "part").write.mode("append").partitionBy("part").parquet(arrivals)
        source = fx.spark.readStream.schema(cells.schema).parquet(arrivals)
        run_cycle_stream(source, warehouse, checkpoint)
    return warehouse


@query
def stream_hourly_cycle(fx):
    return _streamed(fx).read("metrics_by_day")


@query
def stream_cycle_hours(fx):
    return _streamed(fx).read("metrics_by_hour")


def _arrivals(fx: Fixtures, *parts: DataFrame) -> DataFrame:
    """Events that arrive part after part, as a stream with a part in each batch."""
    folder, files = shared_folder(fx.spark, "arriving"), 2
    for part in parts:
        part.repartition(files).write.mode("append").parquet(folder)
    source = fx.spark.readStream.schema(LAYOUTS["events"]).option("maxFilesPerTrigger", files).parquet(folder)
    return event_time.timed_trips(source.select(F.col("ts").alias("request_datetime"), F.col("user_id").cast("int").alias(ZONE)))


def _days_of(events: DataFrame, first: int, last: int) -> DataFrame:
    return events.filter(F.dayofmonth("ts").between(first, last))


@query
def stream_closed_hours(fx):
    """Hours the watermark has passed, from Spark's window aggregate."""
    events, folder = fx.table("events"), shared_folder(fx.spark, "closed-hours")
    trips = _arrivals(fx, _days_of(events, 1, 10), _days_of(events, 11, 20), _days_of(events, 21, 31))
    event_time.run_to_table(event_time.closed_hours(trips), folder, shared_folder(fx.spark, "closed-hours-checkpoint"))
    return fx.spark.read.schema(f"hour timestamp, {ZONE} int, demand bigint").parquet(folder)


@query
def stream_late_trips(fx):
    """Every tenth trip of the first five days arrives with the last part: closed hours without them, and the late ones."""
    events, folder = fx.table("events"), shared_folder(fx.spark, "late-trips")
    late = (F.col("event_id") % 10 == 0) & (F.dayofmonth("ts") <= 5)
    trips = _arrivals(fx, _days_of(events, 1, 10).filter(~late), _days_of(events, 11, 20), _days_of(events, 21, 31).union(events.filter(late)))
    event_time.run_to_table(event_time.hours_and_late_trips(trips), folder, shared_folder(fx.spark, "late-trips-checkpoint"))
    stored = fx.spark.read.schema(f"kind string, hour timestamp, {ZONE} int, demand bigint").parquet(folder)
    return stored.groupBy("kind", "hour", ZONE).agg(F.sum("demand").alias("demand"))


def _rolled(fx: Fixtures) -> str:
    """The folder of a stream of all errors. Some of days 8 to 12 come a part late, in time for their windows, and some of
    the first three days come last, behind all lateness."""
    errors, day = fx.stored_errors, F.dayofmonth("target_timestamp")
    zone = F.col(ZONE).cast("int") % 10
    late = (zone == 0) & day.between(8, 12)
    too_late = (zone == 1) & (day <= 3)
    part = F.when(too_late, 3).when(late | day.between(13, 18), 1).when(day <= 12, 0).otherwise(2)
    folder, parts = shared_folder(fx.spark, "errors-arriving"), 4
    out, checkpoint = shared_folder(fx.spark, "rolling-rows"), shared_folder(fx.spark, "rolling-checkpoint")
    for number in range(parts):  # each part is a run of its own, of as many files as it has, restarted from the checkpoint
        errors.filter(part == number).write.mode("append").parquet(folder)
        source = fx.spark.readStream.schema(errors.schema).parquet(folder)
        event_time.run_to_table(rolling_state.rolling_rows(source), out, checkpoint)
    return out


@query
def stream_rolling_7d(fx):
    return rolling_state.rolling_of_stream(fx.spark, _rolled(fx))


@query
def stream_rolling_7d_byzone(fx):
    return rolling_state.rolling_by_zone_of_stream(fx.spark, _rolled(fx))


@query
def stream_late_errors(fx):
    return rolling_state.late_errors(fx.spark, _rolled(fx))


@query
def prediction_error_bucketed(fx):
    """The error table from two tables that were dealt into the same buckets when they were loaded."""
    database = f"bucketed_{uuid.uuid4().hex}"
    fx.spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(fx.spark, 'database')}'")
    # Every model predicts the cells of the panel, zones times hours at most.
    size = fx.hourly.agg(F.count_distinct(ZONE).alias("zones"), (F.max(F.unix_seconds("hour")) - F.min(F.unix_seconds("hour"))).alias("span")).first()
    number = buckets.buckets_for(size["zones"] * (1 + (size["span"] or 0) // 3600) * len(MODELS))
    buckets.load_predictions(fx.predictions, f"{database}.predictions", number)
    buckets.load_actuals(fx.hourly, f"{database}.actuals", number)
    return buckets.bucketed_errors(fx.spark, f"{database}.predictions", f"{database}.actuals")


# --- files, views and reports read back --------------------------------------------------

@query
def monthly_trips(fx):
    """Trips written as the raw file of their month, read by month and counted."""
    folder = shared_folder(fx.spark, "raw")
    fx.trips.write.parquet(files.raw_path(folder, MONTH))
    return hourly_demand(files.read_trips(fx.spark, folder, MONTH, MONTH), MONTH, MONTH)


@query
def zone_lookup_csv(fx):
    folder = shared_folder(fx.spark, "lookup")
    files.write_report(fx.zone_lookup.withColumn("Zone", F.lit("not read")), folder)
    return files.read_zone_lookup(fx.spark, folder)


@query
def processed_months(fx):
    """Days of orders as monthly files; a range of months is read, in the layout of hourly demand."""
    folder = shared_folder(fx.spark, "processed")
    files.write_months(fx.order_days, folder)
    return files.read_months(fx.spark, folder, "1996-02", "1997-01")


@query
def sql_file(fx):
    """Errors of one hour and model by a SQL file with typed parameters."""
    path = shared_folder(fx.spark, "sql")
    text = ("SELECT target_timestamp, PULocationID, absolute_error FROM stored_errors\n"
            "WHERE target_timestamp = :target_timestamp AND model_version = :model_version")
    fx.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    fx.monitored.read("errors").createOrReplaceTempView("stored_errors")
    return sqlfiles.run_sql_file(fx.spark, path, HOUR, MODEL)


SCRIPT = """BEGIN
  DECLARE newest TIMESTAMP;
  SET newest = (SELECT max(target_timestamp) FROM stored_errors WHERE model_version = :model_version);
  DROP TABLE IF EXISTS IDENTIFIER(:table);
  CREATE TABLE IDENTIFIER(:table) USING parquet AS
    SELECT model_version, to_date(target_timestamp) AS target_date, count(*) AS num_predictions, avg(absolute_error) AS mae,
           sqrt(avg(squared_error)) AS rmse, avg(try_divide(absolute_error, nullif(actual_demand, 0D))) AS mape_excluding_zero_actuals
    FROM stored_errors WHERE model_version = :model_version AND target_timestamp < date_trunc('day', newest) GROUP BY ALL;
  IF newest >= :since THEN
    INSERT INTO IDENTIFIER(:table)
    SELECT model_version, to_date(target_timestamp), count(*), avg(absolute_error),
           sqrt(avg(squared_error)), avg(try_divide(absolute_error, nullif(actual_demand, 0D)))
    FROM stored_errors WHERE model_version = :model_version AND target_timestamp >= date_trunc('day', newest) GROUP BY ALL;
  END IF;
  SELECT * FROM IDENTIFIER(:table);
END"""


@query
def sql_script(fx):
    """Day metrics of a model, filled into a table by a file of several statements, the newest day last."""
    path, database = shared_folder(fx.spark, "script"), f"scripts_{uuid.uuid4().hex}"
    fx.spark.createDataFrame([(SCRIPT,)], "value string").coalesce(1).write.text(path)
    fx.spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(fx.spark, 'database')}'")
    fx.monitored.read("errors").createOrReplaceTempView("stored_errors")
    return sqlfiles.run_sql_script(fx.spark, path, model_version=MODEL, since=HOUR, table=f"{database}.day_metrics")


def _view(fx: Fixtures, name: str) -> DataFrame:
    fx.monitored.replace("rolling_7d", rolling.rolling_7d(fx.monitored.read("errors")))
    cycle.create_views(fx.monitored)
    return fx.spark.table(name)


@query
def view_overall(fx):
    return _view(fx, "vw_overall_metrics")


@query
def view_by_zone(fx):
    return _view(fx, "vw_prediction_metrics_groupby_zone")


@query
def view_latest_rolling(fx):
    return _view(fx, "vw_latest_prediction_metrics_rolling_7d")


def _reread(report: DataFrame, order: str) -> DataFrame:
    """A report written in descending order of a column, and read back."""
    folder = shared_folder(report.sparkSession, "report")
    files.write_report(report.orderBy(F.desc(order)), folder)
    return files.read_csv(report.sparkSession, folder, report.schema)


@query
def importance_report(fx):
    return _reread(importance.importance_by_feature(fx.importance), "importance")


@query
def per_zone_report(fx):
    return _reread(evaluation.evaluate_per_zone(fx.test_cells), "zone")


# --- models ------------------------------------------------------------------------------

BOOSTING = BoostingConfig()


def _trained(fx: Fixtures, config: BoostingConfig = BOOSTING) -> train.TrainingRun:
    split = panel.split_by_day(fx.nation_panel, {
        "train": ("2024-01-01", "2024-01-26"), "test": ("2024-01-26", "2024-01-31")})
    return train.train(split, config)


@query
def gbt_eval(fx):
    return evaluation.evaluate_per_zone(_trained(fx).cells)


@query
def gbt_importance(fx):
    return importance.importance_by_feature(_trained(fx).models.importance(fx.spark))


@query
def gbt_full_window_eval(fx):
    """Trees over all of the last 24 hours of every zone, and their calendars."""
    return evaluation.evaluate_per_zone(_trained(fx, BoostingConfig(mode="full")).cells)

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import hour
from zonecast.operators import merge, monitoring, rolling
from zonecast.schemas import ACTUALS, PREDICTIONS

KV = "k string, m string, v int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_insert_only_keeps_stored_rows_and_inserts_null_keys(spark):
    target = spark.createDataFrame([("a", "m", 1), (None, "m", 2)], KV)
    source = spark.createDataFrame([("a", "m", 9), ("b", "m", 3), (None, "m", 4), ("c", "m", 5), ("c", "m", 6)], KV)
    once = merge.insert_only(target, source, ("k", "m"))
    assert rows(once) == sorted(
        [("a", "m", 1), (None, "m", 2), ("b", "m", 3), (None, "m", 4), ("c", "m", 5), ("c", "m", 6)], key=str)
    known = source.filter("k is not null")
    assert rows(merge.insert_only(once, known, ("k", "m"))) == rows(once)


def test_upsert_replaces_and_is_idempotent(spark):
    target = spark.createDataFrame([("a", "m", 1), ("b", "m", 2)], KV)
    source = spark.createDataFrame([("a", "m", 9), ("c", "m", 3)], KV)
    once = merge.upsert(target, source, ("k", "m"))
    assert rows(once) == [("a", "m", 9), ("b", "m", 2), ("c", "m", 3)]
    assert rows(merge.upsert(once, source, ("k", "m"))) == rows(once)


def test_upsert_rejects_repeated_source_keys(spark):
    target = spark.createDataFrame([("a", "m", 1)], KV)
    source = spark.createDataFrame([("a", "m", 9), ("a", "m", 3)], KV)
    with pytest.raises(PySparkException, match="several source rows"):
        merge.upsert(target, source, ("k", "m")).collect()


def test_second_forecast_and_late_actuals_change_nothing(spark):
    actuals = spark.createDataFrame([(hour(5), "1", 4.0)], ACTUALS)
    first = spark.createDataFrame([(hour(4), hour(5), "1", 3.0, "m")], PREDICTIONS)
    empty = merge.error_changes(first, actuals, hour(6), "m")
    stored = merge.merge_errors(empty, first, actuals, hour(5), "m")
    assert stored.first().absolute_error == 1.0
    again = first.withColumn("forecast_run_timestamp", F.lit(hour(3)))
    assert rows(merge.merge_errors(stored, again, actuals, hour(5), "m")) == rows(stored)
    corrected = actuals.withColumn("demand", F.lit(9.0))
    assert rows(merge.merge_errors(stored, first, corrected, hour(5), "m")) == rows(stored)
    assert merge.merge_errors(empty, first, actuals, hour(5), "other").count() == 0


def test_day_merge_recomputes_the_day_of_one_model(errors):
    table = errors([(h, "1", 1, h % 3, m) for h in range(48) for m in ("a", "b")])
    stale = monitoring.metrics_by_day(table.filter(F.col("target_timestamp") < F.lit(hour(40))))
    got = {(r.model_version, r.target_date.day): r.num_predictions
           for r in merge.merge_day_metrics(stale, table, hour(47), "a").collect()}
    assert got == {("a", 4): 24, ("b", 4): 24, ("a", 5): 24, ("b", 5): 16}


def test_rolling_merged_every_evening_equals_bulk(errors):
    table = errors([(h, z, 1 + h % 2, h % 5, "m") for h in range(24 * 9) for z in ("1", "2")])
    bulk = rolling.rolling_7d_by_zone(table)
    merged = bulk.limit(0)
    for day in range(7, 10):
        merged = merge.merge_rolling_by_zone(merged, table, hour(24 * day - 1), "m")
    close = [F.round(c, 9).alias(c) if c in ("mae", "rmse", "mape_excluding_zero_actuals") else c for c in bulk.columns]
    assert rows(merged.select(*close)) == rows(bulk.select(*close))
    as_set = rolling.rolling_7d_by_zone(table, table.filter(F.hour("target_timestamp") == 23).select(
        F.to_date("target_timestamp").alias("day")).distinct())
    assert as_set.count() == 18 and as_set.filter(
        F.col("metric_date") == datetime(2024, 3, 4).date()).first().num_predictions == 24


def test_hour_merge_is_insert_only(errors):
    table = errors([(1, "1", 1, 3, "m")])
    stored = merge.merge_hour_metrics(monitoring.metrics_by_hour(table).limit(0), table, hour(1), "m")
    assert stored.first().mae == 2.0
    more = table.union(errors([(1, "2", 1, 9, "m")]))
    assert rows(merge.merge_hour_metrics(stored, more, hour(1), "m")) == rows(stored)
    assert timedelta(hours=1) == hour(1) - hour(0)

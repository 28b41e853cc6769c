import random
from collections import Counter
from datetime import datetime

import pytest

from tests.conftest import explained
from zonecast.functions.months import month_end, month_list, month_start, months_between
from zonecast.operators.demand import borough_zones, hourly_demand
from zonecast.plans import prepare
from zonecast.config import DataConfig
from zonecast.sources import files

TRIPS = "hvfhs_license_num string, request_datetime timestamp_ntz, PULocationID int"


def trips(spark, rows):
    return spark.createDataFrame(rows, TRIPS)


def counts(df):
    return {(r.hour, r.PULocationID): r.demand for r in df.collect()}


def test_month_labels():
    assert month_start("2024-07") == datetime(2024, 7, 1)
    assert month_end("2024-12") == datetime(2025, 1, 1)
    assert months_between("2024-11", "2025-02") == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert months_between("2024-02", "2024-01") == []


def test_month_list_fills_months_without_rows(spark):
    df = spark.createDataFrame([(datetime(2023, 11, 30),), (datetime(2024, 2, 1),)], "at timestamp")
    assert [r[0] for r in month_list(df, "at").orderBy("year_month").collect()] == [
        "2023-11", "2023-12", "2024-01", "2024-02"]


def test_month_edges_and_nulls(spark):
    df = trips(spark, [
        ("a", datetime(2024, 12, 1), 1), ("a", datetime(2024, 12, 31, 23, 59, 59, 999999), 1),
        ("a", datetime(2025, 1, 1), 1), ("a", datetime(2024, 11, 30, 23, 59), 1),
        ("a", None, 1), ("a", datetime(2024, 12, 5), None), (None, datetime(2024, 12, 5, 1), 1)])
    assert counts(hourly_demand(df, "2024-12", "2024-12")) == {
        (datetime(2024, 12, 1), 1): 1, (datetime(2024, 12, 31, 23), 1): 1, (datetime(2024, 12, 5, 1), 1): 1}


def test_license_and_zone_filters(spark):
    df = trips(spark, [
        ("x", datetime(2024, 1, 1, 0, 10), 1), ("x", datetime(2024, 1, 1, 0, 50), 1),
        ("y", datetime(2024, 1, 1, 0, 50), 1), (None, datetime(2024, 1, 1, 0, 50), 1),
        ("x", datetime(2024, 1, 1, 0, 50), 2)])
    lookup = spark.createDataFrame([(1, "North"), (1, "North"), (2, "north")], "LocationID int, Borough string")
    zones = borough_zones(lookup, "North")
    assert [r[0] for r in zones.collect()] == [1]
    assert counts(hourly_demand(df, "2024-01", "2024-01", zones, "x")) == {(datetime(2024, 1, 1), 1): 2}


def test_a_zone_with_a_third_of_all_trips(spark):
    rng = random.Random(5)
    rows = [("x", datetime(2024, 1, 1 + rng.randrange(3), rng.randrange(24), rng.randrange(60)),
             7 if rng.random() < 0.34 else rng.randrange(40)) for _ in range(3000)]
    expected = Counter((at.replace(minute=0), zone) for _, at, zone in rows)
    counted = hourly_demand(trips(spark, rows), "2024-01", "2024-01")
    plan = explained(counted)
    assert counts(counted) == expected
    # Rows are counted before they are shuffled.
    assert plan.index("partial_count") < plan.index("hashpartitioning")
    assert plan.count("hashpartitioning") == 1


def test_small_zone_lists_filter_before_the_count(spark, tmp_path):
    df = trips(spark, [("x", datetime(2024, 1, 1), 1)])
    spark.createDataFrame([(1,)], "PULocationID int").write.parquet(f"{tmp_path}/zones")
    zones = spark.read.parquet(f"{tmp_path}/zones")
    plan = hourly_demand(df, "2024-01", "2024-01", zones)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join LeftSemi")


def test_month_bounds_and_columns_reach_the_scan(spark, tmp_path):
    rows = [("x", datetime(2024, 1, 1, 0, 10), 1)]
    trips(spark, rows).write.parquet(f"{tmp_path}/t")
    plan = hourly_demand(spark.read.parquet(f"{tmp_path}/t"), "2024-01", "2024-01")
    text = explained(plan)
    assert "GreaterThanOrEqual(request_datetime" in text and "LessThan(request_datetime" in text
    assert "hvfhs_license_num" not in text.split("ReadSchema")[1]


def test_prepare_writes_one_folder_per_month(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    for ym, day in (("2024-01", datetime(2024, 1, 31, 5)), ("2024-02", datetime(2024, 2, 1, 6))):
        # The second row lies outside of the configured months.
        trips(spark, [("x", day, 7), ("x", datetime(2023, 1, 1), 7)]).write.parquet(files.raw_path(raw, ym))
    lookup = f"{tmp_path}/zones"
    spark.createDataFrame([("7", "q", "North")], "LocationID string, Zone string, Borough string").write.option(
        "header", True).csv(lookup)
    config = DataConfig("2024-01", "2024-02", ("2024-01", "2024-01"), ("2024-02", "2024-02"), borough="North")
    prepare.run(spark, raw, lookup, out, config)
    prepare.run(spark, raw, lookup, out, config)  # a month is replaced, not doubled
    assert files.read_months(spark, out, "2024-01", "2024-02").count() == 2
    only = files.read_months(spark, out, "2024-02", "2024-02")
    assert [(r.hour, r.demand) for r in only.collect()] == [(datetime(2024, 2, 1, 6), 1.0)]
    assert "PartitionFilters: [isnotnull(ym" in explained(only)


def test_monthly_files_need_a_selection(spark, tmp_path):
    with pytest.raises(ValueError):
        files.load_monthly_demand(spark, [])
    paths = files.processed_paths(f"{tmp_path}/", "2024-01", "2024-02")
    assert paths[1] == f"{tmp_path}/hourly_demand_2024-02.parquet"


def test_json_and_config(spark, tmp_path):
    files.save_json(spark, {"a": [1, 2], "b": "x\ny"}, f"{tmp_path}/c")
    assert files.load_json(spark, f"{tmp_path}/c") == {"a": [1, 2], "b": "x\ny"}

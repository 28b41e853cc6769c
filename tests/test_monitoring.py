import random
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import START, explained, hour
from zonecast.operators import evaluation, monitoring, rolling
from zonecast.schemas import ACTUALS, PREDICTIONS
from zonecast.sources import buckets


def predictions(spark, rows):
    return spark.createDataFrame(
        [(hour(h - 1), hour(h), z, float(p), m) for h, z, p, m in rows], PREDICTIONS)


def test_cells_without_actuals_drop_out_and_duplicates_fan_out(spark):
    actuals = spark.createDataFrame([(hour(1), "1", 4.0), (hour(1), "1", 5.0)], ACTUALS)
    got = monitoring.prediction_errors(predictions(spark, [(1, "1", 3, "m"), (2, "1", 3, "m")]), actuals)
    assert sorted((r.actual_demand, r.raw_error, r.absolute_error, r.squared_error) for r in got.collect()) == [
        (4.0, -1.0, 1.0, 1.0), (5.0, -2.0, 2.0, 4.0)]


def test_mape_is_a_fraction_over_non_zero_actuals(errors):
    table = errors([(0, "1", 4, 2, "m"), (0, "2", 0, 3, "m"), (1, "1", 0, 1, "m")])
    by_hour = {r.target_timestamp: r for r in monitoring.metrics_by_hour(table).collect()}
    assert by_hour[hour(0)].mape_excluding_zero_actuals == 0.5 and by_hour[hour(0)].num_zones == 2
    assert by_hour[hour(1)].mape_excluding_zero_actuals is None
    overall = monitoring.metrics_overall(table).first()
    assert (overall.num_predictions, overall.mae, overall.mean_error) == (3, 2.0, pytest.approx(2 / 3))


def test_zone_view_orders_text(errors):
    table = errors([(0, z, 1, 1, "m") for z in ("2", "10")])
    got = monitoring.metrics_by_zone(table).orderBy("PULocationID").collect()
    assert [r.PULocationID for r in got] == ["10", "2"]


def brute_windows(rows, zone=False):
    """Windows by definition, over plain tuples."""
    stamps = {h for h, *_ in rows}
    last = max(stamps)
    out = {}
    for start in (h for h in stamps if h % 24 == 0 and h + 167 <= last):
        for h, z, actual, predicted, model in rows:
            if start <= h <= start + 167:
                out.setdefault((start, model) + ((z,) if zone else ()), []).append((actual, abs(predicted - actual)))
    result = {}
    for key, misses in out.items():
        ratios = [miss / actual for actual, miss in misses if actual]
        result[key] = (len(misses), sum(m for _, m in misses) / len(misses),
                       (sum(m * m for _, m in misses) / len(misses)) ** 0.5,
                       sum(ratios) / len(ratios) if ratios else None)
    return result


def as_windows(df, zone=False):
    return {
        (int((r.window_start_timestamp - START).total_seconds() // 3600), r.model_version)
        + ((r.PULocationID,) if zone else ()):
        (r.num_predictions, r.mae, r.rmse, r.mape_excluding_zero_actuals) for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert a[key][0] == b[key][0]
        assert a[key][1:] == pytest.approx(b[key][1:]), key


def sample_rows():
    import random
    rng = random.Random(7)
    rows = []
    for h in range(24 * 10):
        for z in ("1", "2"):
            if h != 48 and rng.random() < 0.6:  # the midnight of day 2 is missing
                rows.append((h, z, rng.randrange(3), rng.randrange(5), "a"))
    rows += [(h, "1", 0, 2, "early") for h in range(24 * 8)]  # ends earlier, never a ratio
    rows = [r for r in rows if r[0] != 48]
    rows += [(0, "1", 1, 1, "a2"), (239, "2", 4, 1, "a")]
    return rows


@pytest.mark.parametrize("zone", [False, True])
def test_rolling_equals_definition(errors, zone):
    rows = sample_rows()
    build = rolling.rolling_7d_by_zone if zone else rolling.rolling_7d
    got = as_windows(build(errors(rows)), zone)
    close(got, brute_windows(rows, zone))
    assert (48, "a") not in got and any(v[3] is None for v in got.values())


def test_window_is_168_stamps(errors):
    full = [(h, "1", 1, 2, "m") for h in range(168)]
    assert rolling.rolling_7d(errors(full)).first().num_predictions == 168
    assert rolling.rolling_7d(errors(full[:-1])).count() == 0


def test_rolling_at_allows_partial_windows_and_equals_bulk_on_full_ones(errors):
    table = errors([(h, "1", 1, h % 5, "m") for h in range(24 * 9)])
    at = rolling.rolling_7d_at(table, hour(24 * 8 - 1), "m").first()
    bulk = {r.window_end_timestamp: r for r in rolling.rolling_7d(table).collect()}
    assert at == bulk[hour(24 * 8 - 1)]
    partial = rolling.rolling_7d_by_zone_at(table, hour(30), "m").first()
    assert partial.num_predictions == 31 and partial.window_start_timestamp == hour(30 - 167)


def test_stamps_between_hours_fail(spark, errors):
    from datetime import timedelta
    table = errors([(h, "1", 1, 2, "m") for h in range(200)])
    shifted = table.withColumn("target_timestamp", F.col("target_timestamp") + timedelta(minutes=30))
    with pytest.raises(PySparkException, match="whole hour"):
        rolling.rolling_7d(shifted).collect()


def test_rolling_plan_has_no_nested_loop(errors):
    plan = explained(rolling.rolling_7d_by_zone(errors(sample_rows())))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_latest_window_per_model(errors):
    table = errors([(h, "1", 1, 2, m) for h in range(24 * 9) for m in ("a", "b")])
    got = monitoring.latest_rolling(rolling.rolling_7d(table)).collect()
    assert {(r.model_version, r.window_end_timestamp) for r in got} == {("a", hour(215)), ("b", hour(215))}


def test_missing_predictions(spark):
    actuals = spark.createDataFrame([(hour(1), "1", 4.0), (hour(2), "1", 5.0), (hour(3), "1", 5.0)], ACTUALS)
    made = predictions(spark, [(1, "1", 3, "a"), (1, "1", 3, "b"), (2, "1", 3, "a")])
    got = monitoring.missing_predictions(actuals, made).collect()
    assert {(r.target_timestamp, r.model_version) for r in got} == {
        (hour(2), "b"), (hour(3), "a"), (hour(3), "b")}


# --- evaluation ---------------------------------------------------------------------------

CELLS = "zone int, predicted double, actual double"


def test_evaluation_is_percent_and_skips_zero_targets(spark):
    cells = spark.createDataFrame([(1, 3.0, 2.0), (1, 1.0, 0.0), (2, 5.0, 0.0)], CELLS)
    overall = evaluation.evaluate_overall(cells).first()
    assert overall.overall_mape == 50.0 and overall.overall_mae == pytest.approx(7 / 3)
    per_zone = {r.zone: r.mape for r in evaluation.evaluate_per_zone(cells).collect()}
    assert per_zone == {1: 50.0, 2: None}
    eps = evaluation.evaluate_overall(cells, "epsilon", 0.5).first()
    assert eps.overall_mape == pytest.approx((50 + 200 + 1000) / 3)


@pytest.mark.parametrize("mode, epsilon", [("other", 1.0), ("epsilon", 0.0), ("exclude", -1.0)])
def test_evaluation_arguments(spark, mode, epsilon):
    with pytest.raises(ValueError):
        evaluation.percent_error(mode, epsilon)


def test_top_bottom_breaks_ties_by_zone_and_skips_null_mape(spark):
    rows = [(z, float(z % 3), float(z), None if z == 6 else float(10 - z)) for z in range(8)]
    per_zone = spark.createDataFrame(rows, "zone int, mae double, rmse double, mape double")
    lists = {}
    for r in evaluation.top_bottom_zones(per_zone).orderBy("type", "rank").collect():
        lists.setdefault(r.type, []).append(r.zone)
    assert lists["worst_rmse"] == [7, 6, 5, 4, 3] and lists["best_rmse"] == [0, 1, 2, 3, 4]
    assert lists["best_mae"] == [0, 3, 6, 1, 4] and lists["worst_mae"] == [2, 5, 1, 4, 7]
    assert lists["best_mape"] == [7, 5, 4, 3, 2]
    plan = explained(evaluation.top_bottom_zones(per_zone))
    assert "WindowGroupLimit" in plan


def test_unmatched_cells_fail(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 1.0)], "z int, predicted double")
    right = spark.createDataFrame([(1, 1.0), (3, 1.0)], "z int, actual double")
    with pytest.raises(PySparkException, match="differ in their cells"):
        evaluation.cells_from(left, right, ["z"], "z").collect()
    assert evaluation.cells_from(left, left.withColumnRenamed("predicted", "actual"), ["z"], "z").count() == 2


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/bucketed'")
    made = predictions(spark, [(h, str(z), h * z % 5, m) for h in range(50) for z in range(9) for m in "ab"])
    truth = spark.createDataFrame([(hour(h), z, float(h % 3)) for h in range(2, 60) for z in range(0, 9, 2)], "hour timestamp, PULocationID int, demand double")
    buckets.load_predictions(made, "bucketed.predictions", 4)
    early = F.col("hour") < F.lit(hour(30))
    buckets.load_actuals(truth.filter(early), "bucketed.actuals", 4)
    buckets.load_actuals(truth.filter(~early), "bucketed.actuals", 4, mode="append")
    for dense in (False, True):
        got = buckets.bucketed_errors(spark, "bucketed.predictions", "bucketed.actuals", dense)
        assert sorted(got.collect()) == sorted(monitoring.prediction_errors(made, truth).collect())
        assert got.count() == 2 * 48 * 5
        plan = explained(got)
        assert "Exchange" not in plan and "Bucketed: true" in plan
    spark.sql("DROP DATABASE bucketed CASCADE")


def test_buckets_go_with_the_rows():
    assert [buckets.buckets_for(n) for n in (0, 1, 8 * buckets.BUCKET_ROWS)] == [8, 8, 8]
    for rows in (10**7, 123_456_789, 10**10):
        assert buckets.BUCKET_ROWS / 2 <= rows / buckets.buckets_for(rows) <= buckets.BUCKET_ROWS


def test_the_bucketed_query_takes_more_buckets_for_more_rows(spark, monkeypatch):
    from zonecast.registry.queries import QUERIES
    expected = QUERIES["prediction_error_bucketed"](spark, "/root/testdata/sf0.001").count()
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 1 << 10)
    errors = QUERIES["prediction_error_bucketed"](spark, "/root/testdata/sf0.001")  # 15 zones, 720 hours, two models
    plan = explained(errors)
    assert "8 out of 8" not in plan and "32 out of 32" in plan and "Exchange" not in plan
    assert errors.count() == expected


def test_missing_predictions_of_any_stamps_by_a_row_a_day(spark, monkeypatch):
    draw = random.Random(7)
    cells = [(hour(draw.randrange(0, 72)) + timedelta(minutes=draw.choice([0, 0, 20])), draw.choice([1, 2, None])) for _ in range(150)]
    made = [(stamp, None if zone is None else str(zone), model) for stamp, zone in cells for model in "ab" if draw.random() < 0.7]
    made += [(hour(h), "1", "c") for h in range(72)] + [(hour(3), "1", None), (None, "1", "a")]
    actuals = spark.createDataFrame([(s, z, 1) for s, z in cells] + [(cells[0][0], cells[0][1], 2), (None, 1, 3)], "hour timestamp, PULocationID int, demand long")
    kept = []
    monkeypatch.setattr(monitoring, "stored", lambda df, purpose: kept.append(df) or df, raising=False)
    got = monitoring.missing_predictions(actuals, spark.createDataFrame(made, "target_timestamp timestamp, PULocationID string, model_version string"))
    known = {(s, z, m) for s, z, m in made if s is not None and z is not None and m is not None}
    want = sorted(str((r.hour, r.PULocationID, r.demand, m)) for r in actuals.collect() for m in "abc" if (r.hour, str(r.PULocationID), m) not in known)
    assert sorted(str((r.target_timestamp, None if r.PULocationID is None else int(r.PULocationID), r.demand, r.model_version)) for r in got.collect()) == want
    assert kept[0].filter("model_version = 'c'").count() == 3  # a row for each day, not one for each hour

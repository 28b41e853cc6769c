"""Event-time streams, scalers by months, windows over any stamps, version comparison, SQL scripts."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import explained, hour
from zonecast.operators import comparison, rolling, scaling
from zonecast.operators.panel import full_panel
from zonecast.schemas import ZONE
from zonecast.sources.sqlfiles import run_sql_script
from zonecast.streaming import event_time, rolling_state

TRIPS = "hvfhs_license_num string, request_datetime timestamp, PULocationID int"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, TRIPS).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return event_time.timed_trips(spark.readStream.schema(TRIPS).option("maxFilesPerTrigger", 1).parquet(folder))


def trip(h, minute=10, zone=1):
    return ("x", hour(h) + timedelta(minutes=minute), zone)


def stored(spark, folder):
    return Counter({(r.kind, r.hour, r.PULocationID): r.demand for r in
                    spark.read.parquet(folder).groupBy("kind", "hour", ZONE).agg(F.sum("demand").alias("demand")).collect()})


def test_late_trips_stand_beside_closed_hours_also_after_a_restart(spark, tmp_path):
    folder, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    arrive(spark, folder, [trip(0), trip(0), trip(1, zone=2), trip(2)])
    arrive(spark, folder, [trip(5), ("x", None, 1), ("x", hour(5), None)])
    event_time.run_to_table(event_time.hours_and_late_trips(source(spark, folder), "30 minutes"), out, checkpoint)
    first = {("closed", hour(0), 1): 2, ("closed", hour(1), 2): 1, ("closed", hour(2), 1): 1}
    assert stored(spark, out) == first
    # After a restart: an hour that is over, an open one, one never seen, and a jump that closes all before it.
    arrive(spark, folder, [trip(0, zone=1), trip(0, zone=3), trip(5), trip(4, 30)])
    arrive(spark, folder, [trip(9)])
    query = event_time.run_to_table(event_time.hours_and_late_trips(source(spark, folder), "30 minutes"), out, checkpoint)
    assert stored(spark, out) == first | {
        ("late", hour(0), 1): 1, ("late", hour(0), 3): 1, ("closed", hour(5), 1): 2, ("closed", hour(4), 1): 1}
    dropped = [o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators]
    assert sum(dropped) <= len(dropped)  # at most rows without a cell
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 2  # the open hour


def test_a_late_trip_leaves_the_count_of_its_hour_and_groups_are_few(spark, tmp_path):
    folder = f"{tmp_path}/in"
    # The second part closes hour 0 and brings a trip of it; the third closes what is left. Many zones share the slots.
    arrive(spark, folder, [trip(0), trip(0), *[trip(2, zone=z) for z in range(2, 900)]])
    arrive(spark, folder, [trip(0), trip(3)])
    arrive(spark, folder, [("x", hour(9), 1)])
    query = event_time.run_to_table(event_time.hours_and_late_trips(source(spark, folder), "30 minutes"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    want = {("closed", hour(0), 1): 2, ("late", hour(0), 1): 1, ("closed", hour(3), 1): 1}
    assert stored(spark, f"{tmp_path}/out") == want | {("closed", hour(2), z): 1 for z in range(2, 900)}
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= event_time.SLOTS


def test_an_hour_is_over_when_the_watermark_is_at_its_end(spark, tmp_path):
    folder = f"{tmp_path}/in"
    arrive(spark, folder, [trip(0), ("x", hour(2), 5)])  # the watermark ends at one o'clock
    event_time.run_to_table(event_time.hours_and_late_trips(source(spark, folder)), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert stored(spark, f"{tmp_path}/out") == {("closed", hour(0), 1): 1}


def test_closed_hours_restart_from_the_checkpoint(spark, tmp_path):
    folder, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    for part in ([trip(0), trip(0)], [trip(3)], [trip(0), trip(6)]):  # the third trip of hour 0 is too late
        arrive(spark, folder, part)
        event_time.run_to_table(event_time.closed_hours(source(spark, folder)), out, checkpoint)
    assert sorted((r.hour, r.demand) for r in spark.read.parquet(out).collect()) == [(hour(0), 2), (hour(3), 1)]


def test_stream_filters(spark):
    trips = spark.createDataFrame([("x", hour(0), 1), ("y", hour(0), 1), ("x", hour(0), 2)], TRIPS)
    zones = spark.createDataFrame([(1,)], f"{ZONE} int")
    assert event_time.timed_trips(trips, zones, "x").count() == 1


# --- scalers by months -------------------------------------------------------------------

def test_scaler_of_months_equals_scaler_of_the_panel(spark, demand, tmp_path):
    draw = random.Random(1)
    rows = [(h, z, draw.randrange(1, 9)) for h in range(24 * 70) for z in (1, 2) if draw.random() < 0.4]
    rows += [(h, 3, 5) for h in range(1500, 1520)] + [(h, 4, 6) for h in range(24 * 70)] + [(0, 5, 0)]
    cells = demand(rows + [(0, 9, 1), (24 * 70 - 1, 9, 1)])
    for month in ("2024-03", "2024-04", "2024-05"):
        scaling.add_months(cells.filter(F.date_format("hour", "yyyy-MM") == month), f"{tmp_path}/moments")
    scaling.add_months(cells.filter(F.date_format("hour", "yyyy-MM") == "2024-04"), f"{tmp_path}/moments")  # a month again changes nothing
    got = {r.PULocationID: (r.mean, r.scale) for r in scaling.merged_scaler(scaling.read_moments(spark, f"{tmp_path}/moments")).collect()}
    want = {r.PULocationID: (r.mean, r.scale) for r in scaling.fit_scaler(full_panel(cells)).collect()}
    assert set(got) == set(want) == {1, 2, 3, 4, 5, 9}
    for zone, values in want.items():
        assert got[zone] == pytest.approx(values, rel=1e-12)
    assert got[4][1] == got[5][1] == 1.0


# --- windows over any stamps -------------------------------------------------------------

def test_windows_of_any_stamps_equal_comparison_of_all(spark, errors):
    draw = random.Random(2)
    rows = [(draw.randrange(0, 24 * 12 * 60) / 60, draw.choice("12"), draw.randrange(0, 4), draw.randrange(0, 9), draw.choice("ab")) for _ in range(600)]
    frame = errors(rows)
    stamps = [hour(0) + timedelta(hours=h) for h, *_ in rows]
    ends = [(stamps[k], stamps[k] + timedelta(minutes=draw.choice([0, 1, 59, 60, 61, 600, 1440, 2000, 10020]))) for k in range(60)]
    ends += [(hour(24), hour(48)), (hour(25), hour(71)), (hour(24), hour(24)), (hour(0), hour(300))]
    windows = spark.createDataFrame(sorted(set(ends)), "start timestamp, end timestamp")
    got = {(r.start, r.end, r.model_version): (r.n, r.sum_abs, r.n_ratio) for r in rolling.window_sums(frame, windows, "model_version").collect()}
    want = {}
    for s, e in set(ends):
        for model in "ab":
            own = [(a, p) for (h, _, a, p, m), t in zip(rows, stamps) if m == model and s <= t <= e]
            if own:
                want[s, e, model] = (len(own), sum(abs(p - a) for a, p in own), sum(a != 0 for a, _ in own))
    assert got == want
    plan = explained(rolling.window_sums(frame, windows, "model_version"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_windows_of_stamps_are_added_up_in_tasks_of_bounded_size(errors, monkeypatch):
    draw = random.Random(6)
    frame = errors([(h + draw.choice([0, 0.25]), str(z), draw.randrange(4), draw.randrange(9), "a") for h in range(24 * 9) for z in range(40)])
    want = sorted(map(tuple, rolling.rolling_7d_of_stamps(frame, ZONE).collect()))
    monkeypatch.setattr(rolling, "TASK_ROWS", 500, raising=False)
    got = rolling.rolling_7d_of_stamps(frame, ZONE)
    assert int(explained(got).split("hashpartitioning(model_version")[1].split(")")[0].split(",")[-1]) >= 20
    assert "Broadcast" in explained(got)
    monkeypatch.setattr(rolling, "MOST_PIECES", 0, raising=False)
    for again in (got, rolling.rolling_7d_of_stamps(frame, ZONE)):
        for a, b in zip(sorted(map(tuple, again.collect())), want, strict=True):
            assert a[:-3] == b[:-3] and a[-3:] == pytest.approx(b[-3:])


def test_windows_by_zone_are_added_up_where_the_daily_sums_of_a_zone_are(errors, monkeypatch):
    frame = errors([(h, str(z), 1, z % 3, "a") for h in range(24 * 9) for z in range(20)])
    want = sorted(map(tuple, rolling.rolling_7d_by_zone(frame).collect()))
    monkeypatch.setattr(rolling, "TASK_ROWS", 100, raising=False)
    got = rolling.rolling_7d_by_zone(frame)
    # One exchange, by key and into 20 * 9 * 7 / 100 tasks; none of the windows.
    assert "hashpartitioning(model_version" in explained(got) and "hashpartitioning(start" not in explained(got)
    assert ", 13), REPARTITION_BY_NUM" in explained(got)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 0


def test_stamp_windows_equal_hourly_ones_on_whole_hours(errors):
    draw = random.Random(3)
    frame = errors([(h, z, draw.randrange(4), draw.randrange(9), m) for h in range(24 * 10) for z in "12" for m in "ab"])
    for keys, hourly in (((), rolling.rolling_7d), ((ZONE,), rolling.rolling_7d_by_zone)):
        got = sorted(map(tuple, rolling.rolling_7d_of_stamps(frame, *keys).collect()))
        want = sorted(map(tuple, hourly(frame).select(*rolling.rolling_7d_of_stamps(frame, *keys).columns).collect()))
        assert len(got) == len(want) > 0
        for a, b in zip(got, want):
            assert a[:-3] == b[:-3] and a[-3:] == pytest.approx(b[-3:])


# --- versions and scripts ----------------------------------------------------------------

def test_versions_are_compared_on_common_cells(errors):
    draw = np.random.default_rng(4)
    rows = [(h, "1", 10, 10 + float(draw.normal(0, 1)), "good") for h in range(24 * 20)]
    rows += [(h, "1", 10, 13 + float(draw.normal(0, 1)), "bad") for h in range(24 * 25)]  # five days more
    rows += [(h, "2", 10, 99, "other") for h in range(24)]
    frame = errors(rows)
    row = {r.metric: r for r in comparison.compare_versions(frame, "good", "bad").collect()}
    good, bad = [abs(p - 10) for _, _, _, p, m in rows if m == "good"], [abs(p - 10) for h, _, _, p, m in rows if m == "bad" and h < 480]
    assert row["mae"].n_cells == 480 and row["mae"].n_days == 20
    assert (row["mae"].mean_one, row["mae"].mean_two) == pytest.approx((np.mean(good), np.mean(bad)))
    assert row["mae"].lower < row["mae"].difference < row["mae"].upper < 0
    for again in comparison.compare_versions(frame.repartition(7), "good", "bad").collect():
        assert again[1:] == pytest.approx(row[again.metric][1:])
    assert comparison.compare_versions(frame, "good", "nobody").count() == 0
    same = errors([(h, "1", 10, 11, m) for h in range(48) for m in ("x", "y")])
    assert {(r.difference, r.lower, r.upper) for r in comparison.compare_versions(same, "x", "y").collect()} == {(0.0, 0.0, 0.0)}


def test_poisson_weights(spark):
    weights = [r.w for r in spark.range(20000).select(comparison.poisson_weight(F.lit(date(2024, 1, 1)), F.col("id"), 1).alias("w")).collect()]
    assert np.mean(weights) == pytest.approx(1, abs=0.03) and np.var(weights) == pytest.approx(1, abs=0.05)


def test_script_of_several_statements(spark, tmp_path, errors):
    errors([(1, "1", 1, 3, "m"), (2, "1", 1, 3, "m"), (3, "2", 1, 3, "n")]).createOrReplaceTempView("script_errors")
    path = tmp_path / "s.sql"
    path.write_text("""BEGIN
      DECLARE seen BIGINT;
      SET seen = (SELECT count(*) FROM script_errors WHERE model_version = :model);
      IF seen > :least THEN SELECT seen AS n, :stamp AS stamp; ELSE SELECT -1 AS n, :stamp AS stamp; END IF;
    END""")
    assert run_sql_script(spark, str(path), model="m", least=1, stamp=datetime(2024, 1, 1)).first()[:] == (2, datetime(2024, 1, 1))
    assert run_sql_script(spark, str(path), model="x'; DROP", least=1, stamp=datetime(2024, 1, 1)).first().n == -1


# --- rolling windows in a stream's state -------------------------------------------------

def test_rolling_windows_of_a_stream_equal_the_rebuild_in_any_order(spark, errors, tmp_path):
    draw = random.Random(5)
    rows = [(h, z, draw.randrange(4), draw.randrange(9), m) for h in range(24 * 20) for z in "12" for m in "ab" if draw.random() < 0.3]
    rows += [(h, "9", 1, 3, "a") for h in range(5)]  # a zone that falls silent
    folder, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    # Every row comes up to three parts late, a part being five days; some of the first day come at the end.
    last = [row for row in rows if row[0] < 24 and row[1] == "2"]
    parts = [[] for _ in range(5)]
    for row in rows:
        if row not in last:
            parts[min(4, row[0] // 120 + draw.choice([0, 0, 0, 1]))].append(row)
    parts.append([(24 * 20 + 2, "1", 1, 1, "a"), (24 * 20 + 2, "1", None, 1, "a")][:1])
    schema = errors(rows[:1]).schema
    query = None
    for part in [*parts, last]:
        if part:
            errors(part).coalesce(1).write.mode("append").parquet(folder)
            # Each part is a run of its own, restarted from the checkpoint.
            source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
            query = event_time.run_to_table(rolling_state.rolling_rows(source, lateness=8), out, checkpoint)
    known = errors([row for row in rows if row not in last])
    days = spark.createDataFrame([(hour(24 * d).date(),) for d in range(20)], "day date")
    for got, want in (
        (rolling_state.rolling_by_zone_of_stream(spark, out), rolling.rolling_7d_by_zone(known, days)),
        (rolling_state.rolling_of_stream(spark, out), rolling.rolling_7d(known, days)),
    ):
        got, want = ({tuple(r)[:5]: tuple(r)[5:] for r in df.select("metric_date", *[c for c in df.columns if c in (ZONE, "model_version")], "window_start_timestamp",
                     "num_predictions", "mae", "rmse", "mape_excluding_zero_actuals").collect()} for df in (got, want))
        assert got.keys() == want.keys() and len(got) > 30
        for key, values in want.items():
            assert got[key] == pytest.approx(values)
    late = {(r.model_version, r.PULocationID): r.late for r in rolling_state.late_errors(spark, out).collect()}
    assert late == Counter((m, z) for _, z, _, _, m in last)
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 4  # the silent zone is gone


def test_groups_of_the_rolling_stream_are_few_and_a_day_is_over_at_its_midnight(spark, errors, tmp_path):
    rows = [(h, str(z), 1, z % 5, "a") for z in range(600) for h in (0, 30)]
    errors(rows).coalesce(1).write.parquet(f"{tmp_path}/in")
    errors([(49, "0", 1, 1, "b")]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")  # the watermark ends at a midnight
    source = spark.readStream.schema(errors(rows[:1]).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = event_time.run_to_table(rolling_state.rolling_rows(source), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = Counter((r.metric_date, r.num_predictions, r.mae) for r in rolling_state.rolling_by_zone_of_stream(spark, f"{tmp_path}/out").collect())
    want = Counter((hour(24 * d).date(), d + 1, float(abs(z % 5 - 1))) for z in range(600) for d in (0, 1))
    assert got == want
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= event_time.SLOTS


def test_an_empty_stream_of_errors_gives_empty_tables(spark, errors, tmp_path):
    frame = errors([(1, "1", 1, 2, "a")]).limit(0)
    frame.write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    event_time.run_to_table(rolling_state.rolling_rows(source), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert rolling_state.rolling_of_stream(spark, f"{tmp_path}/out").isEmpty()

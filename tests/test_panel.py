import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import explained, hour
from zonecast.functions.calendar import SEQUENCE_CALENDAR, TABULAR_CALENDAR, calendar_features
from zonecast.operators import panel, scaling


def cells(df, value="demand"):
    return {(r.hour, r.PULocationID): r[value] for r in df.collect()}


def test_grid_keeps_every_hour_and_the_sum(demand):
    rng = random.Random(1)
    rows = {(rng.randrange(200), rng.randrange(6)): rng.randrange(1, 9) for _ in range(150)}
    sparse = demand([(h, z, d) for (h, z), d in rows.items()])
    got = cells(panel.full_panel(sparse))
    first, last = min(h for h, _ in rows), max(h for h, _ in rows)
    zones = {z for _, z in rows}
    assert got == {(hour(h), z): float(rows.get((h, z), 0)) for h in range(first, last + 1) for z in zones}


def test_hour_missing_everywhere_and_null_demand(demand):
    got = cells(panel.full_panel(demand([(0, 1, 5), (3, 1, None), (2, 2, 4)])))
    assert got == {(hour(h), z): {(0, 1): 5.0, (2, 2): 4.0}.get((h, z), 0.0) for h in range(4) for z in (1, 2)}


def test_rows_without_hour_are_ignored(spark, demand):
    sparse = demand([(0, 1, 5), (2, 1, 4)])
    nulls = spark.createDataFrame([(None, 1, 9), (None, 1, 9)], sparse.schema)
    assert cells(panel.full_panel(sparse.union(nulls))) == cells(panel.full_panel(sparse))


def test_duplicate_cell_fails(demand):
    with pytest.raises(PySparkException, match="duplicate hour and zone"):
        panel.full_panel(demand([(0, 1, 5), (0, 1, 6), (2, 1, 1)])).collect()


def test_forced_zones_keep_the_span_of_all_data(spark, demand):
    zones = spark.createDataFrame([(2,), (9,)], "PULocationID int")
    got = cells(panel.full_panel(demand([(0, 1, 5), (1, 2, 3), (4, 1, 1)]), zones))
    assert got == {(hour(h), z): 3.0 if (h, z) == (1, 2) else 0.0 for h in range(5) for z in (2, 9)}


def test_plan_shuffles_sparse_rows_once_and_joins_nothing(demand):
    plan = explained(panel.full_panel(demand([(0, 1, 5), (1, 2, 3)])))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_wide_and_back(demand):
    dense = panel.full_panel(demand([(0, 10, 5), (2, 2, 3)]))
    zones = panel.zone_order(dense)
    assert zones == [2, 10]
    wide = panel.panel_wide(dense, zones)
    assert wide.columns == ["hour", "2", "10"]
    assert cells(panel.melt_wide(wide, zones)) == cells(dense)
    with pytest.raises(ValueError):
        panel.zone_order(dense, limit=1)


def test_splits_and_raw_targets(demand):
    dense = panel.full_panel(demand([(0, 1, 1), (24 * 60, 1, 2)]))  # March 4 to May 3
    split = panel.split_by_month(dense, {"a": ("2024-03", "2024-03"), "b": ("2024-05", "2024-06")})
    counted = {r.split: r.n for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert counted == {"a": 28 * 24, "b": 49}
    assert panel.raw_targets(split.filter("split = 'b'"), 24).count() == 25


def test_scaler_is_population_and_leaves_constants(demand):
    dense = panel.full_panel(demand([(h, 1, 2 * (h % 2) + 1) for h in range(4)] + [(h, 2, 7) for h in range(4)]))
    scaler = scaling.fit_scaler(dense)
    assert {r.PULocationID: (r["mean"], r["scale"]) for r in scaler.collect()} == {1: (2.0, 1.0), 2: (7.0, 1.0)}
    scaled = scaling.scale(dense, scaler)
    assert cells(scaled)[(hour(0), 1)] == -1.0 and cells(scaled)[(hour(0), 2)] == 0.0
    assert cells(scaling.unscale(scaled, scaler)) == cells(dense)


def test_calendar(spark):
    stamps = ["2024-03-04 00:00", "2024-03-10 23:00", "2026-07-03 06:00", "2026-07-04 06:00", "2024-12-01 12:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.to_timestamp("s").alias("at"))
    rows = {str(r["at"])[:16]: r for r in df.select("at", *calendar_features("at")).collect()}
    monday, sunday = rows["2024-03-04 00:00"], rows["2024-03-10 23:00"]
    assert (monday.hour_sin, monday.hour_cos, monday.dow_sin, monday.dow_cos) == (0.0, 1.0, 0.0, 1.0)
    assert monday.is_weekend == 0.0 and sunday.is_weekend == 1.0
    assert sunday.dow_sin == pytest.approx(-0.781831, abs=1e-6)
    assert rows["2026-07-03 06:00"].is_holiday == 1.0 and rows["2026-07-04 06:00"].is_holiday == 0.0
    december = rows["2024-12-01 12:00"]
    assert december.month_sin == pytest.approx(-0.5) and december.month_cos == pytest.approx(0.8660254)
    assert sorted(TABULAR_CALENDAR) == sorted(SEQUENCE_CALENDAR) and TABULAR_CALENDAR != SEQUENCE_CALENDAR
    own = df.select(*calendar_features("at", holidays=["2024-03-04"])).collect()
    assert [r.is_holiday for r in own] == [1.0, 0.0, 0.0, 0.0, 0.0]


def test_panel_is_dealt_over_tasks_by_its_cells(spark, demand, monkeypatch):
    sparse = demand([(h, z, 1 + h % 3) for z in range(40) for h in (z, 60)])
    assert panel.panel_tasks(sparse) == 4  # the partitions of a shuffle
    monkeypatch.setattr(panel, "TASK_CELLS", 100)
    tasks = panel.panel_tasks(sparse)
    assert 20 <= tasks <= 30  # 40 zones, an estimate, of 61 hours
    got = panel.full_panel(sparse, tasks=tasks)
    assert got.rdd.getNumPartitions() == tasks
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, panel.full_panel(sparse).collect()))
    assert panel.panel_tasks(sparse.filter("false")) == 4

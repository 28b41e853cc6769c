import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import explained, hour
from zonecast.functions.calendar import calendar_features, sequence_calendar
from zonecast.operators import lags, panel, sequences
from zonecast.schemas import ZONE
from zonecast.sources import hour_blocks

ZONES = [3, 5, 11]


@pytest.fixture(scope="module")
def dense(demand):
    rng = random.Random(4)
    return panel.full_panel(demand([(h, z, rng.randrange(50)) for h in range(60) for z in ZONES])).cache()


@pytest.fixture(scope="module")
def matrix(dense):
    """Rows by hour, columns by zone, as plain lists."""
    found = {(r.hour, r.PULocationID): r.demand for r in dense.collect()}
    return [[found[(hour(h), z)] for z in ZONES] for h in range(60)]


@pytest.fixture(scope="module")
def calendar(dense):
    def build(order):
        rows = dense.select("hour").distinct().select("hour", *calendar_features("hour", order)).collect()
        found = {r.hour: list(r[1:]) for r in rows}
        return [found[hour(h)] for h in range(60)]
    return build


@pytest.mark.parametrize("horizon", [1, 2, 3])
def test_lag_matrix_equals_index_arithmetic(dense, matrix, calendar, horizon):
    wanted_lags = [1, 2, 3, 24]
    times = calendar(lags.TABULAR_CALENDAR)
    expected = {}
    for t in range(24, 60 - horizon + 1):
        features = [v for lag in wanted_lags for v in matrix[t - lag]] + times[t + horizon - 1]
        expected[hour(t + horizon - 1)] = (features, matrix[t + horizon - 1])
    samples = lags.lag_features(dense, wanted_lags, horizon)
    got = lags.lag_matrix(samples, ZONES, wanted_lags).collect()
    assert {r.target_timestamp: (r.features, r.labels) for r in got} == expected
    names = lags.feature_names(wanted_lags, ZONES)
    assert len(names) == len(got[0].features)
    assert names[:4] == ["lag_1_zone_3", "lag_1_zone_5", "lag_1_zone_11", "lag_2_zone_3"] and names[12] == "hour_sin"


def test_lags_do_not_cross_splits(dense):
    split = dense.withColumn("split", F.when(F.col("hour") < F.lit(hour(30)), "a").otherwise("b"))
    rows = lags.lag_features(split, (1, 24), horizon=2).groupBy("split").agg(
        F.min("target_timestamp").alias("first"), F.count("*").alias("n")).collect()
    assert {r.split: (r["first"], r.n) for r in rows} == {"a": (hour(25), 15), "b": (hour(55), 15)}


@pytest.mark.parametrize("bad", [(), (0, 1), (-1,)])
def test_bad_lags(dense, bad):
    with pytest.raises(ValueError):
        lags.lag_features(dense, bad)
    with pytest.raises(ValueError):
        lags.inference_rows(dense, bad)


def test_inference_row_is_the_sample_after_the_last_hour(dense, matrix):
    rows = lags.inference_rows(dense, (1, 2, 24), horizon=2).collect()
    assert {r.PULocationID: (r.lag_1, r.lag_2, r.lag_24) for r in rows} == {
        z: (matrix[59][i], matrix[58][i], matrix[36][i]) for i, z in enumerate(ZONES)}
    assert {(r.forecast_run_timestamp, r.target_timestamp) for r in rows} == {(hour(59), hour(61))}


def test_inference_needs_the_longest_lag(dense):
    short = dense.filter(F.col("hour") >= F.lit(hour(40)))
    assert lags.inference_rows(short, (1, 20)).count() == 3
    with pytest.raises(PySparkException, match="not enough history"):
        lags.inference_rows(short, (1, 21)).collect()


@pytest.mark.parametrize("horizon", [1, 3])
def test_flat_windows_equal_index_arithmetic(dense, matrix, calendar, horizon):
    times, n = calendar(sequence_calendar()), 5
    full = [a + b for a, b in zip(matrix, times)]
    expected = {
        hour(i + n + horizon - 1): ([v for row in full[i:i + n] for v in row], matrix[i + n + horizon - 1])
        for i in range(60 - n - horizon + 1)}
    got = sequences.flat_windows(sequences.hour_vectors(dense, ZONES), n, horizon).collect()
    assert {r.target_timestamp: (r.features, r.labels) for r in got} == expected


def test_sequence_windows_equal_index_arithmetic(dense, matrix):
    vectors = sequences.hour_vectors(dense, ZONES, calendar=False)
    got = sequences.sequence_windows(vectors, 4, 3).collect()
    assert {r.target_timestamp: (r.x, r.y) for r in got} == {
        hour(i + 4): (matrix[i:i + 4], matrix[i + 4:i + 7]) for i in range(60 - 4 - 3 + 1)}


def test_windows_across_block_borders(demand):
    long = panel.full_panel(demand([(h, 1, h) for h in range(700)]))
    vectors = sequences.hour_vectors(long, [1], calendar=False)
    got = sequences.flat_windows(vectors, 24).collect()
    assert {r.target_timestamp: r.features for r in got} == {
        hour(t): [float(v) for v in range(t - 24, t)] for t in range(24, 700)}


def test_sequence_features_without_month(dense):
    vectors = sequences.hour_vectors(dense, ZONES, include_month=False)
    assert len(vectors.first().features) == len(ZONES) + 6


def test_windows_always_have_partition_keys(dense):
    vectors = sequences.hour_vectors(dense, ZONES)
    for df in (lags.lag_features(dense), sequences.flat_windows(vectors, 24)):
        plan = explained(df)
        assert "windowspecdefinition(" in plan and "windowspecdefinition(hour" not in plan
        assert "windowspecdefinition(index" not in plan


def test_missing_cells_fail_instead_of_shifting(dense):
    lost = dense.filter((F.col("hour") != F.lit(hour(5))) | (F.col(ZONE) != ZONES[0]))
    samples = lags.lag_features(dense, (1,), calendar=False).filter(
        (F.col("target_timestamp") != F.lit(hour(5))) | (F.col(ZONE) != ZONES[0]))
    for zones in (ZONES, dense.select(ZONE)):
        with pytest.raises(Exception, match="every zone once"):
            lags.lag_matrix(samples, zones, (1,)).collect()
        with pytest.raises(Exception, match="every zone once"):
            sequences.hour_vectors(lost, zones).collect()


def test_ten_thousand_and_one_zones(spark):
    n = 10_001
    long = spark.range(n).select(F.col("id").cast("int").alias(ZONE)).crossJoin(
        spark.createDataFrame([(hour(0), 1.0), (hour(1), 2.0)], "hour timestamp, demand double"))
    row = lags.lag_matrix(lags.lag_features(long, (1,), calendar=False), long.select(ZONE), (1,), calendar=False).first()
    assert len(row.features) == n and set(row.features) == {1.0} and set(row.labels) == {2.0}
    names = lags.feature_name_rows(long.select(ZONE), (1, 2)).orderBy("position").collect()
    assert [r.feature for r in names] == lags.feature_names((1, 2), range(n))
    assert [r.position for r in names] == list(range(2 * n + 8))


def as_lists(value):
    return [as_lists(v) for v in value] if isinstance(value, list) else value


def compared(samples, *columns):
    keys = [c for c in ("split", "target_timestamp") if c in samples.columns]
    rows = [(tuple(r[k] for k in keys), tuple(as_lists(r[c]) for c in columns)) for r in samples.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.mark.parametrize("block_hours, horizon", [(1, 1), (7, 3), (168, 2)])
def test_samples_by_reference_are_the_flat_windows(spark, dense, tmp_path, block_hours, horizon):
    vectors = sequences.hour_vectors(dense, ZONES)
    hour_blocks.store_hours(vectors, f"{tmp_path}/hours", block_hours)
    got = compared(hour_blocks.flat_samples(spark, f"{tmp_path}/hours", 9, horizon), "features", "labels")
    assert got == compared(sequences.flat_windows(vectors, 9, horizon), "features", "labels")
    assert len(got) == 60 - 9 - horizon + 1


@pytest.mark.parametrize("block_hours, lengths", [(2, (5, 4)), (10, (4, 3)), (168, (24, 1))])
def test_samples_by_reference_are_the_sequence_windows(spark, dense, tmp_path, block_hours, lengths):
    split = dense.withColumn("split", F.when(F.col("hour") < F.lit(hour(29)), "a").otherwise("b"))
    vectors = sequences.hour_vectors(split, ZONES, calendar=False)
    hour_blocks.store_hours(vectors, f"{tmp_path}/hours", block_hours)
    got = compared(hour_blocks.sequence_samples(spark, f"{tmp_path}/hours", *lengths), "x", "y")
    assert got == compared(sequences.sequence_windows(vectors, *lengths), "x", "y")
    assert {key[0] for key in got} == {"a", "b"}


def test_frames_that_lack_an_hour_are_no_samples(spark, dense, tmp_path):
    vectors = sequences.hour_vectors(dense, ZONES).filter(F.col("hour") != F.lit(hour(20)))
    hour_blocks.store_hours(vectors, f"{tmp_path}/hours", 8)
    got = compared(hour_blocks.sequence_samples(spark, f"{tmp_path}/hours", 4, 2), "x", "y")
    assert {key[0] for key in got} == {hour(t) for t in [*range(4, 19), *range(25, 59)]}
    assert hour_blocks.sequence_samples(spark, f"{tmp_path}/hours", 60, 1).count() == 0


def test_hours_are_stored_once_and_edges_alone_are_handed_on(spark, demand, tmp_path):
    rng = random.Random(8)
    long = panel.full_panel(demand([(h, z, rng.randrange(10 ** 6)) for h in range(1000) for z in ZONES]))
    vectors = sequences.hour_vectors(long, ZONES, calendar=False).cache()
    hour_blocks.store_hours(vectors, f"{tmp_path}/hours")
    stored = spark.read.parquet(f"{tmp_path}/hours")
    assert stored.agg(F.sum(F.size("hours"))).first()[0] == 1000
    assert sum(f.stat().st_size for f in (tmp_path / "hours").glob("*.parquet")) < 1.5 * 8 * 1000 * len(ZONES)
    plan = explained(hour_blocks.flat_samples(spark, f"{tmp_path}/hours", 24))
    assert plan.count("hashpartitioning(") == 1 and "Window" not in plan and "Python" not in plan


def test_bad_lengths_by_reference(spark, dense, tmp_path):
    vectors = sequences.hour_vectors(dense, ZONES)
    with pytest.raises(ValueError):
        hour_blocks.store_hours(vectors, f"{tmp_path}/none", 0)
    hour_blocks.store_hours(vectors, f"{tmp_path}/hours")
    for lengths in ((0, 1), (3, 0)):
        with pytest.raises(ValueError):
            hour_blocks.flat_samples(spark, f"{tmp_path}/hours", *lengths)
        with pytest.raises(ValueError):
            hour_blocks.sequence_samples(spark, f"{tmp_path}/hours", *lengths)


def test_no_hours_give_no_samples(spark, dense, tmp_path):
    hour_blocks.store_hours(sequences.hour_vectors(dense, ZONES).limit(0), f"{tmp_path}/hours")
    assert hour_blocks.flat_samples(spark, f"{tmp_path}/hours", 3).count() == 0

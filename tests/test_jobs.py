"""The jobs that write: warehouse, predictions, the cycle, streams, training."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import explained, hour
from zonecast.operators import evaluation, monitoring, rolling
from zonecast.operators.boosting import load_models
from zonecast.operators.lags import lag_features
from zonecast.operators.panel import full_panel, split_by_day
from zonecast.operators.monitoring import prediction_errors
from zonecast.operators.scaling import fit_scaler, scale, unscale
from zonecast.plans import cycle, predict, prepare, train
from zonecast.config import BoostingConfig, DataConfig
from zonecast.registry import queries
from zonecast.registry.fixtures import Fixtures, lag_mean, naive_24, stand_in_predictions
from zonecast.schemas import ACTUALS, PREDICTIONS, ZONE, conform
from zonecast.session import prepare_session, shared_folder, stored
from zonecast.sources import actuals
from zonecast.sources.files import load_json, write_months
from zonecast.sources.sqlfiles import run_sql_file
from zonecast.sources.tables import TABLES, Warehouse
from zonecast.streaming import cycle_stream
from zonecast.streaming.cycle_stream import run_cycle_stream
from zonecast.streaming.demand_stream import hourly_demand_stream, read_demand_stream, run_demand_stream

METRICS = ("mae", "rmse", "mape_excluding_zero_actuals")


def rows(df):
    rounded = [F.round(c, 9).alias(c) if c in METRICS else F.col(c) for c in df.columns]
    return sorted(map(tuple, df.select(*rounded).collect()), key=str)


@pytest.fixture(scope="module")
def month(demand):
    """Ten days, three zones; some cells are empty, no hour is."""
    rng = random.Random(11)
    cells = [(h, z, rng.randrange(1, 9)) for h in range(240) for z in (1, 2, 3) if z == 1 or rng.random() < 0.7]
    return demand(cells).cache()


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, shared_folder(spark, "warehouse"))


def test_shared_folder_is_the_configured_one(spark):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and folder != shared_folder(spark, "x")


def test_stored_frame_does_not_run_its_plan_again(spark):
    kept = stored(spark.range(3).withColumn("r", F.rand()), "x")
    assert rows(kept) == rows(kept)


def test_warehouse_tables(spark, warehouse, month):
    assert warehouse.read("actuals").count() == 0
    table = actuals.as_actuals(month)
    warehouse.replace("actuals", table)
    warehouse.append("actuals", table.limit(0))
    assert rows(warehouse.read("actuals")) == rows(table)
    assert warehouse.read("actuals", (hour(24).date(), hour(24).date())).select("hour").distinct().count() == 24
    # Replacing one day may read the table itself.
    day = warehouse.read("actuals", (hour(24).date(), hour(24).date()))
    n = day.count()
    warehouse.replace_days("actuals", day.withColumn("demand", F.lit(0.0)))
    assert warehouse.read("actuals").count() == table.count()
    assert warehouse.read("actuals").filter("demand = 0").count() == n


def test_latest_reads(spark, month):
    table = actuals.as_actuals(month)
    assert actuals.require_latest_hour(table) == hour(239)
    assert actuals.latest_actuals(table, 24).select("hour").distinct().count() == 25
    assert rows(actuals.latest_actuals(table, 24, hour(239))) == rows(actuals.latest_actuals(table, 24))
    with pytest.raises(ValueError):
        actuals.require_latest_hour(table.limit(0))
    early = month.filter(F.col("hour") < F.lit(hour(100)))
    assert {r.hour for r in actuals.next_hour_actuals(month, early).collect()} == {hour(100)}


def test_batch_predictions_follow_the_scaler_zones(spark, month):
    scaler = fit_scaler(full_panel(month)).filter(F.col(ZONE) != 3).union(
        spark.createDataFrame([(9, 0.0, 1.0)], f"{ZONE} int, mean double, scale double"))
    got = predict.batch_predictions(
        actuals.as_actuals(month), scaler, predict.column_predictor(naive_24()), "m", horizon=2)
    found = {(r.target_timestamp, r[ZONE]): r.predicted_demand for r in got.collect()}
    assert {z for _, z in found} == {"1", "2", "9"} and len(found) == 3 * (240 - 25)
    truth = {(r.hour, str(r[ZONE])): r.demand for r in month.collect()}
    for (stamp, zone), value in found.items():
        assert value == pytest.approx(truth.get((stamp - timedelta(hours=25), zone), 0.0), abs=1e-9)
    assert {r.target_timestamp - r.forecast_run_timestamp for r in got.collect()} == {timedelta(hours=2)}


def test_next_hour_is_appended_once(spark, warehouse, month):
    scaler = fit_scaler(full_panel(month))
    warehouse.replace("actuals", actuals.as_actuals(month))
    predictor = predict.column_predictor(lag_mean())
    predict.run_next_hour(warehouse, scaler, predictor, "m")
    predict.run_next_hour(warehouse, scaler, predictor, "m")
    got = warehouse.read("predictions")
    assert {(r.forecast_run_timestamp, r.target_timestamp, r[ZONE]) for r in got.collect()} == {
        (hour(239), hour(240), z) for z in "123"} and got.count() == 3
    assert actuals.prediction_exists(got, hour(240), "m") and not actuals.prediction_exists(got, hour(240), "x")
    predict.run_next_hour(warehouse, scaler, predictor, "other")
    assert warehouse.read("predictions").count() == 6


def test_batch_needs_history(warehouse, month):
    scaler = fit_scaler(full_panel(month))
    predictor = predict.column_predictor(lag_mean())
    with pytest.raises(ValueError):
        predict.run_batch(warehouse, scaler, predictor, "m")
    warehouse.replace("actuals", actuals.as_actuals(month.filter(F.col("hour") < F.lit(hour(24)))))
    with pytest.raises(ValueError):
        predict.run_batch(warehouse, scaler, predictor, "m")
    warehouse.replace("actuals", actuals.as_actuals(month.filter(F.col("hour") < F.lit(hour(25)))))
    predict.run_batch(warehouse, scaler, predictor, "m")
    assert warehouse.read("predictions").count() == 3


def rebuilt(spark, month, until):
    house = Warehouse(spark, shared_folder(spark, "warehouse"))
    house.replace("predictions", stand_in_predictions(full_panel(month)))
    house.replace("actuals", actuals.as_actuals(month.filter(F.col("hour") < F.lit(until))))
    cycle.rebuild(house)
    with pytest.raises(ValueError):
        cycle.rebuild(house)
    return house


def test_rebuild_is_a_new_version(spark, month):
    house = rebuilt(spark, month, hour(200))
    version = Warehouse(spark, shared_folder(spark, "warehouse"), inputs=house.base)
    cycle.rebuild(version)
    assert version.path("actuals") == house.path("actuals")
    assert rows(version.read("metrics_by_day")) == rows(house.read("metrics_by_day"))


def test_cycle_catches_up_with_a_rebuild_and_repeats_safely(spark, month):
    house = rebuilt(spark, month, hour(190))
    late = month.filter(F.col("hour") >= F.lit(hour(190)))
    cycle.apply_actuals(house, late)
    whole = rebuilt(spark, month, hour(240))
    for name in TABLES:
        assert rows(house.read(name)) == rows(whole.read(name)), name
    cycle.apply_actuals(house, late)
    for name in TABLES:
        assert rows(house.read(name)) == rows(whole.read(name)), name
    cycle.create_views(house)
    assert spark.table("vw_overall_metrics").count() == 2
    assert spark.table("vw_prediction_metrics_groupby_zone").count() == 6
    assert {r.window_end_timestamp for r in spark.table("vw_latest_prediction_metrics_rolling_7d").collect()} == {
        hour(239)}


def test_single_hours_of_one_model(spark, month):
    house = rebuilt(spark, month, hour(238))
    cycle.run_hour(house, month, "naive_24")
    newest = house.read("metrics_by_hour").filter(F.col("target_timestamp") == F.lit(hour(237)))
    assert newest.count() == 2
    assert house.read("metrics_by_hour").filter(F.col("target_timestamp") == F.lit(hour(238))).count() == 1
    assert house.read("rolling_7d").agg(F.max("window_end_timestamp")).first()[0] == hour(215)
    cycle.run_hour(house, month, "naive_24")  # the hour 23
    got = house.read("rolling_7d").filter(F.col("window_end_timestamp") == F.lit(hour(239))).collect()
    assert [r.model_version for r in got] == ["naive_24"]
    with pytest.raises(ValueError):
        cycle.run_hour(house, month, "naive_24")
    n = house.read("actuals").count()
    cycle.run_hour(house, month, "lagmean_1_2_3_24", again=hour(239))
    assert house.read("actuals").count() == n
    assert house.read("rolling_7d").filter(F.col("window_end_timestamp") == F.lit(hour(239))).count() == 2


def test_late_actuals_insert_new_cells_only(spark, month):
    house = rebuilt(spark, month, hour(240))
    before = house.read("metrics_by_hour").collect()
    stamp = hour(200)
    extra = spark.createDataFrame([(stamp, "1", 99.0), (stamp, "7", 1.0)], ACTUALS)
    cycle.apply_actuals(house, extra)
    stored_rows = house.read("actuals").filter(F.col("hour") == F.lit(stamp)).collect()
    assert {r[ZONE] for r in stored_rows} >= {"1", "7"} and all(r.demand != 99.0 for r in stored_rows)
    assert sorted(map(str, house.read("metrics_by_hour").collect())) == sorted(map(str, before))


def test_demand_stream_equals_batch(spark, month, tmp_path):
    trips = month.select(F.explode(F.array_repeat(F.col("hour"), F.col("demand").cast("int"))).alias("request_datetime"), ZONE)
    trips.withColumn("request_datetime", F.col("request_datetime").cast("timestamp_ntz")).repartitionByRange(
        5, "request_datetime").sortWithinPartitions("request_datetime").write.parquet(f"{tmp_path}/in")
    schema = f"request_datetime timestamp_ntz, {ZONE} int"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")
    run_demand_stream(hourly_demand_stream(source), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert rows(read_demand_stream(spark, f"{tmp_path}/out")) == rows(month.select("hour", ZONE, "demand"))


def test_late_trips_are_counted(spark, tmp_path):
    schema = f"request_datetime timestamp, {ZONE} int"
    for n, stamps in enumerate([[hour(10), hour(12)], [hour(2), hour(12)]]):
        spark.createDataFrame([(s, 1) for s in stamps], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    run_demand_stream(hourly_demand_stream(source), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = {r.hour: r.demand for r in read_demand_stream(spark, f"{tmp_path}/out").collect()}
    assert got == {hour(10): 1, hour(12): 2, hour(2): 1}


def test_stream_filters_and_empty_source(spark, tmp_path):
    schema = f"hvfhs_license_num string, request_datetime timestamp, {ZONE} int"
    spark.createDataFrame([("x", hour(1), 1), ("x", hour(1), 2), ("y", hour(1), 1)], schema).write.parquet(
        f"{tmp_path}/in")
    zones = spark.createDataFrame([(1,)], f"{ZONE} int")
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    run_demand_stream(hourly_demand_stream(source, zones=zones, license_num="x"),
                      f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert rows(read_demand_stream(spark, f"{tmp_path}/out")) == [(hour(1), 1, 1)]
    (tmp_path / "none").mkdir()
    empty = spark.readStream.schema(schema).parquet(f"{tmp_path}/none")
    run_demand_stream(hourly_demand_stream(empty), f"{tmp_path}/out2", f"{tmp_path}/checkpoint2")
    assert read_demand_stream(spark, f"{tmp_path}/out2").count() == 0


def test_cycle_stream_equals_rebuild(spark, month, tmp_path):
    house = Warehouse(spark, shared_folder(spark, "warehouse"))
    house.replace("predictions", stand_in_predictions(full_panel(month)))
    conform(month, ACTUALS).repartitionByRange(4, "hour").write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(ACTUALS).parquet(f"{tmp_path}/in")
    run_cycle_stream(source, house, f"{tmp_path}/checkpoint")
    whole = rebuilt(spark, month, hour(240))
    for name in ("actuals", "errors", "metrics_by_hour", "metrics_by_day"):
        assert rows(house.read(name)) == rows(whole.read(name)), name
    bulk = rows(whole.read("rolling_7d"))
    assert [r for r in rows(house.read("rolling_7d")) if r in bulk] == bulk


def test_cycle_stream_of_cut_hours_equals_rebuild(spark, month, tmp_path):
    """Every hour lies in two files, read in two batches."""
    house = Warehouse(spark, shared_folder(spark, "warehouse"))
    house.replace("predictions", stand_in_predictions(full_panel(month)))
    cells = conform(month, ACTUALS)
    for part in (0, 1):
        cells.filter(F.col(ZONE).cast("int") % 2 == part).coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
    source = spark.readStream.schema(ACTUALS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    run_cycle_stream(source, house, f"{tmp_path}/checkpoint")
    whole = rebuilt(spark, month, hour(240))
    for name in ("actuals", "errors", "metrics_by_hour", "metrics_by_day"):
        assert rows(house.read(name)) == rows(whole.read(name)), name
    for name in ("rolling_7d", "rolling_7d_by_zone"):
        bulk = rows(whole.read(name))
        assert bulk and [r for r in rows(house.read(name)) if r in bulk] == bulk, name


def broadcasts_expanded_rows(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for n, line in enumerate(lines):
        depth = line.find("BroadcastExchange")
        for below in lines[n + 1:] if depth >= 0 else []:
            if len(below) - len(below.lstrip(" :+-")) <= depth:
                break
            if "Generate explode" in below:
                return True
    return False


def test_dense_panels_are_never_broadcast(spark, month):
    """Spark takes a panel for as small as its sparse rows."""
    panel = full_panel(month)
    scaler = fit_scaler(panel)
    made = stand_in_predictions(panel)
    frames = (scale(panel, scaler), unscale(panel, scaler), prediction_errors(made, panel),
              predict.batch_predictions(month, scaler, predict.column_predictor(F.col("lag_1")), "m"))
    for df in frames:
        assert not broadcasts_expanded_rows(df)
    assert broadcasts_expanded_rows(month.join(F.broadcast(panel.select(ZONE)), ZONE))


def test_predictor_that_loses_or_repeats_a_zone(spark, month):
    scaler = fit_scaler(full_panel(month))
    whole = predict.column_predictor(F.col("lag_1"))
    for wrong in (lambda s: whole(s).filter(F.col(ZONE) != 2), lambda s: whole(s).union(whole(s))):
        with pytest.raises(Exception, match="every zone and hour once"):
            predict.batch_predictions(month, scaler, wrong, "m", checked=True).collect()
        with pytest.raises(Exception, match="every zone and hour once"):
            predict.next_hour_prediction(
                month, spark.createDataFrame([], PREDICTIONS), scaler, wrong, "m").collect()


def test_sql_file_with_named_parameters(spark, tmp_path, errors):
    errors([(1, "1", 1, 3, "m"), (2, "1", 1, 3, "m")]).createOrReplaceTempView("some_errors")
    path = tmp_path / "q.sql"
    path.write_text("SELECT * FROM some_errors WHERE target_timestamp = :target_timestamp AND model_version = :model_version")
    assert run_sql_file(spark, str(path), hour(1), "m").count() == 1
    assert run_sql_file(spark, str(path), hour(1), "x'; --").count() == 0


@pytest.fixture(scope="module")
def trained(spark, month):
    config = BoostingConfig(n_estimators=2, max_depth=2, lags=(1, 24))
    days = [str(hour(24 * d).date()) for d in (0, 7, 10)]
    split = split_by_day(full_panel(month), {"train": (days[0], days[1]), "test": (days[1], days[2])})
    return config, train.train(split, config)


def test_registered_training_takes_the_default_settings():
    assert queries.BOOSTING == BoostingConfig() and (queries.BOOSTING.n_estimators, queries.BOOSTING.max_depth) == (300, 4)


def assert_scoring_from_files(spark, month, root):
    scaler, zones, models = train.load_run(spark, root)
    house = Warehouse(spark, shared_folder(spark, "warehouse"))
    house.replace("actuals", conform(month, ACTUALS).filter(F.col("hour") < F.lit(hour(239))))
    predict.run_batch(house, scaler, models.predict, "m", models.lags)
    assert house.read("predictions").count() == len(zones) * (239 - 24)
    predict.run_next_hour(house, scaler, models.predict, "m", models.lags)
    assert house.read("predictions").count() == len(zones) * (240 - 24)


def test_training_run(spark, month, trained, tmp_path):
    config, run = trained
    assert run.zones == [1, 2, 3] and run.cells.count() == 3 * (72 - 24)
    overall = evaluation.evaluate_overall(run.cells).first()
    assert 0 < overall.overall_mae < 9
    data = DataConfig("2024-03", "2024-03", ("2024-03", "2024-03"), ("2024-03", "2024-03"))
    root = train.save_run(spark, run, f"{tmp_path}/models", "run-1", data, config)
    assert load_json(spark, f"{root}/inference/zone_names") == [1, 2, 3]
    assert_scoring_from_files(spark, month, root)
    assert spark.read.json(f"{root}/results/summary").first().run_id == "run-1"
    assert spark.read.option("header", True).csv(f"{root}/results/per_zone").count() == 3
    assert spark.read.option("header", True).csv(f"{root}/results/top_bottom").count() == 18
    types = spark.read.option("header", True).csv(f"{root}/feature_importance/type_importance_summary")
    assert {r.type: int(r["count"]) for r in types.collect()} == {"spatial": 6, "other": 8}


def test_training_job_and_actuals_from_processed_months(spark, demand, warehouse, tmp_path):
    rng = random.Random(3)
    # The last days of March train, the first days of April test.
    months = demand([(h, z, rng.randrange(1, 9)) for h in range(27 * 24, 31 * 24) for z in (1, 2)])
    write_months(months, f"{tmp_path}/processed")
    data = DataConfig("2024-03", "2024-04", ("2024-03", "2024-03"), ("2024-04", "2024-04"))
    config = BoostingConfig(n_estimators=1, max_depth=1, lags=(1, 2))
    root = train.run(spark, f"{tmp_path}/processed", f"{tmp_path}/models/", "r", data, config)
    cells = spark.read.parquet(f"{root}/results/predictions")
    assert {r.target_timestamp.month for r in cells.collect()} == {4}
    prepare.load_actuals(spark, f"{tmp_path}/processed", warehouse, "2024-04", "2024-04")
    assert warehouse.read("actuals").count() == 2 * (31 - 28) * 24


def test_sequence_samples_stay_in_their_split(month):
    days = [str(hour(24 * d).date()) for d in (0, 7, 10)]
    split = split_by_day(full_panel(month), {"train": (days[0], days[1]), "test": (days[1], days[2])})
    samples, scaler = train.sequence_samples(split, [1, 2, 3], 6, 2)
    counted = {r.split: (r.first, r.n) for r in samples.groupBy("split").agg(
        F.min("target_timestamp").alias("first"), F.count("*").alias("n")).collect()}
    assert counted == {"train": (hour(6), 168 - 7), "test": (hour(174), 72 - 7)}
    row = samples.filter("split = 'test'").first()
    assert len(row.x) == 6 and len(row.x[0]) == 3 + 8 and len(row.y) == 2 and len(row.y[0]) == 3
    assert scaler.count() == 3


def test_reloaded_models_predict_the_same(spark, trained, month, tmp_path):
    _, run = trained
    run.models.save(spark, f"{tmp_path}/m")
    scaled = scale(full_panel(month), run.scaler)
    samples = lag_features(scaled, (1, 24))
    again = load_models(spark, f"{tmp_path}/m")
    assert rows(again.predict(samples)) == rows(run.models.predict(samples))
    total = run.models.importance(spark).groupBy("target_zone").agg(F.sum("importance").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in total)


def test_models_score_as_predictor(spark, trained, month):
    _, run = trained
    got = predict.batch_predictions(actuals.as_actuals(month), run.scaler, run.models.predict, "gbt", (1, 24))
    assert got.count() == 3 * (240 - 24)
    errors = monitoring.prediction_errors(got, actuals.as_actuals(month))
    assert rolling.rolling_7d(errors).count() > 0


def test_production_variant_trains_on_everything(month):
    run = train.train_on_all(month, BoostingConfig(n_estimators=1, max_depth=1, lags=(1,)))
    assert run.scaler.count() == 3 and run.models.trees.select("target_zone").distinct().count() == 3 and run.cells is None


def test_replace_keeps_the_old_table_until_the_new_one_is_whole(spark, tmp_path, demand):
    house = Warehouse(spark, str(tmp_path))
    rows = actuals.as_actuals(demand([(0, 1, 5), (1, 2, 6), (30, 1, 7)]))
    house.append("actuals", rows)
    broken = rows.withColumn("demand", F.when(F.col("demand") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("demand")))
    with pytest.raises(Exception, match="lost"):
        house.replace("actuals", broken)
    assert house.read("actuals").count() == 3
    house.replace("actuals", house.read("actuals").filter(F.col("demand") < 7))  # may read itself
    house.append("actuals", rows.filter(F.col("demand") == 7).withColumn("demand", F.lit(8.0)))
    assert sorted(r.demand for r in house.read("actuals").collect()) == [5.0, 6.0, 8.0]
    assert house.newest("actuals").count() == 1
    house.replace("actuals", rows.limit(0))
    assert house.read("actuals").count() == 0


def test_errors_of_a_week_read_a_week_of_folders(spark, tmp_path, errors):
    house = Warehouse(spark, str(tmp_path))
    house.replace("errors", errors([(24 * d, "1", 1, 2, "m") for d in range(20)]))
    week = house.read("errors", ((hour(0) + timedelta(days=10)).date(), (hour(0) + timedelta(days=16)).date()))
    assert week.count() == 7 and "PartitionFilters: [isnotnull(day" in explained(week)


def test_days_are_written_without_a_sort(spark, month, tmp_path):
    """A task keeps the files of some days open; of more days than that, the rest is sorted, and nothing is lost."""
    prepare_session(spark)
    assert 0 < int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) < 20
    days = month.select("hour", ZONE, F.date_add(F.to_date("hour"), F.col(ZONE) * 10).alias("day")).coalesce(1)
    assert days.select("day").distinct().count() > 20
    days.write.partitionBy("day").parquet(f"{tmp_path}/days")
    got = spark.read.parquet(f"{tmp_path}/days").select("hour", ZONE, "day")
    assert rows(got) == rows(days)


def test_batches_of_the_cycle_stream_do_not_grow_with_its_files(spark, monkeypatch):
    batches, limit = [], "spark.sql.files.maxRecordsPerFile"
    monkeypatch.setattr(cycle_stream, "apply_actuals", lambda warehouse, batch, *_, **__: batches.append(batch.count()))
    fixtures = Fixtures(spark, "/root/testdata/sf0.001")
    number = fixtures.hourly.count()
    spark.conf.set(limit, "50")
    try:
        queries._streamed(fixtures)
    finally:
        spark.conf.unset(limit)
    assert len(batches) == 3 and sum(batches) == number


def test_hours_of_a_batch_are_broadcast_whatever_their_estimate(spark, month, monkeypatch):
    house, plans, append = rebuilt(spark, month, hour(190)), {}, Warehouse.append
    monkeypatch.setattr(Warehouse, "append", lambda self, name, df: plans.update({name: explained(df)}) or append(self, name, df))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cycle.apply_actuals(house, month.filter(F.col("hour") >= F.lit(hour(190))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin LeftSemi" in plans["errors"] and "BroadcastHashJoin LeftSemi" in plans["metrics_by_hour"]

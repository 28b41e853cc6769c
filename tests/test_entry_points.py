"""The jobs a scheduler starts, one after the other on a few zones."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import hour
from zonecast import jobs
from zonecast.config import BoostingConfig
from zonecast.operators.panel import full_panel
from zonecast.operators.scaling import fit_scaler
from zonecast.plans import train
from zonecast.sources import files
from zonecast.sources.tables import Warehouse


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Raw trips of two months, three zones of two boroughs."""
    base = str(tmp_path_factory.mktemp("jobs"))
    draw = random.Random(1)
    trips = [("HV", hour(h), z) for h in range(26 * 24, 31 * 24) for z in (1, 2, 3) for _ in range(draw.randrange(1, 5))]
    frame = spark.createDataFrame(trips, "hvfhs_license_num string, request_datetime timestamp_ntz, PULocationID int")
    for ym in ("2024-03", "2024-04"):
        frame.filter(F.date_format("request_datetime", "yyyy-MM") == ym).write.parquet(files.raw_path(f"{base}/raw", ym))
    files.write_report(spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "LocationID int, Borough string"), f"{base}/lookup")
    return base


def run(spark, base, name, **options):
    words = [name]
    for key, value in options.items():
        words += [f"--{key}", *([value] if isinstance(value, str) else value)]
    jobs.main(words, spark)


def test_jobs_one_after_the_other(spark, base, monkeypatch):
    monkeypatch.setattr(jobs, "BoostingConfig", lambda: BoostingConfig(n_estimators=2, max_depth=2, lags=(1, 2)))
    both = ("2024-03", "2024-04")
    run(spark, base, "preprocess", raw=f"{base}/raw", lookup=f"{base}/lookup", processed=f"{base}/processed", months=both, borough="A")
    demand = files.read_months(spark, f"{base}/processed", *both)
    assert demand.select("PULocationID").distinct().count() == 2
    run(spark, base, "load-actuals", processed=f"{base}/processed", warehouse=f"{base}/house", months=both)
    run(spark, base, "train-models", processed=f"{base}/processed", models=f"{base}/models", run="r1", train=("2024-03", "2024-03"), test=("2024-04", "2024-04"))
    run(spark, base, "train-production", processed=f"{base}/processed", moments=f"{base}/moments", models=f"{base}/models", run="r2", months=both)
    scaler, zones, _ = train.load_run(spark, f"{base}/models/r2")
    want = {r.PULocationID: (r.mean, r.scale) for r in fit_scaler(full_panel(demand)).collect()}
    assert zones == [1, 2] and {r.PULocationID: (r.mean, r.scale) for r in scaler.collect()} == {z: pytest.approx(v) for z, v in want.items()}
    house = Warehouse(spark, f"{base}/house")
    for name in ("r1", "r2"):
        run(spark, base, "predict-batch", warehouse=f"{base}/house", models=f"{base}/models", run=name)
        assert {r.model_version for r in house.read("predictions").select("model_version").distinct().collect()} == {name}
    scored = house.read("predictions").count()
    run(spark, base, "predict-next-hour", warehouse=f"{base}/house", models=f"{base}/models", run="r2", model="r2")
    assert house.read("predictions").count() == scored + 2
    run(spark, base, "rebuild", warehouse=f"{base}/metrics", inputs=f"{base}/house")
    assert Warehouse(spark, f"{base}/metrics").read("metrics_by_day").count() > 0
    path = f"{base}/q"
    spark.createDataFrame([("SELECT count(*) AS n FROM errors WHERE model_version = :model_version",)], "value string").coalesce(1).write.text(path)
    run(spark, base, "script", warehouse=f"{base}/metrics", script=path, model="r2")


def test_only_new_months_are_read_for_the_scaler(spark, base, demand, tmp_path):
    months = demand([(h, 1, 1 + h % 3) for h in range(24 * 80)])
    files.write_months(months, f"{tmp_path}/p")
    assert train.update_moments(spark, f"{tmp_path}/p", f"{tmp_path}/m", "2024-03", "2024-04") == ["2024-03", "2024-04"]
    assert train.update_moments(spark, f"{tmp_path}/p", f"{tmp_path}/m", "2024-03", "2024-05") == ["2024-05"]


def test_batch_without_history_keeps_the_old_predictions(spark, tmp_path, demand):
    from zonecast.plans import predict
    house = Warehouse(spark, str(tmp_path))
    cells = demand([(h, 1, 1 + h % 4) for h in range(30)])
    scaler = fit_scaler(full_panel(cells))
    house.replace("actuals", cells)
    predict.run_batch(house, scaler, predict.column_predictor(F.col("lag_1")), "m")
    assert house.read("predictions").count() == 6
    house.replace("actuals", cells.filter(F.col("hour") < F.lit(hour(3))))
    with pytest.raises(ValueError, match="not enough history"):
        predict.run_batch(house, scaler, predict.column_predictor(F.col("lag_1")), "m")
    house.replace("actuals", cells.limit(0))
    with pytest.raises(ValueError, match="holds no hours"):
        predict.run_batch(house, scaler, predict.column_predictor(F.col("lag_1")), "m")
    assert house.read("predictions").count() == 6


def test_unknown_options_end_the_job():
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["preprocess", "--raw", "x"])

"""Training: demand to scaled samples, one model per zone, evaluation and saved artifacts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators import evaluation
from zonecast.operators.boosting import ZoneModels, fit_zone_models, load_models
from zonecast.operators.importance import importance_by, importance_by_feature, importance_by_type
from zonecast.operators.lags import lag_features
from zonecast.operators.panel import full_panel, raw_targets, split_by_month, zone_order
from zonecast.operators.scaling import add_months, fit_scaler, merged_scaler, read_moments, scale, unscale
from zonecast.operators.sequences import hour_vectors, sequence_windows
from zonecast.config import BoostingConfig, DataConfig
from zonecast.schemas import ZONE
from zonecast.session import stored
from zonecast.functions.months import months_between
from zonecast.sources.files import load_json, read_months, save_json, table_exists, write_report


@dataclass(frozen=True)
class TrainingRun:
    zones: list[int]
    scaler: DataFrame
    models: ZoneModels
    cells: DataFrame | None = None
    """Predicted and actual demand of the test hours, if there are any."""


def split_demand(demand: DataFrame, config: DataConfig) -> DataFrame:
    """The labelled panel. The validation months train too, as the trees use no early stop."""
    last_train = (config.validation or config.train)[1]
    return split_by_month(full_panel(demand), {
        "train": (config.train[0], last_train), "test": config.test})


def test_cells(split_panel: DataFrame, scaler: DataFrame, models: ZoneModels, config: BoostingConfig) -> DataFrame:
    """Predictions of the ``test`` split on the raw scale beside the raw demand."""
    test = split_panel.filter(F.col("split") == "test").drop("split")
    samples = lag_features(scale(test, scaler), config.used_lags, config.horizon, calendar=config.used_calendar)
    predicted = unscale(models.predict(samples), scaler, "predicted")
    targets = raw_targets(test, max(config.used_lags) + config.horizon - 1).select(
        F.col("hour").alias("target_timestamp"), ZONE, F.col("demand").alias("actual"))
    return evaluation.cells_from(predicted, targets, ["target_timestamp", ZONE], ZONE)


def train(split_panel: DataFrame, config: BoostingConfig) -> TrainingRun:
    """Fit on the ``train`` split only, scaler included."""
    split_panel = stored(split_panel, "split-panel")
    training = split_panel.filter(F.col("split") == "train").drop("split")
    zones = zone_order(split_panel)
    scaler = stored(fit_scaler(training), "scaler")
    samples = lag_features(scale(training, scaler), config.used_lags, config.horizon, calendar=config.used_calendar)
    models = fit_zone_models(samples, zones, config)
    return TrainingRun(zones, scaler, models, test_cells(split_panel, scaler, models, config))


def train_on_all(demand: DataFrame, config: BoostingConfig, scaler: DataFrame | None = None) -> TrainingRun:
    """The production variant: samples over the whole history, and the scaler of it, which is fitted here if none is given. No test hours."""
    zones, panel = zone_order(demand), full_panel(demand)
    scaler = stored(fit_scaler(panel) if scaler is None else scaler, "scaler")
    samples = lag_features(scale(panel, scaler), config.used_lags, config.horizon, calendar=config.used_calendar)
    return TrainingRun(zones, scaler, fit_zone_models(samples, zones, config))


def update_moments(spark: SparkSession, processed: str, moments: str, first: str, last: str) -> list[str]:
    """Store the moments of the months that have none yet, and of the last one, which may have grown. Only these are read."""
    months = months_between(first, last)
    known = read_moments(spark, moments) if table_exists(spark, moments) else None
    have = set() if known is None else {row[0] for row in known.select("ym").distinct().collect()}  # one value a month
    missing = [ym for ym in months if ym not in have or ym == last]
    for ym in missing:
        add_months(read_months(spark, processed, ym, ym), moments)
    return missing


def run_production(spark: SparkSession, processed: str, moments: str, base: str, run_id: str, data: DataConfig, config: BoostingConfig) -> str:
    """Fit on all processed months and save the run for the scoring jobs. The scaler comes from the months' moments,
    so months that were seen before are not read for it again."""
    first, last = data.train[0], data.test[1]
    update_moments(spark, processed, moments, first, last)
    scaler = merged_scaler(read_moments(spark, moments).filter(F.col("ym").between(first, last)))
    run = train_on_all(read_months(spark, processed, first, last), config, scaler)
    return save_inference(spark, run, base, run_id, data, config)


def sequence_samples(
    split_panel: DataFrame, zones: Sequence[int], input_len: int, output_len: int,
) -> tuple[DataFrame, DataFrame]:
    """Scaled windows of every split for sequence models, and the scaler of the ``train`` split."""
    scaler = fit_scaler(split_panel.filter(F.col("split") == "train"))
    vectors = hour_vectors(scale(split_panel, scaler), zones)
    return sequence_windows(vectors, input_len, output_len), scaler


def run(spark: SparkSession, processed: str, base: str, run_id: str,
        data: DataConfig, config: BoostingConfig) -> str:
    """Processed months to a saved run."""
    demand = read_months(spark, processed, data.train[0], data.test[1])
    return save_run(spark, train(split_demand(demand, data), config), base, run_id, data, config)


def save_inference(spark: SparkSession, run: TrainingRun, base: str, run_id: str,
                   data: DataConfig, config: BoostingConfig) -> str:
    """What scoring needs of a run, and its settings."""
    root = f"{base.rstrip('/')}/{run_id}"
    run.models.save(spark, f"{root}/inference/models")
    run.scaler.write.mode("overwrite").parquet(f"{root}/inference/scaler")
    save_json(spark, run.zones, f"{root}/inference/zone_names")
    save_json(spark, {"model_config": asdict(config), "data_config": asdict(data)},
              f"{root}/config/run_config")
    return root


def save_run(spark: SparkSession, run: TrainingRun, base: str, run_id: str,
             data: DataConfig, config: BoostingConfig) -> str:
    """Everything of one run under ``base/run_id``; the run id is given, not taken from a clock."""
    root = save_inference(spark, run, base, run_id, data, config)
    results = f"{root}/results"
    run.cells.write.mode("overwrite").parquet(f"{results}/predictions")
    # Written cells are read back, so that the reports do not score the test hours again.
    cells = spark.read.parquet(f"{results}/predictions")
    per_zone = evaluation.evaluate_per_zone(cells)
    evaluation.evaluate_overall(cells).select("*", F.lit(run_id).alias("run_id")).coalesce(1).write.mode(
        "overwrite").json(f"{results}/summary")
    write_report(per_zone, f"{results}/per_zone")
    write_report(evaluation.top_bottom_zones(per_zone), f"{results}/top_bottom")

    features = importance_by_feature(run.models.importance(spark))
    # Names and orders of the reports.
    for name, report, order in (
        ("feature_importance", features, "importance"),
        ("lag_importance", importance_by(features, "lag"), "importance"),
        ("zone_importance", importance_by(features, "zone"), "importance"),
        ("type_importance_summary", importance_by_type(features), "sum"),
    ):
        write_report(report.orderBy(F.desc(order)), f"{root}/feature_importance/{name}")
    return root


def load_run(spark: SparkSession, root: str) -> tuple[DataFrame, list[int], ZoneModels]:
    """Scaler, zones and models of a saved run. ``models.predict`` is the predictor of the scoring jobs, ``models.lags`` its lags."""
    scaler = spark.read.schema(f"{ZONE} int, mean double, scale double").parquet(f"{root}/inference/scaler")
    return scaler, load_json(spark, f"{root}/inference/zone_names"), load_models(spark, f"{root}/inference/models")

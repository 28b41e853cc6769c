"""Scoring: all history at once, or the hour after the latest actuals.

A predictor is a function from scaled lag rows (one per target hour and zone) to rows with
``target_timestamp``, the zone and ``predicted`` on the same scale.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.stamps import hours
from zonecast.operators.lags import DEFAULT_LAGS, check_lags, inference_rows, lag_features
from zonecast.operators.panel import full_panel
from zonecast.operators.scaling import scale, unscale
from zonecast.schemas import HOURLY_DEMAND, PREDICTIONS, ZONE, conform
from zonecast.sources.actuals import latest_actuals, require_latest_hour, without_existing
from zonecast.sources.tables import Warehouse

Predictor = Callable[[DataFrame], DataFrame]


def column_predictor(value: Column) -> Predictor:
    """A predictor that is an expression over the lag columns of the zone itself."""
    def predict(samples: DataFrame) -> DataFrame:
        keys = [c for c in ("forecast_run_timestamp", "target_timestamp", ZONE) if c in samples.columns]
        return samples.select(*keys, value.alias("predicted"))
    return predict


def complete(predicted: DataFrame, samples: DataFrame) -> DataFrame:
    """The predictor's rows. A cell that was asked for and is missing, doubled or not asked for fails the job.

    Both sides become counts per cell in one shuffle, combined in the map tasks."""
    keys = [c for c in ("forecast_run_timestamp", "target_timestamp", ZONE) if c in samples.columns]
    asked = samples.select(*keys, F.lit(None).cast("double").alias("predicted"), F.lit(1).alias("asked"), F.lit(0).alias("made"))
    made = predicted.select(*keys, F.col("predicted").cast("double"), F.lit(0).alias("asked"), F.lit(1).alias("made"))
    cells = asked.unionByName(made).groupBy(*keys).agg(
        F.max("predicted").alias("predicted"), F.sum("asked").alias("asked"), F.sum("made").alias("made"))
    value = F.when((F.col("asked") == 1) & (F.col("made") == 1), F.col("predicted")).otherwise(
        F.raise_error(F.lit("predictions do not hold every zone and hour once")))
    return cells.select(*keys, value.alias("predicted"))


def batch_predictions(
    actuals: DataFrame,
    scaler: DataFrame,
    predictor: Predictor,
    model_version: str,
    lags: Sequence[int] = DEFAULT_LAGS,
    horizon: int = 1,
    checked: bool = False,
) -> DataFrame:
    """Score every hour that has its lags. The zones are those of the scaler: others are
    dropped, missing ones are zero. Negative predictions are kept. ``checked`` holds the
    predictor to the cells it was asked for (:func:`complete`)."""
    panel = full_panel(conform(actuals, HOURLY_DEMAND), scaler.select(ZONE))
    samples = lag_features(scale(panel, scaler), lags, horizon)
    predicted = complete(predictor(samples), samples) if checked else predictor(samples)
    demand = unscale(predicted, scaler, "predicted")
    return conform(demand.select(
        (F.col("target_timestamp") - hours(horizon)).alias("forecast_run_timestamp"),
        "target_timestamp", ZONE, F.col("predicted").alias("predicted_demand"),
        F.lit(model_version).alias("model_version")), PREDICTIONS)


def next_hour_prediction(
    actuals: DataFrame,
    predictions: DataFrame,
    scaler: DataFrame,
    predictor: Predictor,
    model_version: str,
    lags: Sequence[int] = DEFAULT_LAGS,
    horizon: int = 1,
) -> DataFrame:
    """Score ``horizon`` hours after the latest actuals; no rows if that is stored already.

    ``actuals`` need only hold the last ``max(lags) + 1`` hours.
    """
    panel = full_panel(conform(actuals, HOURLY_DEMAND), scaler.select(ZONE))
    samples = inference_rows(scale(panel, scaler), lags, horizon)
    demand = unscale(complete(predictor(samples), samples), scaler, "predicted")
    rows = conform(demand.select(
        "forecast_run_timestamp", "target_timestamp", ZONE,
        F.col("predicted").alias("predicted_demand"), F.lit(model_version).alias("model_version")), PREDICTIONS)
    return without_existing(rows, predictions.filter(F.col("model_version") == model_version))


def require_history(actuals: DataFrame, lags: Sequence[int], horizon: int = 1) -> None:
    """Fail early unless at least one hour can be scored. Reads two values."""
    span = F.timestamp_diff("HOUR", F.min("hour"), F.max("hour")) + 1
    found = actuals.agg(span).first()[0]
    if found is None:
        raise ValueError("the actuals table holds no hours")
    needed = max(lags) + horizon
    if found < needed:
        raise ValueError(f"not enough history: {needed} hours needed, {found} found")


def run_batch(warehouse: Warehouse, scaler: DataFrame, predictor: Predictor, model_version: str,
              lags: Sequence[int] = DEFAULT_LAGS, horizon: int = 1) -> None:
    """Score the whole history, which is read once. If nothing came of it, the job fails, says why, and leaves the
    predictions as they were. (An observed count would not do: a plan found empty while it runs reports none.)"""
    actuals = warehouse.read("actuals")
    rows = batch_predictions(actuals, scaler, predictor, model_version, lags, horizon, checked=True)

    def some_rows(written: DataFrame) -> None:
        if written.isEmpty():
            require_history(actuals, lags, horizon)
            raise ValueError("no zone of the scaler could be scored")

    check_lags(lags, horizon)
    warehouse.replace("predictions", rows, some_rows)


def run_next_hour(warehouse: Warehouse, scaler: DataFrame, predictor: Predictor, model_version: str,
                  lags: Sequence[int] = DEFAULT_LAGS, horizon: int = 1) -> None:
    """Reads only the days the lags reach and the day of the target."""
    latest = require_latest_hour(warehouse.newest("actuals"))
    start, target = latest - timedelta(hours=max(lags)), latest + timedelta(hours=horizon)
    recent = latest_actuals(
        warehouse.read("actuals", (start.date(), latest.date())), max(lags), latest)
    stored = warehouse.read("predictions", (target.date(), target.date()))
    warehouse.append("predictions", next_hour_prediction(
        recent, stored, scaler, predictor, model_version, lags, horizon))

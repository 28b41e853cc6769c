"""Predictions against actuals: the error table and its metric tables and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.errors import error_metrics
from zonecast.schemas import ERRORS, ZONE
from zonecast.session import stored


def prediction_errors(predictions: DataFrame, actuals: DataFrame, dense: bool = False) -> DataFrame:
    """Error rows of every predicted cell that has an actual.

    Actuals are sparse, so hours without demand have no row here; pass a panel, as ``dense``, to
    keep them. The key is one cell, so no key is hot whatever the demand of its zone. Both sides are
    cells, and Spark underestimates a dense panel, so neither is ever broadcast. Sparse actuals, the smaller side, are
    hashed per partition, so that the predictions need no sort; a panel is as large as they are and is merged.
    """
    truth = actuals.select(
        F.col("hour").alias("target_timestamp"), F.col(ZONE).cast("string").alias(ZONE),
        F.col("demand").cast("double").alias("actual_demand"))
    miss = F.col("predicted_demand") - F.col("actual_demand")
    joined = predictions.join(truth.hint("merge" if dense else "shuffle_hash"), ["target_timestamp", ZONE])
    return joined.select(
        "forecast_run_timestamp", "target_timestamp", ZONE, "actual_demand", "predicted_demand",
        "model_version", miss.alias("raw_error"), F.abs(miss).alias("absolute_error"),
        (miss * miss).alias("squared_error")).select(*ERRORS.fieldNames())


def metrics_by_hour(errors: DataFrame) -> DataFrame:
    return errors.groupBy("model_version", "target_timestamp").agg(*error_metrics("num_zones"))


def metrics_by_day(errors: DataFrame) -> DataFrame:
    return errors.groupBy(
        "model_version", F.to_date("target_timestamp").alias("target_date")).agg(*error_metrics())


def metrics_by_zone(errors: DataFrame) -> DataFrame:
    return errors.groupBy("model_version", ZONE).agg(
        *error_metrics(), F.avg("actual_demand").alias("average_actual_demand"))


def metrics_overall(errors: DataFrame) -> DataFrame:
    return errors.groupBy("model_version").agg(
        *error_metrics(),
        F.avg("actual_demand").alias("avg_actual_demand"),
        F.avg("predicted_demand").alias("avg_predicted_demand"),
        F.avg("raw_error").alias("mean_error"),
    ).select(
        "model_version", "num_predictions", "avg_actual_demand", "avg_predicted_demand", "mean_error",
        "mae", "rmse", "mape_excluding_zero_actuals")


def latest_rolling(rolling: DataFrame) -> DataFrame:
    """The newest window of each model."""
    newest = Window.partitionBy("model_version").orderBy(F.desc("window_end_timestamp"))
    return rolling.withColumn("rank", F.row_number().over(newest)).filter("rank = 1").drop("rank")


def freshness(actuals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Latest actual hour and latest predicted hour, one row each."""
    return actuals.agg(F.lit("actuals").alias("source"), F.max("hour").alias("latest")).unionByName(
        predictions.agg(F.lit("predictions").alias("source"), F.max("target_timestamp").alias("latest")))


def missing_predictions(actuals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Actual cells a model never predicted. Models are those of the predictions table.

    The hours a model predicted are the bits of a number for each zone and day, made in the tasks that read the predictions, so that
    a row a day is shuffled. Stamps that are no whole hours keep a number for each time past the hour.
    """
    def placed(stamp: str) -> list[Column]:
        hour = F.date_trunc("hour", stamp)
        return [F.to_date(stamp).alias("day"), (F.unix_micros(stamp) - F.unix_micros(hour)).alias("past"), F.call_function("shiftleft", F.lit(1), F.hour(stamp)).alias("bit")]

    made = stored(predictions.select(F.col(ZONE).cast("string").alias(ZONE), "model_version", *placed("target_timestamp")).groupBy(
        ZONE, "model_version", "day", "past").agg(F.bit_or("bit").alias("made")), "made")
    cells = actuals.select(
        F.col("hour").alias("target_timestamp"), F.col(ZONE).cast("string").alias(ZONE), "demand", *placed("hour"))
    models = made.select(F.collect_set("model_version").alias("models")).scalar()
    wanted = cells.withColumn("model_version", F.explode(models))
    known = wanted.join(made, [ZONE, "model_version", "day", "past"], "left")
    return known.filter(F.coalesce(F.col("made").bitwiseAND(F.col("bit")), F.lit(0)) == 0).select(
        "target_timestamp", ZONE, "demand", "model_version")

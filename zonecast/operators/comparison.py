"""Two model versions on the cells both of them predicted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.schemas import ZONE

WEIGHT_STEPS = 12
"""A weight of more than that many has a probability of about 1e-10 and counts as that."""


def paired_cells(errors: DataFrame, one: str, two: str) -> DataFrame:
    """target_timestamp, zone and both versions' absolute and squared errors, of the cells both hold.

    One shuffle on the cell. Of several forecasts of a cell by a version the latest counts.
    """
    def latest(version: str, column: str) -> Column:
        mine = F.col("model_version") == version
        return F.max_by(F.when(mine, F.col(column)), F.when(mine, F.col("forecast_run_timestamp")))

    cells = errors.filter(F.col("model_version").isin(one, two)).groupBy("target_timestamp", ZONE).agg(
        *[latest(version, column).alias(f"{column}_{side}") for side, version in (("one", one), ("two", two)) for column in ("absolute_error", "squared_error")])
    return cells.filter(F.col("absolute_error_one").isNotNull() & F.col("absolute_error_two").isNotNull())


def poisson_weight(day: Column, replicate: Column, seed: int) -> Column:
    """A Poisson weight of mean 1 from a hash of day and replicate, the same in every run."""
    digits = F.substring(F.md5(F.concat_ws(":", day.cast("string"), replicate.cast("string"), F.lit(str(seed)))), 1, 13)
    u = F.conv(digits, 16, 10).cast("double") / float(1 << 52)
    probability, below, steps = 2.718281828459045 ** -1, 0.0, F.lit(0)
    for k in range(WEIGHT_STEPS):
        below += probability
        steps = steps + F.when(u >= below, 1).otherwise(0)
        probability /= k + 1
    return steps


def compare_versions(errors: DataFrame, one: str, two: str, replicates: int = 200, confidence: float = 0.95, seed: int = 1) -> DataFrame:
    """metric, n_cells, n_days, mean_one, mean_two, difference (one - two), lower, upper; a row for mae and one for mse.

    The interval comes from a Poisson bootstrap of days: hours of a day err together, so days are drawn, not cells. Cells are
    reduced to sums per day in one pass; only days are weighted again and again. No common cells give no rows.
    """
    cells = paired_cells(errors, one, two)
    metrics = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"{column}_one").alias("a"), F.col(f"{column}_two").alias("b"))
                        for name, column in (("mae", "absolute_error"), ("mse", "squared_error"))])
    days = cells.select(F.to_date("target_timestamp").alias("day"), F.inline(metrics)).groupBy("metric", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    weight = poisson_weight(F.col("day"), F.col("replicate"), seed)
    drawn = (days.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", weight)
             .groupBy("metric", "replicate").agg(F.try_divide(F.sum(F.col("w") * (F.col("a") - F.col("b"))), F.sum(F.col("w") * F.col("n"))).alias("difference")))
    tail = (1 - confidence) / 2
    bounds = drawn.groupBy("metric").agg(F.percentile("difference", F.lit(tail)).alias("lower"), F.percentile("difference", F.lit(1 - tail)).alias("upper"))
    total = days.groupBy("metric").agg(
        F.sum("n").alias("n_cells"), F.count(F.lit(1)).alias("n_days"), (F.sum("a") / F.sum("n")).alias("mean_one"), (F.sum("b") / F.sum("n")).alias("mean_two"))
    return total.join(bounds, "metric").select(
        "metric", "n_cells", "n_days", "mean_one", "mean_two", (F.col("mean_one") - F.col("mean_two")).alias("difference"), "lower", "upper")

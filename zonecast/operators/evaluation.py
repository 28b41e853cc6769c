"""Forecast quality on the raw scale: overall, per zone, and the best and worst zones.

Input rows are cells with ``zone``, ``predicted`` and ``actual``. MAPE is a percentage here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.errors import safe_ratio

# The report lists, in report order.
REPORT_LISTS = ("worst_rmse", "best_rmse", "worst_mae", "best_mae", "worst_mape", "best_mape")


def percent_error(mape_mode: str = "exclude", epsilon: float = 1e-8) -> Column:
    if mape_mode not in ("exclude", "epsilon"):
        raise ValueError(f"mape_mode is 'exclude' or 'epsilon', not {mape_mode!r}")
    if epsilon <= 0:
        raise ValueError("epsilon must be positive")
    miss, size = F.abs(F.col("predicted") - F.col("actual")), F.abs("actual")
    if mape_mode == "exclude":
        return safe_ratio(miss, size) * 100
    return miss / F.greatest(size, F.lit(float(epsilon))) * 100


def _measures(mape_mode: str, epsilon: float, prefix: str = "") -> list[Column]:
    miss = F.col("predicted") - F.col("actual")
    return [
        F.avg(F.abs(miss)).alias(f"{prefix}mae"),
        F.sqrt(F.avg(miss * miss)).alias(f"{prefix}rmse"),
        F.avg(percent_error(mape_mode, epsilon)).alias(f"{prefix}mape")]


def evaluate_overall(cells: DataFrame, mape_mode: str = "exclude", epsilon: float = 1e-8) -> DataFrame:
    return cells.agg(*_measures(mape_mode, epsilon, "overall_"))


def evaluate_per_zone(cells: DataFrame, mape_mode: str = "exclude", epsilon: float = 1e-8) -> DataFrame:
    return cells.groupBy("zone").agg(*_measures(mape_mode, epsilon))


def top_bottom_zones(per_zone: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best and worst zones of each measure, ties by zone, in one pass.

    A zone without a MAPE is left out of the MAPE lists only. Each zone becomes one row
    per list; the rank limit is applied in the map tasks before the shuffle, so a list
    never gathers more than ``k`` rows per task.
    """
    entries = []
    for name in REPORT_LISTS:
        direction, measure = name.split("_")
        key = F.col(measure) if direction == "best" else -F.col(measure)
        entries.append(F.struct(F.lit(name).alias("type"), key.alias("key")))
    ranked = (
        per_zone.select("*", F.explode(F.array(*entries)).alias("entry"))
        .select("zone", "mae", "rmse", "mape", "entry.type", "entry.key")
        .filter(F.col("key").isNotNull())
        .withColumn("rank", F.row_number().over(Window.partitionBy("type").orderBy("key", "zone"))))
    return ranked.filter(F.col("rank") <= k).drop("key")


def cells_from(
    predictions: DataFrame, targets: DataFrame, keys: Sequence[str], zone: str,
) -> DataFrame:
    """Pair predictions with targets. A cell on one side only fails the job."""
    left = predictions.select(*keys, F.col("predicted"), F.lit(True).alias("has_prediction"))
    right = targets.select(*keys, F.col("actual"), F.lit(True).alias("has_target"))
    paired = left.join(right, list(keys), "full")
    unmatched = F.col("has_prediction").isNull() | F.col("has_target").isNull()
    zone_column = F.when(unmatched, F.raise_error(F.lit("predictions and targets differ in their cells"))
                         ).otherwise(F.col(zone))
    return paired.select(
        *[F.col(k) for k in keys if k != zone], zone_column.alias("zone"), "predicted", "actual")

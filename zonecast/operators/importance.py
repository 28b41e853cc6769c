"""Feature importance of a set of per-zone models, from rows (target zone, feature, importance)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def importance_by_feature(rows: DataFrame) -> DataFrame:
    """Mean over the models, with the lag, source zone and type read from the feature name."""
    feature = F.col("feature")

    def part(pattern: str, group: int):
        return F.nullif(F.regexp_extract(feature, pattern, group), F.lit(""))

    # The patterns of feature names, and the labels of their types.
    return rows.groupBy("feature").agg(F.avg("importance").alias("importance")).select(
        "feature", "importance", part(r"(lag_\d+)", 1).alias("lag"), part(r"zone_(\d+)", 1).alias("zone"),
        F.when(feature.contains("lag_"), "spatial").otherwise("other").alias("type"))


def importance_by(features: DataFrame, part: str) -> DataFrame:
    """Sum per ``lag`` or ``zone``; features without one are left out."""
    return features.filter(F.col(part).isNotNull()).groupBy(part).agg(F.sum("importance").alias("importance"))


def importance_by_type(features: DataFrame) -> DataFrame:
    return features.groupBy("type").agg(
        F.sum("importance").alias("sum"), F.avg("importance").alias("mean"),
        F.count(F.lit(1)).alias("count"))

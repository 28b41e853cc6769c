"""Per-zone standardisation with population deviation; constant zones keep their units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.months import month_label
from zonecast.schemas import ZONE


def fit_scaler(train: DataFrame, value: str = "demand") -> DataFrame:
    constant = F.min(value) == F.max(value)
    return train.groupBy(ZONE).agg(
        F.avg(value).alias("mean"),
        F.when(constant, F.lit(1.0)).otherwise(F.stddev_pop(value)).alias("scale"))


def scale(panel: DataFrame, scaler: DataFrame, value: str = "demand") -> DataFrame:
    """Replace ``value`` by its standardised form. Joins on the zone, the panel's partitioning."""
    return _with_scaler(panel, scaler, value, (F.col(value) - F.col("mean")) / F.col("scale"))


def unscale(scaled: DataFrame, scaler: DataFrame, value: str = "demand") -> DataFrame:
    return _with_scaler(scaled, scaler, value, F.col(value) * F.col("scale") + F.col("mean"))


def _with_scaler(df, scaler, value, expression):
    # The size Spark estimates for a dense panel is that of its sparse rows, so the panel could be taken for the side to
    # broadcast. The scaler, one row per zone, is named as the build side; the panel stays where it is.
    columns = [expression.alias(value) if c == value else F.col(c) for c in df.columns]
    return df.join(scaler.select(ZONE, "mean", "scale").hint("shuffle_hash"), ZONE).select(*columns)


# --- scalers of a growing history --------------------------------------------------------

MOMENTS = f"{ZONE} int, n long, mean double, m2 double, least double, most double, first_hour timestamp, last_hour timestamp, ym string"
"""Moments of a zone's sparse cells in a month; ``m2`` is the sum of squared deviations from their mean."""


def month_moments(sparse: DataFrame) -> DataFrame:
    """The moments of every month and zone of sparse demand. A row of the result stands for all cells of a month."""
    value = F.coalesce(F.col("demand"), F.lit(0)).cast("double")
    return sparse.filter(F.col("hour").isNotNull()).groupBy(F.col(ZONE).cast("int").alias(ZONE), month_label(F.col("hour")).alias("ym")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(F.lit(1))).alias("m2"),
        F.min(value).alias("least"), F.max(value).alias("most"),
        F.min(F.col("hour").cast("timestamp")).alias("first_hour"), F.max(F.col("hour").cast("timestamp")).alias("last_hour")
    ).select(*[field.split()[0] for field in MOMENTS.split(", ")])


def add_months(sparse: DataFrame, folder: str) -> None:
    """Store the moments of the months of ``sparse``, each a whole month; those of other months stay as they are."""
    (month_moments(sparse).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ym").parquet(folder))


def read_moments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MOMENTS).parquet(folder)


def _merge(one: Column, two: Column) -> Column:
    """The moments of two disjoint sets of values together."""
    n = one["n"] + two["n"]
    apart = two["mean"] - one["mean"]
    return F.when(one["n"] == 0, two).when(two["n"] == 0, one).otherwise(F.struct(
        n.alias("n"), (one["mean"] + apart * two["n"] / n).alias("mean"),
        (one["m2"] + two["m2"] + apart * apart * one["n"] * two["n"] / n).alias("m2")))


def merged_scaler(moments: DataFrame) -> DataFrame:
    """The scaler :func:`fit_scaler` gives over the dense panel of all months, from their moments alone.

    A zone's months are merged in order; the hours of the whole span in which it has no cell are so many zeros, merged last. A
    group is the months of one zone.
    """
    span = moments.agg(F.struct(F.min("first_hour").alias("first"), F.max("last_hour").alias("last")).alias("span")).scalar()
    hours_in_all = (F.timestamp_diff("HOUR", span["first"], span["last"]) + 1).cast("long")
    part = F.struct("n", "mean", "m2")
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    by_zone = moments.groupBy(ZONE).agg(
        F.array_sort(F.collect_list(F.struct("ym", part.alias("part")))).alias("parts"), F.min("least").alias("least"), F.max("most").alias("most"))
    merged = by_zone.withColumn("seen", F.aggregate("parts", nothing, lambda so_far, month: _merge(so_far, month["part"])))
    zeros = hours_in_all - F.col("seen.n")
    whole = _merge(F.col("seen"), F.struct(zeros.alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")))
    constant = (F.col("least") == F.col("most")) & ((zeros == 0) | (F.col("least") == 0.0))
    return merged.withColumn("whole", whole).select(
        ZONE, F.col("whole.mean").alias("mean"), F.when(constant, F.lit(1.0)).otherwise(F.sqrt(F.col("whole.m2") / F.col("whole.n"))).alias("scale"))

"""Windows over whole hours by reference: every hour is stored once, and samples are cut out while they are read.

Hours are kept in blocks of consecutive ones, one row a block. A reader hands each block the few hours before and
behind it that its frames reach, so what is shuffled is the stored hours and those edges; a sample is a place in its
block and becomes an array of values only in the task that reads it on. Nothing is stored once per window.

An hour's first values are its labels, one per zone; calendar values follow. A block holds ``block_hours`` rows of
them, whatever the length of the history, and a reader's group that and the length of a frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators.sequences import WEEK


def store_hours(vectors: DataFrame, folder: str, block_hours: int = WEEK) -> None:
    """Store rows of ``hour_vectors`` (hour, labels, features, perhaps split), whose features begin with the labels."""
    if block_hours <= 0:
        raise ValueError("a block has a positive number of hours")
    index = F.floor(F.unix_timestamp("hour") / 3600)
    placed = vectors.select(
        *_split(vectors), F.floor(index / block_hours).alias("block"), F.size("labels").alias("n_labels"),
        F.struct(index.alias("index"), F.col("hour"), F.col("features").alias("values")).alias("cell"))
    blocks = placed.groupBy(*_split(vectors), "block").agg(
        F.sort_array(F.collect_list("cell")).alias("hours"), F.max("n_labels").alias("n_labels"))
    blocks.withColumn("width", F.lit(block_hours)).write.parquet(folder)


def flat_samples(spark: SparkSession, folder: str, input_len: int, horizon: int = 1) -> DataFrame:
    """The rows of ``flat_windows`` over the stored hours. A frame that lacks an hour is no sample."""
    back = input_len + horizon - 1
    at = F.col("at")
    return _cut(spark.read.parquet(folder), (input_len, horizon), back, 0, {
        "features": F.flatten(_values(at - back, input_len)), "labels": F.element_at(_labels(at, 1), 1)})


def sequence_samples(spark: SparkSession, folder: str, input_len: int = 24, output_len: int = 1) -> DataFrame:
    """The rows of ``sequence_windows`` over the stored hours. A frame that lacks an hour is no sample."""
    at = F.col("at")
    return _cut(spark.read.parquet(folder), (input_len, output_len), input_len, output_len - 1, {
        "x": _values(at - input_len, input_len), "y": _labels(at, output_len)})


def _split(df: DataFrame) -> list[str]:
    return ["split"] if "split" in df.columns else []


def _values(start: Column, count: int) -> Column:
    return F.transform(F.slice("hours", start + 1, F.lit(count)), lambda hour: hour["values"])


def _labels(start: Column, count: int) -> Column:
    return F.transform(_values(start, count), lambda values: F.slice(values, F.lit(1), F.col("n_labels")))


def _cut(blocks: DataFrame, lengths: tuple[int, int], back: int, ahead: int, columns: dict[str, Column]) -> DataFrame:
    """One row for each hour with all ``back`` hours before and ``ahead`` hours behind it in its split."""
    if min(lengths) <= 0:
        raise ValueError("lengths and horizon are positive numbers of hours")
    split = _split(blocks)
    first, width = F.col("block") * F.col("width"), F.col("width")
    home = F.col("home") * width
    reached = blocks.withColumn("home", F.explode(F.sequence(
        F.floor((first - ahead) / width), F.floor((first + width - 1 + back) / width))))
    edges = reached.withColumn("hours", F.filter(
        "hours", lambda hour: (hour["index"] >= home - back) & (hour["index"] < home + width + ahead)))
    groups = edges.filter(F.size("hours") > 0).groupBy(*split, "home", "width", "n_labels").agg(
        F.sort_array(F.flatten(F.collect_list("hours"))).alias("hours"))
    places = F.sequence(F.lit(back), F.size("hours") - 1 - ahead)
    cut = groups.filter(F.size("hours") > back + ahead).withColumn("at", F.explode(places))

    def index(at: Column) -> Column:
        return F.get("hours", at)["index"]

    at = F.col("at")
    whole = index(at + ahead) - index(at - back) == back + ahead
    own = (index(at) >= home) & (index(at) < home + width)
    return cut.filter(whole & own).select(
        *split, F.get("hours", at)["hour"].alias("target_timestamp"),
        *[column.alias(name) for name, column in columns.items()])

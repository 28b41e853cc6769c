"""Trips as a stream to hourly demand per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.schemas import HOURLY_DEMAND, ZONE


def hourly_demand_stream(trips: DataFrame, zones: DataFrame | None = None, license_num: str | None = None) -> DataFrame:
    """The hour and zone of every trip, whenever it arrives. ``zones`` is a table, not a stream."""
    if license_num is not None:
        trips = trips.filter(F.col("hvfhs_license_num") == license_num)
    if zones is not None:
        trips = trips.join(zones.select(ZONE), ZONE, "left_semi")
    hour = F.date_trunc("hour", F.col("request_datetime").cast("timestamp"))
    return trips.select(hour.alias("hour"), F.col(ZONE).cast("int").alias(ZONE)).dropna()


def run_demand_stream(trips: DataFrame, folder: str, checkpoint: str) -> None:
    """Count what is available, each batch on its own.

    A batch writes its counts to a folder of its own, so one that is run again replaces itself. No state is kept between
    batches and no trip is ever too late. Folder -1 is empty: a source without files leaves a readable table too."""
    def counts(batch: DataFrame) -> DataFrame:
        return batch.groupBy("hour", ZONE).agg(F.count(F.lit(1)).alias("demand"))

    empty = trips.sparkSession.createDataFrame([], trips.schema)
    counts(empty).write.mode("overwrite").parquet(f"{folder}/batch=-1")

    def store(batch: DataFrame, batch_id: int) -> None:
        counts(batch).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    query = (trips.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(store).start())
    query.awaitTermination()


def read_demand_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The sum of the batches' counts of every cell."""
    schema = HOURLY_DEMAND.fieldNames()
    stored = spark.read.schema(f"{schema[0]} timestamp, {schema[1]} int, {schema[2]} bigint, batch bigint")
    return stored.parquet(folder).groupBy("hour", ZONE).agg(F.sum("demand").alias("demand"))

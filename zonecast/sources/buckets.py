"""Predictions and actuals as bucketed tables, for rebuilds of the error table without a shuffle.

Both are dealt by hour and zone into the same number of buckets when they are loaded, once; each later join reads bucket
beside bucket. The key is one cell, so no zone makes a bucket large. A load is one file a bucket; later loads add files to the
buckets. Such a table has no folders by day: a job that needs some days reads the warehouse's tables. A bucket is written and read by one task,
so their number goes with the rows (:func:`buckets_for`) and both tables are loaded with the number for the larger one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators.monitoring import prediction_errors
from zonecast.schemas import PREDICTIONS, ZONE, conform


BUCKET_ROWS = 1 << 20
LEAST = 8


def buckets_for(rows: int) -> int:
    """A power of two, so that a table loaded with more or fewer still meets the other in whole buckets; at least ``LEAST``."""
    return max(LEAST, 1 << (max(rows - 1, 0) // BUCKET_ROWS).bit_length())


def _load(df: DataFrame, table: str, buckets: int, stamp: str, mode: str) -> None:
    placed = df.repartition(buckets, stamp, ZONE)  # by the hash of the buckets, so that each has one writer
    placed.write.mode(mode).format("parquet").bucketBy(buckets, stamp, ZONE).sortBy(stamp, ZONE).saveAsTable(table)


def load_predictions(df: DataFrame, table: str, buckets: int, mode: str = "overwrite") -> None:
    _load(conform(df, PREDICTIONS), table, buckets, "target_timestamp", mode)


def load_actuals(df: DataFrame, table: str, buckets: int, mode: str = "overwrite") -> None:
    """Zones are text here, as in the predictions: buckets of a number and of its text differ."""
    cells = df.select("hour", F.col(ZONE).cast("string").alias(ZONE), F.col("demand").cast("double").alias("demand"))
    _load(cells, table, buckets, "hour", mode)


def bucketed_errors(spark: SparkSession, predictions: str, actuals: str, dense: bool = False) -> DataFrame:
    """Error rows from two such tables. With different numbers of buckets the join is right and shuffles."""
    return prediction_errors(spark.table(predictions), spark.table(actuals), dense)

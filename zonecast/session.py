"""Session rules every job in the package relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the session zone: dates and hours of every table are UTC.

    Sparse rows are shuffled before they expand to all hours of their zone, so AQE must not
    pack a small shuffle into few tasks. Where shuffles are large the setting changes nothing.

    A task that writes a few partitions of a table keeps their files open instead of sorting all its rows by
    partition; beyond that many it sorts the rest.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster names in ``spark.checkpoint.dir``.

    All folders of an application share a parent, which can go when the application is over.

    Only a local session without that setting gets a temporary folder of its own;
    on a cluster a machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="zonecast-")
        spark.sparkContext.setCheckpointDir(base)
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/zonecast-{application}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, read back.

    For results several later steps read: they start from the table instead of running the
    whole plan again, also when executors are lost in between.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)

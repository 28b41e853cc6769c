"""SQL kept in files, with typed named parameters (``:target_timestamp``, ``:model_version``)."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from zonecast.functions.stamps import instant


def run_sql_file(
    spark: SparkSession, path: str, target_timestamp: datetime, model_version: str,
) -> DataFrame:
    return spark.sql(spark.read.text(path, wholetext=True).first()[0], args={
        "target_timestamp": instant(target_timestamp), "model_version": model_version})


def run_sql_script(spark: SparkSession, path: str, **parameters: Any) -> DataFrame:
    """Run a file of several statements and return the rows of its last query.

    The file is one statement or a block ``BEGIN ... END`` with variables, conditions and loops of SQL scripting. Parameters are
    named as in the file (``:name``) and keep their types: text, numbers, dates, stamps (UTC where they have no zone), or
    columns. A file name, like a table's, may be one: ``IDENTIFIER(:table)``.
    """
    return spark.sql(spark.read.text(path, wholetext=True).first()[0], args={
        name: instant(value) if isinstance(value, datetime) else value for name, value in parameters.items()})

"""Calendar months as ``YYYY-MM`` labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(ym: str) -> datetime:
    return datetime.strptime(ym, "%Y-%m")


def month_end(ym: str) -> datetime:
    """First instant after the month, for half-open ranges."""
    start = month_start(ym)
    return datetime(start.year + start.month // 12, start.month % 12 + 1, 1)


def months_between(first: str, last: str) -> list[str]:
    months, ym = [], first
    while month_start(ym) <= month_start(last):
        months.append(ym)
        ym = month_end(ym).strftime("%Y-%m")
    return months


def month_label(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM")


def in_months(df: DataFrame, column: str, first: str, last: str) -> Column:
    """``start <= column < end``. The bounds take the type of the column, not the other
    way round, so that the comparison reaches the parquet scan."""
    kind = df.schema[column].dataType
    stamp = F.col(column)
    return (stamp >= F.lit(month_start(first).isoformat(" ")).cast(kind)) & (
        stamp < F.lit(month_end(last).isoformat(" ")).cast(kind))


def month_list(df: DataFrame, column: str) -> DataFrame:
    """Every month from the first to the last stamp, months without rows included."""
    first, last = (F.trunc(f(column), "month") for f in (F.min, F.max))
    months = df.agg(F.sequence(first, last, F.expr("interval 1 month")).alias("months"))
    return months.select(F.explode("months").alias("month")).select(
        F.date_format("month", "yyyy-MM").alias("year_month"))

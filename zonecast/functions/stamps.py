"""Hours and instants. A datetime without zone is UTC wherever the driver runs."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def instant(stamp: datetime) -> Column:
    """A timestamp literal."""
    return F.lit(stamp if stamp.tzinfo else stamp.replace(tzinfo=UTC))

"""Error measures shared by the monitoring tables and the evaluation reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Null instead of an error where the denominator is zero."""
    denominator = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(numerator, F.nullif(denominator, F.lit(0.0)))


def error_metrics(count_name: str = "num_predictions") -> list[Column]:
    """Count, MAE, RMSE and MAPE (a fraction, over non-zero actuals) of error rows."""
    return [
        F.count(F.lit(1)).alias(count_name),
        F.avg("absolute_error").alias("mae"),
        F.sqrt(F.avg("squared_error")).alias("rmse"),
        F.avg(safe_ratio("absolute_error", "actual_demand")).alias("mape_excluding_zero_actuals"),
    ]


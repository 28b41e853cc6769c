"""Table layouts. Frames are projected and cast to these by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONE = "PULocationID"


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_STAMP, _INT, _LONG, _TEXT, _REAL, _DATE = (
    T.TimestampType(), T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.DateType(),
)
_METRICS = (("mae", _REAL), ("rmse", _REAL), ("mape_excluding_zero_actuals", _REAL))

TRIPS = _table(("hvfhs_license_num", _TEXT), ("request_datetime", _STAMP), (ZONE, _INT))
ZONE_LOOKUP = _table(("LocationID", _INT), ("Borough", _TEXT))
HOURLY_DEMAND = _table(("hour", _STAMP), (ZONE, _INT), ("demand", _REAL))
ACTUALS = _table(("hour", _STAMP), (ZONE, _TEXT), ("demand", _REAL))
PREDICTIONS = _table(
    ("forecast_run_timestamp", _STAMP), ("target_timestamp", _STAMP), (ZONE, _TEXT),
    ("predicted_demand", _REAL), ("model_version", _TEXT),
)
ERRORS = _table(
    ("forecast_run_timestamp", _STAMP), ("target_timestamp", _STAMP), (ZONE, _TEXT),
    ("actual_demand", _REAL), ("predicted_demand", _REAL), ("model_version", _TEXT),
    ("raw_error", _REAL), ("absolute_error", _REAL), ("squared_error", _REAL),
)
HOUR_METRICS = _table(
    ("model_version", _TEXT), ("target_timestamp", _STAMP), ("num_zones", _LONG), *_METRICS)
DAY_METRICS = _table(
    ("model_version", _TEXT), ("target_date", _DATE), ("num_predictions", _LONG), *_METRICS)
ROLLING = _table(
    ("metric_date", _DATE), ("window_start_timestamp", _STAMP), ("window_end_timestamp", _STAMP),
    ("model_version", _TEXT), ("num_predictions", _LONG), *_METRICS)
ROLLING_BY_ZONE = _table(
    ("metric_date", _DATE), (ZONE, _TEXT), ("window_start_timestamp", _STAMP),
    ("window_end_timestamp", _STAMP), ("model_version", _TEXT), ("num_predictions", _LONG), *_METRICS)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to a table layout, by name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

"""Rolling seven days kept up to date by a stream of errors: daily sums as state, windows as rows of an append-only table.

Models and zones are dealt into slots; a slot keeps the sums of the recent days of each and a timer at the next midnight. When the
watermark has passed a day, the windows that end with it come out; nothing is read again for them. Errors of a day that is over, in any
order, give the windows they belong to once more with a higher ``revision``, as long as the day lies no more than ``lateness`` days behind
the last one that is over. What is older comes out as a ``late`` row with its sums, so windows and late rows hold all errors. The
state of a model and zone is at most ``lateness`` + 7 days and those ahead of the watermark; a silent one is removed.

:func:`rolling_of_stream` and :func:`rolling_by_zone_of_stream` read the newest revisions. A day's windows are complete or not,
as in the hourly cycle: those of every day that is over, if the seven days hold any error of the model (and zone).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from zonecast.functions.errors import safe_ratio
from zonecast.functions.stamps import hours
from zonecast.operators.rolling import DAYS, LAST_HOUR, whole_hour
from zonecast.schemas import ROLLING, ROLLING_BY_ZONE, ZONE
from zonecast.streaming.event_time import SLOTS, packed_table, unpacked_table

WINDOW, LATE = "window", "late"
DAY_MS = 86_400_000
_SUMS = ("n", "sum_abs", "sum_sq", "sum_ratio", "n_ratio")
_DAILY = "slot int, model_version string, PULocationID string, day int, n long, sum_abs double, sum_sq double, sum_ratio double, n_ratio long, seen timestamp"
ROWS = "kind string, model_version string, PULocationID string, day int, revision long, n long, sum_abs double, sum_sq double, sum_ratio double, n_ratio long"
"""``day`` counts from 1970-01-01: the last day of a window, or the day of late errors."""
_STATE = "cells binary, closed int, revision long"
_CELLS = pa.schema([
    ("model_version", pa.string()), (ZONE, pa.string()), ("day", pa.int32()), ("n", pa.int64()), ("sum_abs", pa.float64()), ("sum_sq", pa.float64()),
    ("sum_ratio", pa.float64()), ("n_ratio", pa.int64())])


def _sums_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums per model, zone and day, and one row without a slot that carries its latest stamp.

    Only that row has an event time, so the watermark moves and yet no summed row is dropped for being behind it.
    """
    schema = pa.schema([("slot", pa.int32()), *_CELLS, ("seen", pa.timestamp("us", "UTC"))])
    latest = None
    for batch in batches:
        if batch.num_rows:
            top = pc.max(batch.column("stamp")).as_py()
            latest = top if latest is None else max(latest, top)
            keys = ["slot", "model_version", ZONE, "day"]
            summed = pa.Table.from_batches([batch]).group_by(keys).aggregate([
                ([], "count_all"), ("absolute_error", "sum"), ("squared_error", "sum"), ("ratio", "sum"), ("ratio", "count")])
            columns = [summed.column(c) for c in (*keys, "count_all", "absolute_error_sum", "squared_error_sum")]
            columns += [pc.fill_null(summed.column("ratio_sum"), 0.0), summed.column("ratio_count"), pa.nulls(summed.num_rows, schema.field("seen").type)]
            yield from pa.Table.from_arrays(columns, names=schema.names).cast(schema).to_batches()
    if latest is not None:
        yield pa.RecordBatch.from_pylist([{"n": 0, "seen": latest}], schema)


def _summed(cells: pa.Table, *marks: str) -> pa.Table:
    """Sums by model, zone and day, and the largest of the marks."""
    keys = ["model_version", ZONE, "day"]
    total = cells.group_by(keys).aggregate([*[(c, "sum") for c in _SUMS], *[(mark, "max") for mark in marks]])
    return total.rename_columns([*keys, *_SUMS, *marks])


def _windows(cells: pa.Table, before: int, closed: int) -> pa.Table:
    """The windows that are over and due: those since ``before``, and those with a changed day."""
    every = cells.take(pa.array(np.repeat(np.arange(cells.num_rows), DAYS)))
    last = pc.add(every.column("day"), pa.array(np.tile(np.arange(DAYS, dtype=np.int32), cells.num_rows)))
    every = every.set_column(2, "day", last).filter(pc.less_equal(last, closed))
    total = _summed(every, "changed")
    return total.filter(pc.or_(pc.greater(total.column("day"), before), pc.equal(total.column("changed"), 1))).drop_columns("changed")


def _keep_days(lateness: int) -> Callable:
    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if pd.isna(key[0]):
            return  # the rows that carry the time
        held, before, revision = state.get if state.exists else (None, -1, 0)
        held = _CELLS.empty_table() if held is None else unpacked_table(held)
        closed = state.getCurrentWatermarkMs() // DAY_MS - 1  # the last day that is over
        arrived = [] if state.hasTimedOut else [pa.Table.from_pandas(frame[_CELLS.names], _CELLS, preserve_index=False) for frame in frames]
        new = pa.concat_tables([_CELLS.empty_table(), *arrived])
        in_time = pc.greater_equal(new.column("day"), closed - lateness)
        marked = [part.append_column("changed", pa.array(np.full(part.num_rows, mark, np.int8))) for mark, part in enumerate((held, new.filter(in_time)))]
        cells = _summed(pa.concat_tables(marked), "changed")
        for kind, number, rows in ((LATE, 0, new.filter(pc.invert(in_time))), (WINDOW, revision + 1, _windows(cells, before, closed))):
            if rows.num_rows:
                frame = rows.to_pandas()
                frame.insert(0, "kind", kind)
                frame.insert(4, "revision", np.int64(number))
                yield frame
        kept = cells.filter(pc.greater(cells.column("day"), closed - lateness - DAYS))
        if kept.num_rows:
            state.update((packed_table(kept.select(_CELLS.names).cast(_CELLS)), closed, revision + 1))
            state.setTimeoutTimestamp((closed + 2) * DAY_MS - 1)  # a timer fires when the watermark is beyond it: the next day is over
        elif state.exists:
            state.remove()
    return keep


def rolling_rows(errors: DataFrame, lateness: int = 7, delay: str = "1 hour", slots: int = SLOTS) -> DataFrame:
    """``ROWS`` of a stream of errors (in the layout of the error table); append output. Rows without stamp or model are left out.

    Errors are summed per day in their task before they are shuffled, so a zone or model with a third of them sends a row per day and task.
    The number of groups, each a call of Python, is that of ``slots``, however many zones there are.
    """
    stamp = whole_hour(F.col("target_timestamp"))
    cells = errors.filter(F.col("target_timestamp").isNotNull() & F.col("model_version").isNotNull()).select(
        F.pmod(F.hash("model_version", F.col(ZONE).cast("string")), F.lit(slots)).alias("slot"), "model_version", F.col(ZONE).cast("string").alias(ZONE), F.unix_date(F.to_date(stamp)).alias("day"), F.col("target_timestamp").alias("stamp"),
        "absolute_error", "squared_error", safe_ratio("absolute_error", "actual_demand").alias("ratio"))
    daily = cells.mapInArrow(_sums_in_task, _DAILY)
    return daily.withWatermark("seen", delay).groupBy("slot").applyInPandasWithState(
        _keep_days(lateness), ROWS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _newest_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The sums of each window by its newest revision."""
    rows = spark.read.schema(ROWS).parquet(folder).filter(F.col("kind") == WINDOW)
    newest = rows.groupBy("model_version", ZONE, "day").agg(F.max_by(F.struct(*_SUMS), "revision").alias("sums"))
    return newest.select("model_version", ZONE, "day", "sums.*")


def _metrics(windows: DataFrame) -> DataFrame:
    day = F.date_from_unix_date("day")
    start = F.date_sub(day, DAYS - 1).cast("timestamp")
    return windows.select(
        "*", day.alias("metric_date"), start.alias("window_start_timestamp"), (start + hours(LAST_HOUR)).alias("window_end_timestamp"),
        F.col("n").alias("num_predictions"), (F.col("sum_abs") / F.col("n")).alias("mae"), F.sqrt(F.col("sum_sq") / F.col("n")).alias("rmse"),
        safe_ratio("sum_ratio", F.col("n_ratio").cast("double")).alias("mape_excluding_zero_actuals"))


def rolling_by_zone_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics(_newest_windows(spark, folder)).select(*ROLLING_BY_ZONE.fieldNames())


def rolling_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All zones of a model: the sums of their windows, so that no group of the stream holds a whole model."""
    total = _newest_windows(spark, folder).groupBy("model_version", "day").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return _metrics(total).select(*ROLLING.fieldNames())


def late_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Model, zone, day and number of the errors that came too late for any window."""
    rows = spark.read.schema(ROWS).parquet(folder).filter(F.col("kind") == LATE)
    return rows.groupBy("model_version", ZONE, F.date_from_unix_date("day").alias("target_date")).agg(F.sum("n").alias("late"))

"""Trips as a stream by event time: closed hours through the state store, and late trips beside them.

Two jobs. :func:`closed_hours` is Spark's own window aggregate behind a watermark: an hour comes out once, when the
watermark has passed its end, and trips that arrive later are dropped. :func:`hours_and_late_trips` keeps those: zones
are dealt into slots, each with the counts of its open hours as state and a timer at the end of the earliest; what comes
after the end of its hour is a ``late`` row, so closed and late counts add up to all trips of the hours that are over.

Both restart from their checkpoint and write each row once. The state holds the open hours only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from zonecast.schemas import ZONE

CLOSED, LATE = "closed", "late"
HOUR_MS = 3_600_000
SLOTS = 256
"""Groups the zones are dealt into by hash. A checkpoint holds for the number it was begun with."""
_COUNTED = pa.schema([("slot", pa.int32()), ("hour", pa.int64()), (ZONE, pa.int32()), ("demand", pa.int64()), ("seen", pa.timestamp("us", "UTC"))])
_CELLS = pa.schema([("hour", pa.int64()), (ZONE, pa.int32()), ("demand", pa.int64())])


def timed_trips(trips: DataFrame, zones: DataFrame | None = None, license_num: str | None = None) -> DataFrame:
    """Stamp and zone of every trip that has both. ``zones`` is a table, not a stream."""
    if license_num is not None:
        trips = trips.filter(F.col("hvfhs_license_num") == license_num)
    if zones is not None:
        trips = trips.join(zones.select(ZONE), ZONE, "left_semi")
    return trips.select(F.col("request_datetime").cast("timestamp").alias("request_datetime"), F.col(ZONE).cast("int").alias(ZONE)).dropna()


def closed_hours(trips: DataFrame, delay: str = "1 hour") -> DataFrame:
    """hour, zone, demand of the hours the watermark has passed; append output."""
    counted = (trips.withWatermark("request_datetime", delay)
               .groupBy(F.window("request_datetime", "1 hour"), ZONE).agg(F.count(F.lit(1)).alias("demand")))
    return counted.select(F.col("window.start").alias("hour"), ZONE, "demand")


def _count_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's trips per hour and zone, and one row without a slot that carries its latest stamp.

    Only that row has an event time, so that the watermark moves and yet no counted row is ever dropped for being behind it.
    """
    latest = None
    for batch in batches:
        if batch.num_rows:
            top = pc.max(batch.column("request_datetime")).cast(pa.timestamp("us", "UTC"))
            latest = top if latest is None else max(latest, top, key=lambda x: x.value)
            keys = ["slot", "hour", ZONE]
            counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")]).rename_columns([*keys, "demand"])
            yield from counted.append_column("seen", pa.nulls(counted.num_rows, _COUNTED.field("seen").type)).cast(_COUNTED).to_batches()
    if latest is not None:
        yield pa.RecordBatch.from_pylist([{"demand": 0, "seen": latest.as_py()}], _COUNTED)


def packed_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all()


def _summed(tables: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(tables).group_by(["hour", ZONE]).aggregate([("demand", "sum")])
    return total.rename_columns(["hour", ZONE, "demand"]).cast(_CELLS)


def _keep_counts(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A slot's open cells are its state, with a timer at the end of the earliest hour. All its hours that are over come out in one frame."""
    if pd.isna(key[0]):
        return  # the rows that carry the time
    watermark = state.getCurrentWatermarkMs()

    def over(cells: pa.Table) -> pa.ChunkedArray:
        return pc.less_equal(pc.add(cells.column("hour"), HOUR_MS), watermark)

    held = unpacked_table(state.get[0]) if state.exists else _CELLS.empty_table()
    arrived = [] if state.hasTimedOut else [pa.Table.from_pandas(frame[_CELLS.names], _CELLS, preserve_index=False) for frame in frames]
    new = _summed([_CELLS.empty_table(), *arrived])
    for kind, cells in ((CLOSED, held.filter(over(held))), (LATE, new.filter(over(new)))):
        if cells.num_rows:
            rows = cells.to_pandas()
            rows.insert(0, "kind", kind)
            yield rows
    cells = _summed([part.filter(pc.invert(over(part))) for part in (held, new)])
    if cells.num_rows:
        state.update((packed_table(cells),))
        state.setTimeoutTimestamp(pc.min(cells.column("hour")).as_py() + HOUR_MS - 1)  # a timer fires when the watermark is beyond it
    elif state.exists:
        state.remove()


def hours_and_late_trips(trips: DataFrame, delay: str = "1 hour", slots: int = SLOTS) -> DataFrame:
    """kind (``closed`` or ``late``), hour, zone, demand; append output. A late row counts the trips of one batch.

    Trips are counted in their task before they are shuffled, so a zone with a third of them sends one row a task. The number of
    groups, each a call of Python, is that of ``slots``, however many cells there are; a slot's state is its zones' open cells.
    """
    cells = trips.select(
        F.pmod(F.hash(ZONE), F.lit(slots)).alias("slot"), F.unix_millis(F.date_trunc("hour", "request_datetime")).alias("hour"), ZONE, "request_datetime")
    counted = cells.mapInArrow(_count_in_task, f"slot int, hour long, {ZONE} int, demand long, seen timestamp")
    rows = counted.withWatermark("seen", delay).groupBy("slot").applyInPandasWithState(
        _keep_counts, f"kind string, hour long, {ZONE} int, demand long", "cells binary", "append", GroupStateTimeout.EventTimeTimeout)
    return rows.withColumn("hour", F.timestamp_millis("hour"))


def run_to_table(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append what is available to a Parquet table, each row once also after a restart, and return the ended query."""
    query = (rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query

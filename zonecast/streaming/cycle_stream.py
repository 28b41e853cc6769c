"""Hourly actuals as a stream into the monitoring tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from zonecast.plans.cycle import apply_actuals
from zonecast.sources.tables import Warehouse


def run_cycle_stream(
    demand: DataFrame, warehouse: Warehouse, checkpoint: str, model_version: str | None = None,
) -> None:
    """Apply the cells of every batch, in any order and with hours cut over batches. A replayed batch changes
    nothing; a late cell is inserted, and the hour, day and rolling rows it belongs to are computed anew."""
    def apply(batch: DataFrame, _: int) -> None:
        apply_actuals(warehouse, batch, model_version, in_parts=True)

    query = (demand.writeStream.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(apply).start())
    query.awaitTermination()

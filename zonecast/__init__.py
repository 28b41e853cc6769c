"""zonecast: hourly demand panels, forecasts and forecast monitoring as Spark jobs."""

from zonecast.session import prepare_session, shared_folder

__all__ = ["prepare_session", "shared_folder"]

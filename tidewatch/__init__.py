"""Service-event analytics on Spark: incident detection, dashboards, metrics and reports."""

from tidewatch.settings import Settings

__all__ = ["Settings"]

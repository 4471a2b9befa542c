"""Metric-series analytics on Spark: quality checks, features, detectors, models and live scoring."""

from metricloom.series import Series, series_view

__all__ = ["Series", "series_view"]

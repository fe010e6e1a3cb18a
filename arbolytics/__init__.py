"""Sensor, weather and plant-trait analytics expressed as Spark plans."""

from arbolytics.session import build_session, stage

__all__ = ["build_session", "stage"]

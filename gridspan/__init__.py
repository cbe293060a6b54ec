"""Spark-native engine for fleets of hourly load series."""

from .session import build_session
from .spec import GOLD, PANEL, PanelSpec, SchemaError

__all__ = ["GOLD", "PANEL", "PanelSpec", "SchemaError", "build_session"]

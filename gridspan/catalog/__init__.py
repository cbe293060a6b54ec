"""All registered queries."""

from . import build, clean, evaluate, features, forecast, joins, stats, time_grid  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

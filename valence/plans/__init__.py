"""All registered queries."""

from . import ingest, learning, reporting, scoring, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

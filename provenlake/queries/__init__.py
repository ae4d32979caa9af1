"""Registered queries over the driver tables, each beside its SQL statement."""

from . import artifacts, evaluation, facts, gates, references, semantics  # noqa: F401
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Registered queries over the supplied tables, each with its DuckDB counterpart where SQL can say it."""

from . import cleaning, evidence, metrics, modelling, profiles, rating, sampling, scalars, synthesis  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

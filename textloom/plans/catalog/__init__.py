"""Registered queries, each with an equivalent SQL statement where SQL can say it."""

from textloom.plans.catalog import (  # noqa: F401
    answers,
    datasets,
    encoding,
    files,
    normalise,
    pretraining,
    runs,
    scored,
    tables,
    windows,
)
from textloom.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Queries over the given tables, each with the SQL that must give the same result."""

from . import cells, clinical, cohorts, genes, inspection, profiles, scans, sources  # noqa: F401
from .registry import QUERIES, Tables  # noqa: F401

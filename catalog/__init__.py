"""Registered queries over the given tables, each with its SQL twin where SQL can express it."""

from catalog import extracts, files, modelling, quality, relational, scalars, series  # noqa: F401
from catalog.base import ORACLE_SQL, QUERIES  # noqa: F401

"""The registered queries, each next to the SQL it is checked against."""

from . import edits, feed, files, nested, rank, ratings, streams, words  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

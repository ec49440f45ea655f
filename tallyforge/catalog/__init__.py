"""Every query by name."""

from . import extended, files, functions, quality, stored, summaries
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

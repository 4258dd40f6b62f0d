"""The registered queries over the library's operators, and the SQL that states the same results."""

from __future__ import annotations

from . import audits, dedup, generation, judged, lineage, matrix, reports, runs, stages, text, vectors  # noqa: F401  the modules register their queries
from .registry import ORACLE_SQL, QUERIES

FLAGSHIP = "kept_corpus"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]

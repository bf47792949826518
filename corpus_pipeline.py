"""A corpus pipeline of five stages over ``documents``."""

from __future__ import annotations

from sitecorpus.llm.pipeline import STAGES, run

ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]

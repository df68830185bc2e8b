"""Derived tables and reports as queries over the star-schema tables, each with its SQL."""

from __future__ import annotations

import importlib

MODULES = ("catalogue", "merges", "cohorts", "joining", "statistics", "textual", "quality_gates", "monitoring", "bookkeeping", "scoring", "matching", "incidents", "networks", "facts", "feeds", "suites", "judging", "reading", "naming", "running", "verdicts")


def _all(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(importlib.import_module(f"tidewatch.plans.{m}"), name)
    return out


def queries() -> dict:
    """(spark, sf_dir) -> DataFrame by name."""
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("ORACLE_SQL")

"""Registered queries and their SQL."""

from __future__ import annotations


def _modules():
    from . import details, legacy, motion, reports, scoring

    return [motion, scoring, legacy, reports, details]


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in m.SQL.items()}


def flagship(spark, sf_dir):
    """Frames to one measured row per episode."""
    return queries()["measure_episode"](spark, sf_dir)

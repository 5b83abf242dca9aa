"""Review order and output projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from content_signals.constants import ORD, PROMPTS_COLUMNS, READY_COLUMNS


def _review_order() -> list:
    return [F.desc("blended_priority_score"), F.desc("priority_score"), F.asc(ORD)]


def rank_for_review(df: DataFrame) -> DataFrame:
    """Sort by blended, then automatic score, best first; ties in input order.

    ``_ord`` as last sort key also splits a score that many rows share over
    range partitions. Without a blended score the table is returned as it is.
    """
    return df.orderBy(*_review_order()) if "blended_priority_score" in df.columns else df


def top_n_for_review(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows in review order; each task keeps ``n`` rows, nothing is sorted whole."""
    return rank_for_review(df).limit(n)


def _project(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[c for c in names if c in df.columns])


def ready_projection(df: DataFrame) -> DataFrame:
    """The review columns in fixed order; absent ones are skipped."""
    return _project(df, READY_COLUMNS)


def prompts_projection(df: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The review columns, prompt and payload in fixed order; absent ones are skipped.

    ``carry`` names further columns to keep, such as the order.
    """
    return _project(df, [*PROMPTS_COLUMNS, *(carry or [])])

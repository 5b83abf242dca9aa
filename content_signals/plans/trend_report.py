"""From raw sources to trend scores and levels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from content_signals.constants import REQUIRED_SOURCE_COLUMNS
from content_signals.operators.sinks import write_csv
from content_signals.operators.trends import HOT_KEYWORDS, priority_level, trend_score


def trend_report(sources: DataFrame, as_of: datetime, hot_keywords: int = HOT_KEYWORDS) -> DataFrame:
    """Sub-scores, trend score and level of every raw row; not sorted."""
    missing = [c for c in REQUIRED_SOURCE_COLUMNS if c not in sources.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return priority_level(trend_score(sources, as_of, hot_keywords))


def run_trend_scoring(sources: DataFrame, as_of: datetime, path: str) -> str:
    """Score and write as CSV."""
    return write_csv(trend_report(sources, as_of), path)

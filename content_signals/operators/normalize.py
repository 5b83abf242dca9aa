"""Canonical text columns of a source table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from content_signals.constants import TEXT_DEFAULTS, URL_COLUMNS
from content_signals.functions.text import text_or, trim_ws


def resolve_content_url(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``content_url`` from the first existing column of source_url, link, url.

    ``strict`` also raises when every row is blank, at the price of a small job.
    """
    source = next((c for c in URL_COLUMNS if c in df.columns), None)
    if source is None:
        raise ValueError(f"no URL column: one of {URL_COLUMNS} is needed")
    out = df.withColumn("content_url", trim_ws(F.coalesce(F.col(source).cast("string"), F.lit(""))))
    if strict and out.filter(F.col("content_url") != "").isEmpty():
        raise ValueError("content_url is blank on every row")
    return out


def normalize_text(df: DataFrame) -> DataFrame:
    """Strip the text columns, fill blanks with defaults, fix the letter case."""
    cleaned = {
        c: text_or(F.col(c).cast("string") if c in df.columns else F.lit(default), default)
        for c, default in TEXT_DEFAULTS.items()
    }
    for c in ("niche", "lang", "rights"):
        cleaned[c] = F.upper(cleaned[c])
    cleaned["usage_strategy"] = F.lower(cleaned["usage_strategy"])
    return df.withColumns(cleaned)


def derive_raw_text(df: DataFrame, draft: bool = False) -> DataFrame:
    """Add ``source_url`` and ``raw_text`` where absent.

    ``draft`` writes the platform into ``raw_text`` instead of the URL.
    """
    added = {}
    if "source_url" not in df.columns:
        added["source_url"] = F.col("content_url")
    if "raw_text" not in df.columns:
        if draft:
            platform = F.col("origin_platform") if "origin_platform" in df.columns else F.lit("UNKNOWN")
            added["raw_text"] = F.concat(F.lit("Source: "), platform.cast("string"))
        else:
            added["raw_text"] = F.concat(F.lit("Source from "), F.col("content_url"))
    return df.withColumns(added) if added else df


def normalize(df: DataFrame, strict: bool = False) -> DataFrame:
    """URL, text columns and raw text in one go."""
    return derive_raw_text(normalize_text(resolve_content_url(df, strict)))

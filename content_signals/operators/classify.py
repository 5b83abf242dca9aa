"""Enumerations, scores and status of a source row, all as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import (
    NICHE_WORDS,
    PLATFORM_MARKS,
    PREFERRED_LANG,
    PREFERRED_NICHES,
    RIGHTS,
    STRATEGIES,
)
from content_signals.functions.text import first_match, plain_number, trim_ws


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def infer_platform(df: DataFrame) -> DataFrame:
    """``origin_platform``: the given one in upper case, else told from the URL."""
    given = F.nullif(F.upper(trim_ws(_text(df, "origin_platform"))), F.lit(""))
    told = first_match(F.lower(_text(df, "content_url")), PLATFORM_MARKS, "OTHER")
    return df.withColumn("origin_platform", F.coalesce(given, told))


def normalize_rights(df: DataFrame) -> DataFrame:
    """``rights``: one of the four known values, else REWRITE_REQUIRED."""
    value = F.upper(trim_ws(_text(df, "rights")))
    return df.withColumn("rights", F.when(value.isin(RIGHTS), value).otherwise("REWRITE_REQUIRED"))


def normalize_strategy(df: DataFrame) -> DataFrame:
    """``usage_strategy``: one of the three known values, else viral."""
    value = F.lower(trim_ws(_text(df, "usage_strategy")))
    return df.withColumn(
        "usage_strategy", F.when(value.isin(STRATEGIES), value).otherwise("viral")
    )


def infer_niche(
    df: DataFrame, rules: list[tuple[str, list[str]]] | None = None, default: str = "MOTIVATION"
) -> DataFrame:
    """``niche``: the given one in upper case, else the first rule ``raw_text`` meets."""
    given = F.nullif(F.upper(trim_ws(_text(df, "niche"))), F.lit(""))
    told = first_match(F.lower(_text(df, "raw_text")), rules or NICHE_WORDS, default)
    return df.withColumn("niche", F.coalesce(given, told))


def priority_score(df: DataFrame) -> DataFrame:
    """``priority_score``: 30 plus bonuses for niche, language and rights, within 0..100."""
    # The base, the bonuses and the bounds.
    rights = (
        F.when(F.col("rights") == "FREE_REPOST", 20)
        .when(F.col("rights") == "REWRITE_REQUIRED", 10)
        .when(F.col("rights") == "INSPIRE_ONLY", 5)
        .otherwise(-30)
    )
    score = (
        F.lit(30)
        + F.when(F.col("niche").isin(PREFERRED_NICHES), 25).otherwise(0)
        + F.when(F.col("lang") == PREFERRED_LANG, 20).otherwise(0)
        + rights
    )
    return df.withColumn("priority_score", F.greatest(F.lit(0), F.least(score, F.lit(100))))


def manual_score(df: DataFrame) -> DataFrame:
    """Reviewer columns, and ``manual_priority_score``: the manual score cut to a
    whole number, else the priority score. It is not clamped."""
    defaults = {"manual_score": "", "reviewer_decision": "PENDING", "reviewer_notes": ""}
    out = df.withColumns({c: F.lit(d) for c, d in defaults.items() if c not in df.columns})
    given = plain_number(F.col("manual_score").cast("string")).try_cast("bigint")
    return out.withColumn(
        "manual_priority_score", F.coalesce(given, F.col("priority_score").cast("bigint"))
    )


def blended_score(df: DataFrame) -> DataFrame:
    """``blended_priority_score``: 0.6 automatic + 0.4 manual in binary floating
    point, cut to a whole number within 0..100."""
    auto = F.col("priority_score").cast("double")
    manual = F.col("manual_priority_score").cast("double")
    blend = auto * F.lit(0.6) + manual * F.lit(0.4)
    bounded = F.greatest(F.lit(0.0), F.least(blend, F.lit(100.0)))
    return df.withColumn("blended_priority_score", bounded.cast("int"))


def status(df: DataFrame) -> DataFrame:
    """``status``: AVOID rows are marked FILTERED but kept."""
    return df.withColumn(
        "status", F.when(F.col("rights") == "AVOID", "FILTERED").otherwise("READY_TO_GENERATE")
    )


def legacy_score(df: DataFrame, name: str = "priority_score") -> DataFrame:
    """Earlier score: 3 for a preferred niche, 2 for the preferred language."""
    score = F.when(F.col("niche").isin(PREFERRED_NICHES), 3).otherwise(0) + F.when(
        F.col("lang") == PREFERRED_LANG, 2
    ).otherwise(0)
    return df.withColumn(name, score)


def classify(df: DataFrame) -> DataFrame:
    """All of the above in the order they build on each other."""
    out = infer_niche(normalize_strategy(normalize_rights(infer_platform(df))))
    return status(blended_score(manual_score(priority_score(out))))

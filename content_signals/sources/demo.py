"""Deterministic demonstration sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from content_signals.constants import ORD


def _every(n: int, then: str, otherwise: str) -> Column:
    return F.when(F.col(ORD) % n == 0, then).otherwise(otherwise)


def demo_sources(spark: SparkSession, n: int = 10, source_file: str = "master_sources.csv") -> DataFrame:
    """``n`` made-up sources, numbered from 1."""
    # The scores and the order of these rows are known.
    picked = F.col(ORD).isin(2, 6)
    number = F.col(ORD).cast("string")
    return spark.range(1, n + 1).withColumnRenamed("id", ORD).select(
        F.concat(F.lit("https://youtube.com/watch?v=video"), number).alias("source_url"),
        _every(2, "MOTIVATION", "BUSINESS").alias("niche"),
        _every(3, "education", "viral").alias("usage_strategy"),
        _every(2, "FR", "EN").alias("lang"),
        _every(4, "INSPIRE_ONLY", "REWRITE_REQUIRED").alias("rights"),
        F.when(picked, "92").otherwise("").alias("manual_score"),
        F.when(picked, "SELECT").otherwise("PENDING").alias("reviewer_decision"),
        F.when(picked, "High potential").otherwise("").alias("reviewer_notes"),
        F.lit("").alias("origin_platform"),
        F.lit("default").alias("prompt_template"),
        F.lit(False).alias("processed"),
        F.concat(F.lit("demo-row-"), number).alias("notes"),
        F.lit(source_file).alias("source_file"),
        ORD,
    )

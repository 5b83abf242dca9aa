"""Seed texts and the payload handed to an external generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import PAYLOAD_CONSTRAINTS, PAYLOAD_GOAL
from content_signals.functions.text import json_text, title_case, trim_ws


def _text(df: DataFrame, name: str, default: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit(default)


def seed_fields(df: DataFrame) -> DataFrame:
    """Add ``title_seed`` and ``caption_seed``, and ``raw_text`` where absent."""
    url = trim_ws(_text(df, "content_url", ""))
    niche = F.upper(trim_ws(_text(df, "niche", "MOTIVATION")))
    lang = F.upper(trim_ws(_text(df, "lang", "FR")))
    added = {
        "title_seed": F.concat(F.lit("["), niche, F.lit("] Hook idea from "), url),
        "caption_seed": F.concat_ws(
            " | ", title_case(niche), lang, F.concat(F.lit("Source: "), url)
        ),
    }
    if "raw_text" not in df.columns:
        added["raw_text"] = F.concat(F.lit("Source content collected from "), url)
    return df.withColumns(added)


def ai_payload(df: DataFrame) -> DataFrame:
    """Add ``ai_enhancement_payload``: JSON text with a blank after each separator.

    Spark's ``to_json`` has no such blanks, so only the values come from it.
    """
    constraints = ", ".join(f'"{c}"' for c in PAYLOAD_CONSTRAINTS)
    score = (
        F.coalesce(F.col("blended_priority_score").cast("string"), F.lit("null"))
        if "blended_priority_score" in df.columns
        else F.lit("0")
    )
    payload = F.concat(
        F.lit('{"input_prompt": '),
        json_text(_text(df, "final_prompt", "")),
        F.lit(f', "goal": "{PAYLOAD_GOAL}", "constraints": [{constraints}], "metadata": {{"niche": '),
        json_text(_text(df, "niche", "MOTIVATION")),
        F.lit(', "lang": '),
        json_text(_text(df, "lang", "FR")),
        F.lit(', "usage_strategy": '),
        json_text(_text(df, "usage_strategy", "viral")),
        F.lit(', "blended_priority_score": '),
        score,
        F.lit("}}"),
    )
    return df.withColumn("ai_enhancement_payload", payload)


def ai_status(df: DataFrame) -> DataFrame:
    """Add ``ai_status``; ``content_ready`` falls back on ``prompt_generated``."""
    out = df
    if "content_ready" not in df.columns:
        generated = F.col("prompt_generated") if "prompt_generated" in df.columns else F.lit(False)
        out = out.withColumn("content_ready", generated)
    return out.withColumn(
        "ai_status", F.when(F.col("content_ready"), "READY_FOR_AI").otherwise("SKIPPED")
    )


def generation_payload(df: DataFrame) -> DataFrame:
    """Seeds, payload and status."""
    return ai_status(ai_payload(seed_fields(df)))

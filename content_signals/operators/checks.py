"""Output checks: each gives rows ``(check, ok, detail)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import MASTER_COLUMNS, PROMPTS_REQUIRED, READY_REQUIRED

def check_columns(df: DataFrame, required: list[str], name: str) -> DataFrame:
    """Whether a table has the required columns; reads no rows."""
    missing = ", ".join(c for c in required if c not in df.columns)
    return df.sparkSession.range(1).select(
        F.lit(f"{name} columns").alias("check"),
        F.lit(not missing).alias("ok"),
        F.lit(f"missing: {missing}" if missing else "").alias("detail"),
    )


def _one_row(df: DataFrame, name: str, number: Column, ok: Column) -> DataFrame:
    return df.agg(number.alias("_n")).select(
        F.lit(name).alias("check"), ok.alias("ok"), F.col("_n").cast("string").alias("detail")
    )


def check_row_count(df: DataFrame, expected: int | Column, name: str) -> DataFrame:
    """Whether a table has exactly the expected number of rows."""
    return _one_row(df, f"{name} rows", F.count("*"), F.col("_n") == expected)


def flatten_templates(df: DataFrame) -> DataFrame:
    """Template sets as ``(template, section, key, value)`` rows."""
    base = df.select(
        "template",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("base_prompt").alias("section"),
                        F.lit(key).alias("key"),
                        value.alias("value"),
                    )
                    for key, value in (
                        ("role", F.col("role")),
                        ("rules", F.to_json("rules")),
                        ("format", F.col("format")),
                    )
                ]
            )
        ),
    )
    goals = df.select("template", F.explode("goals").alias("name", "goal")).select(
        "template",
        F.lit("content_goals").alias("section"),
        F.col("name").alias("key"),
        F.to_json("goal").alias("value"),
    )
    levels = df.select(
        "template",
        F.lit("transformation_levels").alias("section"),
        F.explode("levels").alias("key", "value"),
    )
    return base.unionByName(goals).unionByName(levels)


def check_template_parity(one: DataFrame, other: DataFrame) -> DataFrame:
    """Whether two template tables have the same content.

    Entries are counted on either side of one grouping, with no join.
    """
    sides = (
        flatten_templates(one)
        .withColumn("_n", F.lit(1))
        .unionByName(flatten_templates(other).withColumn("_n", F.lit(-1)))
    )
    odd = (
        sides.groupBy("template", "section", "key", "value")
        .agg(F.sum("_n").alias("_n"))
        .filter(F.col("_n") != 0)
    )
    return _one_row(odd, "template parity", F.count("*"), F.col("_n") == 0)


def check_prompts_nonempty(df: DataFrame) -> DataFrame:
    """Whether every usable row has a prompt."""
    empty = F.count_if(
        (F.col("status") != "FILTERED") & (F.coalesce("final_prompt", F.lit("")) == "")
    )
    return _one_row(df, "prompts filled", empty, F.col("_n") == 0)


def check_outputs(
    ready: DataFrame, prompts: DataFrame, master: DataFrame, expected_rows: int | Column
) -> DataFrame:
    """All checks of a finished run in one table."""
    checks = [
        check_columns(ready, READY_REQUIRED, "ready"),
        check_columns(prompts, PROMPTS_REQUIRED, "prompts"),
        check_columns(master, MASTER_COLUMNS, "master"),
        check_row_count(ready, expected_rows, "ready"),
        check_row_count(prompts, expected_rows, "prompts"),
        check_prompts_nonempty(prompts),
    ]
    return reduce(DataFrame.unionByName, checks)

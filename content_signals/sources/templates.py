"""Prompt templates from JSON files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from content_signals.constants import (
    DEFAULT_FORMAT,
    DEFAULT_ROLE,
    DEFAULT_RULES,
    LEGACY_BASE_PROMPT,
    LEGACY_GOALS,
    LEGACY_LEVELS,
)

_SECTIONS = ["base_prompt", "content_goals", "transformation_levels"]
_GOALS = "map<string, struct<objective: string, tone: string>>"


def _read_sections(spark: SparkSession, paths: list[str], json_lines: bool) -> DataFrame:
    """Template name and raw JSON text of each section, from the first path that exists."""
    schema = ", ".join(f"{c} string" for c in ["template"] + _SECTIONS)
    for path in paths:
        try:
            raw = spark.read.schema(schema).option("multiLine", not json_lines).json(path)
            # Spark checks the path when it makes the plan
            return raw.withColumn("template", F.coalesce("template", F.lit("default")))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no template file: {' or '.join(paths)}")


def _checked(raw: DataFrame) -> DataFrame:
    """Raw sections to typed columns. One small job over the templates finds all faults."""
    base = raw.withColumn(
        "_base", F.from_json("base_prompt", "role string, rules string, format string")
    )
    faults = {f"missing template section: {s}": F.col(s).isNull() for s in _SECTIONS}
    faults["base_prompt must be an object"] = ~F.col("base_prompt").startswith("{")
    faults["base_prompt.rules must be a list"] = ~F.col("_base.rules").startswith("[")
    found = base.agg(*[F.count_if(fault) for fault in faults.values()]).first()
    for message, count in zip(faults, found):
        if count:
            raise ValueError(message)
    rules = F.from_json(F.col("_base.rules"), "array<string>")
    return base.select(
        "template",
        F.coalesce("_base.role", F.lit(DEFAULT_ROLE)).alias("role"),
        F.coalesce(rules, F.array(*[F.lit(r) for r in DEFAULT_RULES])).alias("rules"),
        F.coalesce("_base.format", F.lit(DEFAULT_FORMAT)).alias("format"),
        F.from_json("content_goals", _GOALS).alias("goals"),
        F.from_json("transformation_levels", "map<string, string>").alias("levels"),
    )


def read_templates(
    spark: SparkSession,
    path: str | None = None,
    folder: str = "prompts",
    json_lines: bool = False,
) -> DataFrame:
    """One row per template set: ``(template, role, rules, format, goals, levels)``.

    A given path must exist; otherwise ``prompt_templates.json`` is looked for in
    the folder, then ``prompt_template.json``. ``json_lines`` reads many sets, each
    on a line with its ``template`` name. Absent or misshapen sections raise.
    """
    paths = [path] if path else [f"{folder}/prompt_templates.json", f"{folder}/prompt_template.json"]
    return _checked(_read_sections(spark, paths, json_lines))


def templates_from_dict(spark: SparkSession, template: dict, name: str = "default") -> DataFrame:
    """The same table out of one template set given as a dict."""
    texts = {s: json.dumps(template[s]) if s in template else None for s in _SECTIONS}
    raw = spark.range(1).select(
        F.lit(name).alias("template"),
        *[F.lit(text).cast("string").alias(s) for s, text in texts.items()],
    )
    return _checked(raw)


def template_dims(templates: DataFrame) -> dict[str, DataFrame]:
    """The sets as flat tables: ``base``, ``goals`` and ``levels``."""
    return {
        "base": templates.select("template", "role", "rules", "format"),
        "goals": templates.select("template", F.explode("goals").alias("strategy", "_goal")).select(
            "template", "strategy", "_goal.objective", "_goal.tone"
        ),
        "levels": templates.select("template", F.explode("levels").alias("level", "text")),
    }


def _text_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def read_legacy_templates(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """Text templates: ``(template, base_prompt, goals, levels)``; absent sections get defaults."""
    raw = _read_sections(spark, [path], json_lines)
    texts = "map<string, string>"
    return raw.select(
        "template",
        F.coalesce("base_prompt", F.lit(LEGACY_BASE_PROMPT)).alias("base_prompt"),
        F.coalesce(F.from_json("content_goals", texts), _text_map(LEGACY_GOALS)).alias("goals"),
        F.coalesce(F.from_json("transformation_levels", texts), _text_map(LEGACY_LEVELS)).alias(
            "levels"
        ),
    )


def legacy_default_templates(spark: SparkSession) -> DataFrame:
    """The text template used when none is given."""
    return spark.range(1).select(
        F.lit("default").alias("template"),
        F.lit(LEGACY_BASE_PROMPT).alias("base_prompt"),
        _text_map(LEGACY_GOALS).alias("goals"),
        _text_map(LEGACY_LEVELS).alias("levels"),
    )

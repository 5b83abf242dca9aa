"""Prompt rendering: template lookup, the three prompt layouts, quality flags.

Templates come as one row per template set (see ``sources/templates.py``), with
the goals and levels as maps. So a row needs one lookup, of the template set,
and none when there is a single set: that is read as a scalar subquery and no
join takes place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import (
    DEFAULT_HINT,
    DEFAULT_OBJECTIVE,
    DEFAULT_TONE,
    DEFAULT_TRANSFORMATION,
    LEGACY_FORMAT,
    LEGACY_RIGHTS_TO_LEVEL,
    RIGHTS_TO_LEVEL,
)
from content_signals.functions.text import text_or, trim_ws
from content_signals.plans.skew import lookup_join

_SET = "_template"


def _column(df: DataFrame, name: str, default: str) -> Column:
    """A text column; the default if the column is absent or the cell null or empty."""
    if name not in df.columns:
        return F.lit(default)
    return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(default))


def with_template(
    df: DataFrame, templates: DataFrame, per_row: bool = False, default: str = "default"
) -> DataFrame:
    """Add the struct ``_template`` that the row is rendered with.

    By default every row takes the template set named ``default``. ``per_row``
    lets the column ``prompt_template`` choose, with that set as the fallback. If
    there is no such set, rows that need it raise an error.
    """
    fields = [c for c in templates.columns if c != "template"]
    sets = templates.select("template", F.struct(*fields).alias(_SET))
    found = sets.filter(F.col("template") == default).select(_SET).scalar()
    missing = F.raise_error(F.lit(f"no template set is named {default!r}"))
    fallback = F.when(found.isNull(), missing).otherwise(found)
    if not per_row:
        return df.withColumn(_SET, fallback)
    chosen = sets.withColumnRenamed("template", "prompt_template")
    joined = lookup_join(df, chosen, ["prompt_template"])
    return joined.withColumn(_SET, F.coalesce(F.col(_SET), fallback))


def _mapped(value: Column, mapping: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for key, target in mapping.items():
        out = F.when(value == key, target).otherwise(out)
    return out


def template_lookup(df: DataFrame) -> DataFrame:
    """Add ``objective``, ``tone`` and ``transformation`` out of ``_template``."""
    goals, levels = F.col(_SET)["goals"], F.col(_SET)["levels"]
    strategy = F.lower(trim_ws(_column(df, "usage_strategy", "viral")))
    goal = F.coalesce(F.try_element_at(goals, strategy), F.try_element_at(goals, F.lit("viral")))
    rights = F.upper(trim_ws(_column(df, "rights", "REWRITE_REQUIRED")))
    level = F.try_element_at(levels, _mapped(rights, RIGHTS_TO_LEVEL, "rewrite"))
    rewrite = F.try_element_at(levels, F.lit("rewrite"))
    return df.withColumns(
        {
            "objective": F.coalesce(goal["objective"], F.lit(DEFAULT_OBJECTIVE)),
            "tone": F.coalesce(goal["tone"], F.lit(DEFAULT_TONE)),
            "transformation": F.coalesce(level, rewrite, F.lit(DEFAULT_TRANSFORMATION)),
        }
    )


def _rules(df: DataFrame) -> Column:
    return F.array_join(F.col(_SET)["rules"], "; ")


def _labelled(lines: list[tuple[str, Column]]) -> Column:
    return F.concat_ws("\n", *[F.concat(F.lit(label + ": "), value) for label, value in lines])


def render_prompt(
    df: DataFrame,
    templates: DataFrame,
    hint: str | None = DEFAULT_HINT,
    per_row_template: bool = False,
    on_bad_row: str = "raise",
) -> DataFrame:
    """Add ``final_prompt``: labelled lines, or '' when the rights forbid use.

    A usable row without a URL fails the job (``on_bad_row="raise"``) or is
    given a null prompt (``"quarantine"``, to be parted with ``split_bad_rows``).
    """
    if on_bad_row not in ("raise", "quarantine"):
        raise ValueError(f"on_bad_row: {on_bad_row}")
    looked_up = template_lookup(with_template(df, templates, per_row_template))
    url_column = next((c for c in ("content_url", "source_url") if c in df.columns), None)
    url = trim_ws(F.coalesce(F.col(url_column), F.lit(""))) if url_column else F.lit("")
    score = next((c for c in ("blended_priority_score", "priority_score") if c in df.columns), None)
    # The labels and their order.
    lines = [
        ("ROLE", F.col(_SET)["role"]),
        ("RULES", _rules(df)),
        ("OBJECTIVE", F.col("objective")),
        ("TONE", F.col("tone")),
        ("TRANSFORMATION", F.col("transformation")),
        ("NICHE", F.upper(trim_ws(_column(df, "niche", "MOTIVATION")))),
        ("LANGUAGE", F.upper(trim_ws(_column(df, "lang", "FR")))),
        ("SOURCE", url),
        ("PRIORITY_SCORE", (F.col(score) if score else F.lit(0)).cast("string")),
        ("EDITOR_NOTES", text_or(_column(df, "notes", ""), "None")),
        ("FORMAT", F.col(_SET)["format"]),
    ]
    if hint is not None:
        lines.append(("AI_ENHANCEMENT_HINT", F.lit(hint)))
    if on_bad_row == "raise":
        no_url = F.raise_error(F.lit("no content_url or source_url on a row")).cast("string")
    else:
        no_url = F.lit(None).cast("string")
    rights = F.upper(F.coalesce(F.col("rights"), F.lit(""))) if "rights" in df.columns else F.lit("")
    prompt = F.when(rights == "AVOID", "").when(url == "", no_url).otherwise(_labelled(lines))
    return looked_up.withColumn("final_prompt", prompt).drop(
        _SET, "objective", "tone", "transformation"
    )


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rendered rows, and the quarantined rows that have no URL."""
    return df.filter(F.col("final_prompt").isNotNull()), df.filter(F.col("final_prompt").isNull())


def prompt_quality(df: DataFrame) -> DataFrame:
    """Add ``prompt_quality_flags`` and ``prompt_quality_score``."""
    text = F.coalesce(F.col("final_prompt"), F.lit(""))
    # Flag, condition, points off.
    faults = [
        ("prompt_too_short", F.length(text) < 180, 25),
        ("missing_role", ~text.contains("ROLE:"), 20),
        ("missing_objective", ~text.contains("OBJECTIVE:"), 20),
        ("missing_source", ~text.contains("SOURCE:"), 20),
    ]
    flags = F.concat_ws("|", *[F.when(fault, name) for name, fault, _ in faults])
    score = F.lit(100)
    for _, fault, cost in faults:
        score = score - F.when(fault, cost).otherwise(0)
    return df.withColumns(
        {
            "prompt_quality_flags": F.when(flags == "", "OK").otherwise(flags),
            "prompt_quality_score": F.greatest(F.lit(0), score),
        }
    )


def ready_flags(df: DataFrame) -> DataFrame:
    """Add ``prompt_generated`` and ``content_ready``."""
    generated = F.length(F.coalesce(F.col("final_prompt"), F.lit(""))) > 0
    kept = F.col("status") != "FILTERED" if "status" in df.columns else F.lit(True)
    return df.withColumns(
        {"prompt_generated": generated, "content_ready": generated & F.coalesce(kept, F.lit(True))}
    )


def build_prompts(df: DataFrame, templates: DataFrame, **options) -> DataFrame:
    """Render, rate and flag."""
    return ready_flags(prompt_quality(render_prompt(df, templates, **options)))


def render_prompt_legacy(df: DataFrame, templates: DataFrame) -> DataFrame:
    """Earlier block layout over text templates; rows to avoid are rendered too.

    ``templates``: ``(template, base_prompt, goals, levels)``, all text or maps of text.
    """
    with_set = with_template(df, templates)
    goals, levels = F.col(_SET)["goals"], F.col(_SET)["levels"]
    strategy = F.lower(trim_ws(_column(df, "usage_strategy", "viral")))
    rights = F.lower(trim_ws(_column(df, "rights", "")))
    level = _mapped(rights, LEGACY_RIGHTS_TO_LEVEL, "rewrite")
    # A goal or level that even the fallback lacks prints as None.
    goal_text = F.coalesce(
        F.try_element_at(goals, strategy), F.try_element_at(goals, F.lit("viral")), F.lit("None")
    )
    level_text = F.coalesce(
        F.try_element_at(levels, level), F.try_element_at(levels, F.lit("rewrite")), F.lit("None")
    )

    def given(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit(default)

    # The headings and their order.
    blocks = [
        ("ROLE", F.col(_SET)["base_prompt"]),
        ("OBJECTIVE", goal_text),
        ("TRANSFORMATION RULE", level_text),
        ("NICHE", given("niche", "general")),
        ("SOURCE URL", given("content_url", "")),
        ("LANGUAGE", given("lang", "en")),
        ("FORMAT", F.lit(LEGACY_FORMAT)),
    ]
    text = F.concat_ws("\n\n", *[F.concat(F.lit(head + ":\n"), body) for head, body in blocks])
    return with_set.withColumns(
        {
            "final_prompt": trim_ws(text),
            "prompt_generated": F.lit(True),
            "content_ready": F.coalesce(F.map_contains_key(levels, level), F.lit(False)),
        }
    ).drop(_SET)


def render_prompt_draft(df: DataFrame, templates: DataFrame) -> DataFrame:
    """Draft layout of seven lines; nothing is stripped and no row is left out."""
    with_set = with_template(df, templates)
    goals = F.col(_SET)["goals"]
    strategy = F.lower(_column(df, "usage_strategy", "viral"))
    goal = F.coalesce(F.try_element_at(goals, strategy), F.try_element_at(goals, F.lit("viral")))
    lang = F.coalesce(F.col("lang"), F.lit("")) if "lang" in df.columns else F.lit("FR")
    text = _labelled(
        [
            ("ROLE", F.col(_SET)["role"]),
            ("RULES", _rules(df)),
            ("OBJECTIVE", goal["objective"]),
            ("TONE", goal["tone"]),
            ("SOURCE", F.coalesce(F.col("content_url"), F.lit(""))),
            ("LANGUAGE", lang),
            ("FORMAT", F.col(_SET)["format"]),
        ]
    )
    return with_set.withColumn("final_prompt", trim_ws(text)).drop(_SET)

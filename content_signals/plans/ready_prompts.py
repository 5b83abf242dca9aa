"""From a source table to ranked prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from content_signals.operators.classify import classify
from content_signals.operators.dedup import dedup_sources
from content_signals.operators.normalize import normalize
from content_signals.operators.payload import generation_payload
from content_signals.operators.prompts import build_prompts
from content_signals.operators.ranking import prompts_projection, rank_for_review, ready_projection
from content_signals.operators.sinks import write_csv
from content_signals.plans.staging import discard, stage
from content_signals.sources.csv_files import add_defaults


def score_sources(sources: DataFrame, strict: bool = False) -> DataFrame:
    """Deduplicate, normalize, classify and score; one shuffle, for the duplicates.

    ``strict`` raises where every URL is blank, at the price of a small job.
    """
    return classify(normalize(dedup_sources(add_defaults(sources)), strict))


def prepare_prompts(sources: DataFrame, templates: DataFrame, **options) -> DataFrame:
    """Scored rows with prompt and payload, in no particular order."""
    return _render(score_sources(sources), templates, options)


def _render(scored: DataFrame, templates: DataFrame, options: dict) -> DataFrame:
    return generation_payload(build_prompts(scored, templates, **options))


def _rank_and_render(scored: DataFrame, templates: DataFrame, options: dict) -> DataFrame:
    """Sort, then render, so that the sort moves the notes but not the two texts
    that repeat them. Rendering works row by row and keeps the order, unless each
    row looks up a template of its own."""
    if options.get("per_row_template"):
        return rank_for_review(_render(scored, templates, options))
    return _render(rank_for_review(scored), templates, options)


def ready_and_prompts(
    sources: DataFrame, templates: DataFrame, strict: bool = False, **options
) -> tuple[DataFrame, DataFrame]:
    """The ranked review table and the ranked prompt table; ``strict`` as in ``score_sources``."""
    ranked = _rank_and_render(score_sources(sources, strict), templates, options)
    return ready_projection(ranked), prompts_projection(ranked)


def run_and_write(
    sources: DataFrame,
    templates: DataFrame,
    ready_path: str,
    prompts_path: str,
    strict: bool = False,
    **options,
) -> bool:
    """Write both tables as CSV; False, with nothing written, for an empty source.

    The deduplicated, scored rows are staged for the two writes, where they outlive lost
    executors, and deleted after them. ``strict`` as in ``score_sources``.
    """
    if sources.isEmpty():
        return False
    scored = stage(score_sources(sources, strict), "scored-sources")
    ranked = _rank_and_render(scored, templates, options)
    write_csv(ready_projection(ranked), ready_path)
    write_csv(prompts_projection(ranked), prompts_path)
    discard(scored)
    return True

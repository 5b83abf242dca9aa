"""From collected links to the strict source table, and back from shared links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import MINIMUM_RESULTS, ORD
from content_signals.functions.urls import canonical_watch_url
from content_signals.operators.dedup import concat_collections, dedup_by_watch_url, pad_to_minimum
from content_signals.operators.sinks import write_master
from content_signals.operators.videos import master_projection
from content_signals.plans.bloom import may_be_member
from content_signals.plans.order import first_rows
from content_signals.plans.skew import lookup_join, salted_join
from content_signals.plans.staging import stage
from content_signals.sources.landed_json import PAGE_KINDS, mixed_video_items


def links_to_master(
    records: DataFrame, minimum: int = MINIMUM_RESULTS, carry: list[str] | None = None, **defaults
) -> DataFrame:
    """Strict source rows of the records' videos, each once, at least ``minimum``.

    The URLs are canonical and unique after the first deduplication, and the
    projection leaves them so; a second one would change nothing. The rows are
    staged, since padding looks at them twice.
    """
    unique = dedup_by_watch_url(records)
    master = master_projection(unique, carry=carry, canonical=True, **defaults)
    return pad_to_minimum(stage(master, "master"), minimum)


def landed_records(
    pages: DataFrame, page_links: DataFrame | None = None, max_results: int | None = None
) -> DataFrame:
    """Records of landed mixed pages: queries, then channels, then playlists, each in order of arrival.

    At most ``max_results`` records of each source are taken, if given. ``page_links`` are records
    found on crawled pages, which come last. Items of pages that name no source, and blank
    sources, are left out.
    """
    items = mixed_video_items(pages).filter(F.col("kind").isNotNull())
    if max_results is not None:
        sources = items.select("kind", "source").distinct().withColumn("_most", F.lit(max_results))
        items = first_rows(items, ["kind", "source"], sources, "_most")
    parts = [items.filter(F.col("kind") == kind).drop("kind") for kind in PAGE_KINDS]
    if page_links is not None:
        parts.append(page_links)
    return concat_collections(*parts)


def collect_links(records: DataFrame, path: str, **options) -> str:
    """Write the strict source table as CSV."""
    return write_master(links_to_master(records, **options), path)


def validate_links(links: DataFrame, prompts: DataFrame) -> DataFrame:
    """For shared links ``(source_url, _ord)``: the stored verdict as JSON text.

    Links are matched by canonical URL against the first stored row of that URL.
    The stars are 1 + a fifth of the blended score, at most 5, and 1 for an
    unknown link. Neither input is changed. ``_ord`` of the stored rows is unique; what is
    stored is read twice, for its keys and for the texts that are wanted.
    """
    def url() -> Column:
        raw = F.coalesce("source_url", F.lit(""))
        return F.coalesce(canonical_watch_url(raw), raw)

    shared = stage(links.withColumn("_url", url()), "shared-links")
    # Keys alone decide which stored row counts; only those of shared links are looked at.
    keys = may_be_member(prompts.select(url().alias("_url"), F.col(ORD).alias("_stored")), "_url", shared)
    first = stage(keys.groupBy("_url").agg(F.min("_stored").alias("_stored")), "first-stored")
    matched = stage(lookup_join(shared, first, ["_url"]), "matched-links")
    # The texts come last, by the row's place: each is moved once at most.
    texts = prompts.select(F.col(ORD).alias("_stored"), "blended_priority_score", "status", "final_prompt")
    wanted = may_be_member(texts, "_stored", matched.filter(F.col("_stored").isNotNull()))
    matched = salted_join(matched, wanted, ["_stored"])
    known = F.col("blended_priority_score").isNotNull()
    stars = F.least(F.lit(5), F.lit(1) + F.floor(F.col("blended_priority_score") / 20)).cast("int")
    reason = F.concat(
        F.lit("blended score "),
        F.col("blended_priority_score").cast("string"),
        F.lit(", status "),
        F.col("status"),
    )
    verdict = F.struct(
        F.when(known, stars).otherwise(1).alias("trend_score"),
        F.when(known, reason).otherwise("link not found").alias("trend_reason"),
        F.coalesce("final_prompt", F.lit("")).alias("improvement_prompt"),
    )
    return matched.select(ORD, "source_url", F.to_json(verdict).alias("verdict"))

"""From landed search hits and details to attributed, deduplicated videos."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import ORD, PAGE_SIZE, SEARCH_PAGE_QUOTA
from content_signals.operators.dedup import dedup_video_ids, distinct_ids, keep_first, top_n_per_query
from content_signals.operators.requests import search_pages_read
from content_signals.operators.sinks import write_telemetry
from content_signals.operators.videos import (
    attribute_query,
    normalize_videos,
    quality_filter,
    query_stats,
    run_summary,
    valid_items_filter,
)
from content_signals.plans.skew import lookup_join
from content_signals.plans.staging import stage, stage_counted


@dataclass
class Collection:
    """Tables of one collection run."""

    videos: DataFrame
    stats: DataFrame
    summary: DataFrame
    started_at: datetime


def collect_videos(
    hits: DataFrame,
    details: DataFrame,
    specs: DataFrame,
    max_pages: int | None = None,
    search_calls: Column | None = None,
    pages: DataFrame | None = None,
    cache_hits: Column | None = None,
    keep=None,
    rescore=None,
) -> Collection:
    """Videos found by the queries, with statistics.

    ``hits``: ``(query, id, _ord)`` and if landed ``page``, the search results in
    arrival order;
    ``details``: one item per video id (``id, snippet, statistics``);
    ``specs``: query specs whose ``_ord`` is the order of the queries.
    ``search_calls`` and ``cache_hits`` come from the request log if there is one. Without
    ``search_calls`` they are counted from the landed ``pages`` (``query, page``; default:
    those of the hits, which leaves out pages without items). Hits without pages count none.

    Ids, items and unique videos are staged: the statistics and the summary count
    them without repeating the limits, the join and the deduplication. The unique videos are
    counted while they are written.
    """
    started = datetime.now(timezone.utc)
    taken = top_n_per_query(hits, specs, max_pages)
    ids = stage(distinct_ids(taken, ["query"]), "video-ids")
    # One row per (query, id) on the left and one per id on the right: no key is hot.
    if ORD not in details.columns:
        raise ValueError(f"details need an order, {ORD}: the first item of an id counts")
    first = keep_first(details, ["id"])
    found = ids.join(first.select("id", "snippet", "statistics"), "id")
    items = stage(normalize_videos(found), "video-items")

    places = specs.select("query", F.col(ORD).alias("_query_ord"))
    ordered = (
        lookup_join(attribute_query(valid_items_filter(items), specs), places, ["query"], "inner")
        .withColumn(ORD, F.struct(F.col("_query_ord").alias("query"), F.col(ORD).alias("row")))
        .drop("_query_ord")
    )
    titled = F.count_if(F.coalesce("title", F.lit("")) != "")
    unique, counts = stage_counted(dedup_video_ids(ordered), "videos", titled=titled)
    kept = quality_filter(unique, keep)
    final = rescore(kept) if rescore else kept

    zero = F.lit(0)
    calls = zero if search_calls is None else search_calls
    if search_calls is None and "page" in hits.columns:
        asked = search_pages_read(hits if pages is None else pages, taken, specs, max_pages)
        calls = F.coalesce(asked.agg(F.sum("search_calls")).scalar(), zero)
    sent = ids.groupBy("query").agg(F.count("*").alias("n")).agg(
        F.struct(
            F.coalesce(F.sum("n"), zero).alias("ids"),
            F.coalesce(F.sum(F.ceil(F.col("n") / PAGE_SIZE)), zero).alias("calls"),
        )
    ).scalar()
    summary = run_summary(
        {
            "queries": specs,
            "global_ids_collected": ids.select("id").distinct(),
            "rows_after_dedup": F.lit(counts["rows"]),
            "rows_after_quality_filter": kept if keep else F.lit(counts["titled"]),
            "rows_final": final if keep or rescore else F.lit(counts["titled"]),
            "api_search_calls": calls,
            "api_videos_calls": sent["calls"],
            "cache_hits": zero if cache_hits is None else cache_hits,
            "quota_units_estimated": calls * SEARCH_PAGE_QUOTA + sent["ids"],
        }
    )
    return Collection(final, query_stats(items, specs), summary, started)


def write_collection(collection: Collection, path: str) -> tuple[str, str]:
    """Write a run's account below ``path``, with the time when it began and that of the writing."""
    finished = datetime.now(timezone.utc)
    return write_telemetry(collection.stats, collection.summary, path, collection.started_at, finished)

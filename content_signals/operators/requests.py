"""Planning of metadata requests as data: batches, quota, what is still fresh."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from content_signals.constants import CACHE_TTL_SECONDS, PAGE_SIZE, SEARCH_PAGE_QUOTA
from content_signals.functions.times import utc
from content_signals.operators.dedup import distinct_ids
from content_signals.plans.order import add_position
from content_signals.plans.skew import lookup_join


def id_batches(df: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """``(query, batch, ids, n_ids)``: each query's distinct ids in order of first
    appearance, ``size`` to a request."""
    placed = add_position(distinct_ids(df, ["query"]), ["query"])
    batch = F.floor((F.col("position") - 1) / size).alias("batch")
    members = F.array_sort(F.collect_list(F.struct("position", "id")))
    grouped = placed.groupBy("query", batch).agg(members.alias("_members"))
    return grouped.select(
        "query",
        "batch",
        F.transform("_members", lambda m: m["id"]).alias("ids"),
        F.size("_members").alias("n_ids"),
    )


def search_pages_read(
    pages: DataFrame, taken: DataFrame, specs: DataFrame, max_pages: int | None = None
) -> DataFrame:
    """``(query, search_calls)``: the landed pages a run of the specs asks for.

    ``pages`` are the landed ones (``query, page``), ``taken`` the hits within the
    limits (``query, page``). A query's pages are asked for in order until it has its
    ``max_results``, ``max_pages`` is reached, or no page is left; a query that wants
    no result asks for none.
    """
    landed = pages.select("query", "page").distinct()
    first = landed.groupBy("query").agg(F.min("page").alias("_first"))
    reached = taken.groupBy("query").agg(F.count("*").alias("_n"), F.max("page").alias("_last"))
    bound = F.lit(max_pages).cast("bigint")
    if "max_pages" in specs.columns:
        bound = F.coalesce(F.col("max_pages").cast("bigint"), bound)
    limits = (
        specs.select("query", F.col("max_results").alias("_wanted"), bound.alias("_pages"))
        .join(first, "query")
        .join(reached, "query", "left")
        .select(
            "query",
            F.when(F.col("_wanted") <= 0, F.col("_first") - 1)
            .when(F.col("_n") >= F.col("_wanted"), F.col("_last"))
            .alias("_last"),
            (F.col("_first") + F.col("_pages")).alias("_end"),
        )
    )
    asked = lookup_join(landed, limits, ["query"], "inner", spread=F.col("page")).filter(
        F.coalesce(F.col("page") <= F.col("_last"), F.lit(True))
        & F.coalesce(F.col("page") < F.col("_end"), F.lit(True))
    )
    return asked.groupBy("query").agg(F.count("*").alias("search_calls"))


def quota_estimate(search_pages: DataFrame, batches: DataFrame) -> DataFrame:
    """Per query: search calls, detail calls, and the quota units they cost
    (100 a search page, 1 an id)."""
    searched = search_pages.groupBy("query").agg(F.count("*").alias("search_calls"))
    detailed = batches.groupBy("query").agg(
        F.count("*").alias("video_calls"), F.sum("n_ids").alias("n_ids")
    )
    both = searched.join(detailed, "query", "full")
    calls, details, ids = (
        F.coalesce(c, F.lit(0).cast("bigint")) for c in ("search_calls", "video_calls", "n_ids")
    )
    return both.select(
        "query",
        calls.alias("search_calls"),
        details.alias("video_calls"),
        (calls * SEARCH_PAGE_QUOTA + ids).alias("quota_units"),
    )


def pending_fetches(
    requests: DataFrame,
    log: DataFrame,
    as_of: datetime,
    keys: list[str],
    ttl_seconds: int = CACHE_TTL_SECONDS,
) -> DataFrame:
    """Distinct requests without a log entry (``fetched_at``) younger than the TTL.

    An entry counts until its age exceeds the TTL. Both sides are cut to one row
    per key before they are joined, so repeated keys do no harm.
    """
    age = (F.unix_micros(utc(as_of)) - F.unix_micros(F.col("fetched_at").cast("timestamp"))) / 1_000_000
    fresh = log.filter(age <= ttl_seconds).select(*keys).distinct()
    return requests.select(*keys).distinct().join(fresh, keys, "left_anti")

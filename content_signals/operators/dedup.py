"""Keep-first deduplication, padding, concatenation and per-query limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from content_signals.constants import (
    MASTER_COLUMNS,
    MINIMUM_RESULTS,
    ORD,
    PAGE_SIZE,
    WATCH_PREFIX,
)
from content_signals.functions.text import trim_ws
from content_signals.functions.urls import canonical_watch_url
from content_signals.plans.order import add_position, first_rows
from content_signals.plans.skew import lookup_join

# Up to this many rows per group Spark limits each group before it shuffles.
_PRE_SHUFFLE_LIMIT = 1000


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column] | None = None) -> DataFrame:
    """First row of each key in input order; null is a key like any other.

    Spark cuts every group to one row before the shuffle (WindowGroupLimit), so
    a key with a third of all rows sends one row per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or [ORD]))
    return (
        df.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def dedup_sources(df: DataFrame) -> DataFrame:
    """First row per raw ``source_url``: neither stripped nor case-folded."""
    return keep_first(df, ["source_url"])


def dedup_by_watch_url(df: DataFrame) -> DataFrame:
    """First row per canonical watch URL, which replaces ``source_url``; others go."""
    canonical = df.withColumn("source_url", canonical_watch_url(F.col("source_url")))
    return keep_first(canonical.filter(F.col("source_url").isNotNull()), ["source_url"])


def dedup_video_ids(df: DataFrame) -> DataFrame:
    """First row per video id over all queries; the earliest query owns the video."""
    return keep_first(df.filter(F.coalesce("id", F.lit("")) != ""), ["id"])


def distinct_ids(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Ids once each with the order of their first appearance: ``(keys..., id, _ord)``."""
    return (
        df.filter(F.coalesce("id", F.lit("")) != "")
        .groupBy(*(keys or []), "id")
        .agg(F.min(ORD).alias(ORD))
    )


def pad_to_minimum(df: DataFrame, minimum: int = MINIMUM_RESULTS) -> DataFrame:
    """Add seed rows until there are ``minimum`` rows; a longer table is unchanged.

    Needs no full count: the count of the first ``minimum`` rows settles it.
    """
    present = df.limit(minimum).agg(F.count("*").alias("n")).scalar()
    missing = F.lit(minimum) - present
    seeds = df.sparkSession.range(1, minimum + 1).filter(F.col("id") <= missing)
    seeds = seeds.select(
        F.concat(F.lit(WATCH_PREFIX + "demo_seed_"), F.col("id").cast("string")).alias("source_url"),
        *[F.lit("").alias(c) for c in MASTER_COLUMNS[1:-1]],
        F.lit("YOUTUBE").alias("origin_platform"),
    )
    return df.unionByName(seeds, allowMissingColumns=True)


def concat_collections(*collections: DataFrame) -> DataFrame:
    """Query, channel and playlist records one after the other, blank inputs left out.

    Each has a ``source`` column (the query, channel or playlist text) and an
    ``_ord``; the result's ``_ord`` puts the first collection first.
    """
    parts = [
        part.filter(trim_ws(F.coalesce("source", F.lit(""))) != "").withColumn(
            ORD, F.struct(F.lit(place).alias("kind"), F.col(ORD).alias("row"))
        )
        for place, part in enumerate(collections)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def one_spec_per_query(specs: DataFrame) -> DataFrame:
    """The specs; a query that stands in two of them fails the job, since lookups by
    query would give each of its hits twice."""
    times = F.count("*").over(Window.partitionBy("query"))
    error = F.raise_error(F.concat(F.lit("query in more than one spec: "), F.col("query")))
    once = F.when(F.col("_times") > 1, error.cast("boolean")).otherwise(True)
    return specs.withColumn("_times", times).filter(once).drop("_times")


def top_n_per_query(
    df: DataFrame,
    specs: DataFrame,
    max_pages: int | None = None,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """At most ``max_results`` rows with an id of each query, in arrival order.

    Rows whose ``id`` is blank don't count towards the limit and go, as do rows of a
    query without a spec; two specs of one query are an error. Rows that lie beyond the
    limit by the counts of those before them are left before they are shuffled.
    ``max_pages`` bounds the pages that are looked at, blank ids included; a column
    ``max_pages`` of the specs takes its place where it is not null. Pages are those of
    the column ``page``, which counts up by one from a query's first page, or else
    ``page_size`` rows each.
    """
    specs = one_spec_per_query(specs)
    pages = F.lit(max_pages).cast("bigint")
    if "max_pages" in specs.columns:
        pages = F.coalesce(F.col("max_pages").cast("bigint"), pages)
    limits = specs.select("query", F.col("max_results").alias("_limit"), pages.alias("_pages"))
    rows = df
    bounded = max_pages is not None or "max_pages" in specs.columns
    if bounded:
        rows = lookup_join(rows, limits.select("query", "_pages"), ["query"], "inner")
    if bounded and "page" in df.columns:
        first = df.groupBy("query").agg(F.min("page").alias("_first"))
        rows = lookup_join(rows, first, ["query"], "inner").filter(
            F.col("_pages").isNull() | (F.col("page") < F.col("_first") + F.col("_pages"))
        )
        rows = rows.drop("_first")
    elif bounded:
        rows = _numbered(rows, "_row", max_pages, page_size, "max_pages" in specs.columns).filter(
            F.col("_pages").isNull() | (F.col("_row") <= F.col("_pages") * page_size)
        )
        rows = rows.drop("_row")
    if "id" in df.columns:
        rows = rows.filter(F.coalesce("id", F.lit("")) != "")
    return first_rows(rows.select(*df.columns), ["query"], limits, "_limit")


def _numbered(
    rows: DataFrame, name: str, max_pages: int | None, page_size: int, by_spec: bool
) -> DataFrame:
    """Number the rows of each query; a small bound common to all is cut before the shuffle."""
    if by_spec or max_pages is None or max_pages * page_size > _PRE_SHUFFLE_LIMIT:
        return add_position(rows, ["query"], name)
    window = Window.partitionBy("query").orderBy(ORD)
    numbered = rows.withColumn(name, F.row_number().over(window))
    return numbered.filter(F.col(name) <= max_pages * page_size)

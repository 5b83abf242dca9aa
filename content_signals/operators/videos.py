"""Video metadata: normalization, filters, query attribution, run statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import ORD
from content_signals.functions.fields import has_field, text_field
from content_signals.functions.text import count_or_zero
from content_signals.functions.urls import canonical_watch_url
from content_signals.operators.dedup import one_spec_per_query
from content_signals.plans.skew import lookup_join

ITEM_FIELDS = ["platform", "id", "title", "channel", "views", "published_at", "source_extra"]


def normalize_videos(df: DataFrame) -> DataFrame:
    """Flatten detail items (``id``, ``snippet``, ``statistics``) to the item columns.

    Missing text is '', missing tags an empty list, an unreadable count 0. Other
    columns, such as the query and the order, are carried along.
    """
    tags = F.col("snippet.tags") if has_field(df, "snippet.tags") else F.lit(None)
    extra = F.struct(
        text_field(df, "snippet.description").alias("description"),
        F.coalesce(tags, F.array().cast("array<string>")).alias("tags"),
        text_field(df, "snippet.categoryId").alias("categoryId"),
        count_or_zero(text_field(df, "statistics.likeCount")).alias("likeCount"),
        count_or_zero(text_field(df, "statistics.commentCount")).alias("commentCount"),
    )
    carried = [c for c in df.columns if c not in ("id", "snippet", "statistics")]
    return df.select(
        *carried,
        F.lit("youtube").alias("platform"),
        text_field(df, "id").alias("id"),
        text_field(df, "snippet.title").alias("title"),
        text_field(df, "snippet.channelTitle").alias("channel"),
        count_or_zero(text_field(df, "statistics.viewCount")).alias("views"),
        text_field(df, "snippet.publishedAt").alias("published_at"),
        extra.alias("source_extra"),
    )


def _is_valid() -> Column:
    return (F.coalesce("platform", F.lit("")) == "youtube") & (F.coalesce("id", F.lit("")) != "")


def valid_items_filter(df: DataFrame) -> DataFrame:
    """Rows of the expected platform with an id; all item columns must be there."""
    missing = [c for c in ITEM_FIELDS if c not in df.columns]
    if missing:
        raise ValueError(f"missing item columns: {missing}")
    return df.filter(_is_valid())


def with_query_spec(df: DataFrame, specs: DataFrame) -> DataFrame:
    """Add ``query_priority`` and ``min_views`` of the row's query; unknown queries go."""
    wanted = one_spec_per_query(specs).select("query", F.col("priority").alias("query_priority"), "min_views")
    return lookup_join(df, wanted, ["query"], "inner")


def min_views_filter(df: DataFrame, specs: DataFrame) -> DataFrame:
    """Rows with at least the ``min_views`` of their query."""
    joined = with_query_spec(df, specs)
    return joined.filter(F.col("views") >= F.col("min_views")).drop("query_priority", "min_views")


def attribute_query(df: DataFrame, specs: DataFrame) -> DataFrame:
    """Rows that pass ``min_views_filter``, with the query and its priority put
    into ``source_extra``."""
    passed = with_query_spec(df, specs).filter(F.col("views") >= F.col("min_views"))
    extra = F.col("source_extra").withField("query", F.col("query"))
    extra = extra.withField("query_priority", F.col("query_priority"))
    return passed.withColumn("source_extra", extra).drop("query_priority", "min_views")


def quality_filter(
    df: DataFrame,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    rescore: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Apply the caller's filter (default: rows with a title), then the caller's
    rescoring (default: none)."""
    kept = df.transform(keep) if keep else df.filter(F.coalesce("title", F.lit("")) != "")
    return kept.transform(rescore) if rescore else kept


def master_projection(
    df: DataFrame,
    niche: str = "",
    lang: str = "",
    rights: str = "",
    usage_strategy: str = "",
    carry: list[str] | None = None,
    canonical: bool = False,
) -> DataFrame:
    """The strict six source columns with canonical URLs; unresolved rows go.

    ``carry`` names further columns to keep, such as the title or the order.
    ``canonical`` says that the URLs are canonical already.
    """
    url = F.col("source_url") if canonical else canonical_watch_url(F.col("source_url"))
    defaults = {"niche": niche, "lang": lang, "rights": rights, "usage_strategy": usage_strategy}
    return df.select(
        url.alias("source_url"),
        *[F.lit(value).alias(name) for name, value in defaults.items()],
        F.lit("YOUTUBE").alias("origin_platform"),
        *(carry or []),
    ).filter(F.col("source_url").isNotNull())


def duration_seconds(duration: Column) -> Column:
    """Seconds of an ISO-8601 duration of days, hours, minutes and seconds, else null."""
    pattern = r"^P(?:([0-9]+)D)?(?:T(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?)?$"
    total = F.lit(0).cast("bigint")
    for group, unit in ((1, 86400), (2, 3600), (3, 60), (4, 1)):
        total = total + count_or_zero(F.regexp_extract(duration, pattern, group)) * unit
    return F.when(duration.rlike(pattern), total)


def duration_views_filter(
    df: DataFrame, min_views: int = 1000, min_seconds: int = 60, max_seconds: int = 1800
) -> DataFrame:
    """Rows of enough views and middling ``duration``; add ``duration_sec`` and ``score``.

    The score is views in thousands, rounded half up to two places in whole numbers.
    """
    timed = df.withColumn("duration_sec", duration_seconds(F.col("duration")))
    kept = timed.filter(
        (F.col("views") >= min_views) & F.col("duration_sec").between(min_seconds, max_seconds)
    )
    return kept.withColumn("score", F.floor((F.col("views") + 5) / 10) / F.lit(100.0))


def query_stats(df: DataFrame, specs: DataFrame) -> DataFrame:
    """Per query spec: distinct ids, valid items, items with enough views.

    Rows are first summed per (query, id), so that a query with a large share of
    the rows is spread over its ids; queries without rows get zeros.
    """
    specs = one_spec_per_query(specs)
    limits = specs.select("query", F.col("min_views").alias("_min"))
    counted = lookup_join(df, limits, ["query"], "inner")
    per_id = counted.groupBy("query", F.nullif(F.col("id"), F.lit("")).alias("id")).agg(
        F.count_if(_is_valid()).alias("valid"),
        F.count_if(_is_valid() & (F.col("views") >= F.col("_min"))).alias("passed"),
    )
    per_query = per_id.groupBy("query").agg(
        F.count("id").alias("ids"),
        F.sum("valid").alias("valid_items"),
        F.sum("passed").alias("min_views_filtered_items"),
    )
    numbers = ["ids", "valid_items", "min_views_filtered_items"]
    return specs.join(per_query, "query", "left").select(
        *[c for c in specs.columns if c != ORD],
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers],
    )


def run_summary(counts: dict[str, DataFrame | Column]) -> DataFrame:
    """``(metric, value)`` rows in the given order.

    A DataFrame stands for its row count, a column (such as another frame's
    ``scalar()``) for itself. All are evaluated within the one query.
    """
    first = next(v for v in counts.values() if isinstance(v, DataFrame))
    values = {
        name: (v.agg(F.count("*").alias("n")).scalar() if isinstance(v, DataFrame) else v)
        for name, v in counts.items()
    }
    one = first.sparkSession.range(1).select(
        *[F.coalesce(v.cast("bigint"), F.lit(0)).alias(name) for name, v in values.items()]
    )
    return one.unpivot([], list(values), "metric", "value")

"""Video metadata pages landed as JSON lines.

Pages of one kind are read by a schema. A folder in which search, channel, playlist and
detail pages lie together has no one schema, since their items differ in what ``id`` is;
such pages are parsed as VARIANT, and each field is looked for where its kind of page has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from content_signals.constants import ORD
from content_signals.functions.fields import text_field
from content_signals.functions.urls import canonical_watch_url
from content_signals.plans.order import file_order

SEARCH_PAGE = (
    "query string, page int, nextPageToken string, items array<struct<"
    "id: struct<videoId: string>, "
    "snippet: struct<title: string, publishedAt: string, channelTitle: string>>>"
)
PLAYLIST_PAGE = (
    "query string, page int, nextPageToken string, items array<struct<"
    "snippet: struct<title: string, publishedAt: string, videoOwnerChannelTitle: string, "
    "resourceId: struct<videoId: string>>>>"
)
DETAILS_PAGE = (
    "query string, page int, items array<struct<id: string, "
    "snippet: struct<title: string, channelTitle: string, publishedAt: string, "
    "description: string, categoryId: string, tags: array<string>>, "
    "statistics: struct<viewCount: string, likeCount: string, commentCount: string>>>"
)


#: What a mixed page says its items were found by, in the order in which collections are put together.
PAGE_KINDS = ("query", "channel", "playlist")


def read_pages(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Landed pages with ``_ord``, by one of the schemas above."""
    return spark.read.schema(schema).json(path).withColumn(ORD, file_order())


def page_items(pages: DataFrame) -> DataFrame:
    """One row per item: the page's columns, ``pos``, the item's fields.

    ``_ord`` becomes the page's order followed by the place within the page.
    """
    carried = [c for c in pages.columns if c not in ("items", ORD)]
    placed = pages.select(*carried, F.col(ORD).alias("_page"), F.posexplode("items").alias("pos", "item"))
    return placed.select(
        *carried,
        "pos",
        "item.*",
        F.struct(F.col("_page").alias("page"), F.col("pos").cast("bigint").alias("row")).alias(ORD),
    )


def search_hits(pages: DataFrame) -> DataFrame:
    """``(query, page, id, _ord)`` of search pages; an item without an id keeps its row."""
    return page_items(pages).select("query", "page", F.col("id.videoId").alias("id"), ORD)


def video_items_from_json(pages: DataFrame, source: str = "query") -> DataFrame:
    """``(source, source_url, title, published_at, channel, id, _ord)`` of search,
    channel or playlist pages; items without an id go."""
    items = page_items(pages)
    video_id = text_field(items, "id.videoId", "snippet.resourceId.videoId")
    return items.select(
        F.col(source).alias("source"),
        canonical_watch_url(video_id).alias("source_url"),
        text_field(items, "snippet.title").alias("title"),
        text_field(items, "snippet.publishedAt").alias("published_at"),
        text_field(items, "snippet.videoOwnerChannelTitle", "snippet.channelTitle").alias("channel"),
        video_id.alias("id"),
        ORD,
    ).filter(F.col("source_url").isNotNull())


def read_mixed_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(page_json, _ord)``: landed pages of any kind as VARIANT; a line that is no JSON object goes."""
    lines = spark.read.text(path).withColumn(ORD, file_order())
    parsed = lines.select(F.try_parse_json("value").alias("page_json"), ORD)
    return parsed.filter(F.schema_of_variant("page_json").startswith("OBJECT"))


def _string(value: str, path: str) -> Column:
    """A field that is text; null for any other, which a cast would turn into text."""
    field = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(field) == "STRING", F.try_variant_get(value, path, "string"))


def mixed_items(pages: DataFrame) -> DataFrame:
    """One row per item of mixed pages: ``(kind, source, page, pos, item, _ord)``.

    ``kind`` is the first of ``query``, ``channel`` and ``playlist`` that the page names as text,
    ``source`` that text; a page that names none, such as one of details, has neither.
    Pages without an array of items have no rows.
    """
    found = [(kind, _string("page_json", f"$.{kind}")) for kind in PAGE_KINDS]
    named = F.coalesce(
        *[F.when(text.isNotNull(), F.struct(F.lit(k).alias("kind"), text.alias("source"))) for k, text in found]
    )
    items = F.try_variant_get("page_json", "$.items", "array<variant>")
    placed = pages.select(
        named.alias("named"),
        F.try_variant_get("page_json", "$.page", "int").alias("page"),
        F.col(ORD).alias("_page"),
        F.posexplode(items).alias("pos", "item"),
    )
    return placed.select(
        "named.kind",
        "named.source",
        "page",
        "pos",
        "item",
        F.struct(F.col("_page").alias("page"), F.col("pos").cast("bigint").alias("row")).alias(ORD),
    )


def mixed_video_items(pages: DataFrame) -> DataFrame:
    """``(kind, source, source_url, title, published_at, channel, id, _ord)`` of mixed pages.

    The id is that of a search hit, of a playlist entry, or the item's own; items without one go.
    """

    def first(*paths: str) -> Column:
        return F.coalesce(*[_string("item", path) for path in paths])

    def text(*paths: str) -> Column:
        return F.coalesce(first(*paths), F.lit(""))

    items = mixed_items(pages).withColumn("id", first("$.id.videoId", "$.snippet.resourceId.videoId", "$.id"))
    return items.select(
        "kind",
        "source",
        canonical_watch_url(F.col("id")).alias("source_url"),
        text("$.snippet.title").alias("title"),
        text("$.snippet.publishedAt").alias("published_at"),
        text("$.snippet.videoOwnerChannelTitle", "$.snippet.channelTitle").alias("channel"),
        "id",
        ORD,
    ).filter(F.col("source_url").isNotNull())

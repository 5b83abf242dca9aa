"""Video links out of crawled pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from content_signals.constants import WATCH_PREFIX
from content_signals.functions.html import anchors
from content_signals.functions.urls import canonical_watch_url

# What a watch link holds, and how its id looks in raw text.
WATCH_LINK = "/watch?v="
_RAW_WATCH_ID = r"/watch\?v=([A-Za-z0-9_-]{6,})"


def _first_per_url(df: DataFrame) -> DataFrame:
    """Drop from the array ``_links`` every link whose URL came earlier in it.

    Sorted by URL and place, a link is a repeat if its neighbour has the same
    URL: n log n for a page of n links. The sorted array is a column of its own,
    so that it is not worked out again for each link.
    """
    by_url = F.transform(
        "_links",
        lambda x, i: F.struct(
            x["source_url"].alias("source_url"), i.alias("place"), x["title"].alias("title")
        ),
    )
    keyed = df.withColumn("_keyed", F.array_sort(by_url))
    firsts = F.filter(
        "_keyed",
        lambda x, i: (i == 0)
        | (x["source_url"] != F.get(F.col("_keyed"), i - 1)["source_url"]),
    )
    in_page_order = F.transform(
        firsts,
        lambda x: F.struct(
            x["place"].alias("place"),
            x["source_url"].alias("source_url"),
            x["title"].alias("title"),
        ),
    )
    return keyed.withColumn("_links", F.array_sort(in_page_order)).drop("_keyed")


def extract_page_links(
    df: DataFrame,
    link_part: str = WATCH_LINK,
    max_results: int | None = None,
    canonical: bool = True,
    raw_pattern: bool = False,
) -> DataFrame:
    """``(page_id, pos, source_url, title)`` of the links on each page.

    Anchors whose address holds ``link_part``, each URL once per page, the first
    ``max_results`` of a page in page order, if given. ``canonical``
    rewrites to watch URLs and drops links without an id. ``raw_pattern`` looks
    for watch links in the raw text instead, with blank titles.

    All of it happens within the page's row: no shuffle, and the HTML is not kept.
    """
    if raw_pattern:
        ids = F.regexp_extract_all("html", F.lit(_RAW_WATCH_ID), F.lit(1))
        found = F.transform(
            ids,
            lambda x: F.struct(
                F.concat(F.lit(WATCH_PREFIX), x).alias("source_url"), F.lit("").alias("title")
            ),
        )
    else:
        linked = F.filter(
            anchors(F.col("html"), link_part), lambda x: x["href"].contains(link_part)
        )
        resolved = F.transform(
            linked,
            lambda x: F.struct(
                (
                    canonical_watch_url(x["href"]) if canonical else F.nullif(x["href"], F.lit(""))
                ).alias("source_url"),
                x["title"].alias("title"),
            ),
        )
        found = F.filter(resolved, lambda x: x["source_url"].isNotNull())
    firsts = F.col("_links") if max_results is None else F.slice("_links", 1, max_results)
    # The outer variant: for the inner one Catalyst filters on the size of the array,
    # and to do so works out all of the above once more.
    return (
        _first_per_url(df.select("page_id", found.alias("_links")))
        .select("page_id", F.posexplode_outer(firsts).alias("pos", "_link"))
        .filter(F.col("_link").isNotNull())
        .select("page_id", "pos", F.col("_link.source_url"), F.col("_link.title"))
    )

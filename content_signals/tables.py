"""The driver's tables in the shape the operators take.

The test tables hold no content sources, so every column is derived from a row's
key or text by a plain expression, which the check SQL (``oracle.py``) repeats.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from content_signals.constants import ORD
from content_signals.plans.staging import stage
from content_signals.sources.templates import templates_from_dict

AS_OF = datetime(2026, 6, 1)

SAMPLE_TEMPLATE = {
    "base_prompt": {
        "role": "You edit short clips for a curious audience.",
        "rules": ["Say where it came from", "Use new words", "Open with a question"],
        "format": "One script, under a minute",
    },
    "content_goals": {
        "viral": {"objective": "Make people share the clip with a friend.", "tone": "Lively"},
        "education": {"objective": "Make one idea easy to grasp.", "tone": "Calm"},
    },
    "transformation_levels": {
        "rewrite": "Tell it afresh, with examples of your own.",
        "inspire": "Take the lesson and tell another story.",
        "repost": "Keep the message, change the style.",
    },
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; how its scan is split is the session's to say."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, values: list[str | None]) -> Column:
    """Value number ``key mod n``."""
    place = F.pmod(key, F.lit(len(values)))
    out = F.when(place == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        out = out.when(place == i, value)
    return out


def _div(key: Column, n: int) -> Column:
    return F.floor(key / n).cast("string")


NICHES = ["", "business", " Health ", "MOTIVATION", "self-help", "o'neil story"]
STRATEGIES = ["viral", "Education", "inspiration", "unknown", ""]
MANUAL_SCORES = ["", "92", "abc", " 45.7 ", "-5", "1e12", "92f"]
LEGACY_RIGHTS = ["rewrite_required", " SUMMARY_ONLY ", "original_allowed", "FREE_REPOST", ""]
KEYWORDS = ["business", "Fitness", "histoire", "tutorial", ""]
URL_STEMS = [
    "https://www.youtube.com/watch?v=video_",
    "https://youtu.be/video_",
    "https://www.tiktok.com/@maker/video/",
    "https://example.org/posts/",
]


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content sources out of ``documents`` and ``labels``; ``_ord`` is the doc_id."""
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.max("quality").alias("quality")
    )
    docs = _table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    key = F.col("doc_id")
    hours = F.pmod(key, F.lit(20000))
    ts = F.timestamp_seconds(F.lit(1704067200) + hours * 3600)
    dated = (
        F.when(key % 11 == 0, None)
        .when(key % 13 == 0, "unknown")
        .when(key % 3 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 3 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(ts, "yyyy/MM/dd"))
    )
    rights = (
        F.when(F.col("toxic") == 1, "AVOID")
        .when(F.col("quality") == 1, "FREE_REPOST")
        .when(F.col("quality") == 0, " inspire_only ")
        .otherwise("")
    )
    return docs.select(
        key.alias(ORD),
        F.concat(_pick(key, URL_STEMS), _div(key, 8)).alias("source_url"),
        _pick(key, NICHES).alias("niche"),
        F.col("lang").alias("lang"),
        rights.alias("rights"),
        _pick(key, STRATEGIES).alias("usage_strategy"),
        F.when(key % 9 == 0, " Instagram ").otherwise("").alias("origin_platform"),
        _pick(key, MANUAL_SCORES).alias("manual_score"),
        F.when(key % 3 == 0, F.col("source")).otherwise("").alias("title"),
        F.col("text").alias("notes"),
        dated.alias("published_at"),
    )


def legacy_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose rights bear the earlier names, some of them unknown."""
    return sources(spark, sf_dir).withColumn("rights", _pick(F.col(ORD), LEGACY_RIGHTS))


def keyword_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources without a given niche on most rows, and with raw text to tell it from."""
    key = F.col("doc_id")
    return _table(spark, sf_dir, "documents").select(
        key.alias(ORD),
        _pick(key, ["", " ", "story "] + [""] * 4).alias("niche"),
        F.concat(F.col("text"), F.lit(" "), _pick(key, KEYWORDS)).alias("raw_text"),
    )


LINKS = [
    "",
    "/watch?v=vid{k}&t=3",
    "https://anything.example/watch?t=1&v=vid%20{k}+x#top",
    "https://x.example/watch?v=",
    "https://youtu.be/clip_{k}?si=1",
    "https://youtu.be/abc",
    "https://x.example/shorts/clip-{k}",
    "https://x.example/embed/clip-{k}",
    "bare{k}",
    None,
]


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(_ord, source_url, title)``: links of every kind, one per document."""
    key = F.col("doc_id")
    pattern = _pick(key, LINKS)
    return _table(spark, sf_dir, "documents").select(
        key.alias(ORD),
        F.replace(pattern, F.lit("{k}"), _div(key, 20)).alias("source_url"),
        F.col("source").alias("title"),
    )


def _video_id(key: Column) -> Column:
    return F.when(key % 17 == 0, "").otherwise(F.concat(F.lit("v"), _div(key, 2)))


def video_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail item per event: ``(_ord, query, id, snippet, statistics)``."""
    key, user = F.col("event_id"), F.col("user_id").cast("string")
    views = F.floor(F.col("value") * 100).cast("string")
    return _table(spark, sf_dir, "events").select(
        key.alias(ORD),
        F.col("event_type").alias("query"),
        _video_id(key).alias("id"),
        F.struct(
            F.when(key % 13 == 0, "").otherwise(F.concat(F.lit("Clip "), key)).alias("title"),
            F.concat(F.lit("channel "), user).alias("channelTitle"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.col("props").alias("description"),
            F.get_json_object("props", "$.k").alias("categoryId"),
            F.when(key % 2 == 0, F.array("event_type", user)).alias("tags"),
        ).alias("snippet"),
        F.struct(
            F.when(key % 19 == 0, "n/a").otherwise(views).alias("viewCount"),
            user.alias("likeCount"),
            F.when(key % 7 != 0, (key % 100).cast("string")).alias("commentCount"),
        ).alias("statistics"),
    )


def query_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One spec per event type; half of a query's hits are wanted."""
    grouped = _table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("query"))
    counted = grouped.agg(F.min("event_id").alias(ORD), F.count("*").alias("n"))
    specs = counted.select(
        "query",
        F.when(F.col("query") == "purchase", "HIGH").otherwise("MEDIUM").alias("priority"),
        F.floor(F.col("n") / 2).alias("max_results"),
        (F.length("query") * 2500).cast("bigint").alias("min_views"),
        ORD,
    )
    return stage(specs, "query-specs")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages")


def sample_templates(spark: SparkSession) -> DataFrame:
    return templates_from_dict(spark, SAMPLE_TEMPLATE)

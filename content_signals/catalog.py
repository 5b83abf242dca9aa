"""Every operator as a query over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from content_signals import tables as t
from content_signals.constants import ORD, READY_COLUMNS
from content_signals.functions.urls import (
    canonical_watch_url,
    channel_id,
    channel_videos_url,
    extract_video_id,
    playlist_id,
    search_url,
)
from content_signals.operators import checks, classify as c, dedup as d, links as li
from content_signals.operators import normalize as n, payload as g, prompts as p, ranking as o
from content_signals.operators import requests as r, sinks as w, trends as tr, videos as v
from content_signals.plans import link_collection, ready_prompts, trend_report, video_collection
from content_signals.plans.order import add_position
from content_signals.plans.staging import new_path, stage
from content_signals.sources import csv_files, landed_json, query_specs, templates
from content_signals.streaming import link_drops

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # the tables' times are UTC
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _docs(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns under the document's key."""
    return df.select(F.col(ORD).alias("doc_id"), *columns)


def _events(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.col(ORD).alias("event_id"), *columns)


# --- sources ---------------------------------------------------------------


@query
def read_sources(spark, sf_dir):
    """Write the sources as CSV, read them back."""
    path = w.write_csv(t.sources(spark, sf_dir), new_path(spark, "sources-csv"))
    return csv_files.read_sources(spark, path).drop(ORD)


@query
def add_defaults(spark, sf_dir):
    given = t.sources(spark, sf_dir).drop("notes", "title", "published_at")
    out = csv_files.add_defaults(given)
    return _docs(out, "origin_platform", "prompt_template", "processed", "notes", "source_file")


@query
def read_sources_dir(spark, sf_dir):
    """Two groups of CSV files with differing headers in one folder."""
    path = new_path(spark, "sources-dir")
    given = t.sources(spark, sf_dir).drop("notes")
    titled = F.col("title") != ""
    w.write_csv(given.filter(titled).select("source_url", "title", "niche"), path)
    untitled = given.filter(~titled).select("source_url", "niche", "lang", "rights")
    w.write_csv(untitled, path, mode="append")
    out = csv_files.read_sources_dir(spark, path, "part-*.csv", mixed_headers=True)
    named = F.col("source_file").startswith("part-").alias("from_part")
    return out.select("source_url", "title", "niche", "lang", "rights", named)


@query
def read_query_specs(spark, sf_dir):
    """A spec per document, with blank and junk cells, by way of CSV."""
    key = F.col(ORD)
    specs = t.sources(spark, sf_dir).select(
        F.when(F.col("lang") == "de", "  ").otherwise(F.concat(F.lit(" topic "), key)).alias("query"),
        F.when(key % 4 == 0, " high ").when(key % 4 == 1, "").otherwise("Low").alias("priority"),
        F.element_at(F.array(*map(F.lit, ["0", "abc", "-1", "15", ""])), (key % 5 + 1).cast("int"))
        .alias("max_results"),
        F.when(key % 3 == 0, "many").otherwise(key.cast("string")).alias("min_views"),
    )
    path = w.write_csv(specs, new_path(spark, "specs-csv"))
    return query_specs.read_query_specs(spark, path).drop(ORD)


def _landed_search(spark, sf_dir) -> DataFrame:
    """Events as landed search pages of up to fifty items."""
    details = t.video_details(spark, sf_dir)
    item = F.struct(
        F.struct(F.nullif(F.col("id"), F.lit("")).alias("videoId")).alias("id"),
        F.struct("snippet.title", "snippet.publishedAt", "snippet.channelTitle").alias("snippet"),
    )
    grouped = details.groupBy("query", F.floor(F.col(ORD) / 50).cast("int").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(ORD).alias("place"), item.alias("item")))).alias("m")
    )
    paged = grouped.select("query", "page", F.transform("m", lambda x: x["item"]).alias("items"))
    path = new_path(spark, "search-json")
    paged.write.json(path)
    return landed_json.read_pages(spark, path, landed_json.SEARCH_PAGE)


def _landed_details(spark, sf_dir) -> DataFrame:
    """The events' details as landed pages of up to fifty items."""
    details = t.video_details(spark, sf_dir)
    item = F.struct(F.col(ORD).alias("place"), F.struct("id", "snippet", "statistics").alias("item"))
    grouped = details.groupBy(F.floor(F.col(ORD) / 50).cast("int").alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("m")
    )
    paged = grouped.select("page", F.transform("m", lambda x: x["item"]).alias("items"))
    path = new_path(spark, "details-json")
    paged.write.json(path)
    return landed_json.read_pages(spark, path, landed_json.DETAILS_PAGE)


@query
def video_items_from_json(spark, sf_dir):
    items = landed_json.video_items_from_json(_landed_search(spark, sf_dir))
    return items.select(
        F.col("source").alias("query"), "source_url", "title", "published_at", "channel", "id"
    )


def _landed_mixed(spark, sf_dir) -> DataFrame:
    """Events as landed pages of all kinds in one folder: hits of queries and channels, entries of
    playlists, and details; their items hold the id in three places."""
    details = t.video_details(spark, sf_dir).withColumn("kind", F.pmod(ORD, F.lit(4)))
    snippet = [F.col("snippet.title"), F.col("snippet.publishedAt")]
    channel = F.col("snippet.channelTitle")
    video_id = F.nullif(F.col("id"), F.lit(""))
    hit = F.struct(F.struct(video_id.alias("videoId")).alias("id"), F.struct(*snippet, channel).alias("snippet"))
    entry = F.struct(*snippet, channel.alias("videoOwnerChannelTitle"), F.struct(video_id.alias("videoId")).alias("resourceId"))
    detail = F.struct(video_id.alias("id"), F.struct(*snippet, channel).alias("snippet"))
    item = (
        F.when(F.col("kind") < 2, F.to_json(hit))
        .when(F.col("kind") == 2, F.to_json(F.struct(entry.alias("snippet"))))
        .otherwise(F.to_json(detail))
    )
    named = F.element_at(F.array(*map(F.lit, ["query", "channel", "playlist", "about"])), (F.col("kind") + 1).cast("int"))
    paged = (
        details.groupBy("query", "kind", F.floor(F.col(ORD) / 200).alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col(ORD).alias("place"), item.alias("item")))).alias("m"))
        .withColumn("items", F.array_join(F.transform("m", lambda x: x["item"]), ","))
    )
    line = F.format_string('{"%s": "%s", "page": %d, "items": [%s]}', named, "query", "page", "items")
    path = new_path(spark, "mixed-json")
    paged.select(line.alias("value")).union(spark.range(1).select(F.lit("no JSON"))).write.text(path)
    pages = landed_json.read_mixed_pages(spark, path)
    number = F.try_variant_get("page_json", "$.page", "int").alias("page")
    kind = F.coalesce(*[F.try_variant_get("page_json", f"$.{k}", "string") for k in ("query", "channel", "playlist", "about")])
    return pages.withColumn(ORD, F.struct(kind.alias("source"), number))


@query
def mixed_video_items(spark, sf_dir):
    """Search, channel, playlist and detail pages out of one folder."""
    items = landed_json.mixed_video_items(_landed_mixed(spark, sf_dir))
    return items.select("kind", "source", "source_url", "title", "published_at", "channel", "id")


@query
def run_landed_collection(spark, sf_dir):
    """Landed pages of all kinds to strict source rows, ten records of each source, each video once."""
    records = link_collection.landed_records(_landed_mixed(spark, sf_dir), max_results=10)
    return link_collection.links_to_master(records, carry=["title"])


@query
def ingest_link_drops(spark, sf_dir):
    """Page URLs and junk lines as dropped text files, taken in by a stream."""
    link = F.concat(F.lit("  "), "url", F.lit("\t"))
    junk = F.concat(F.lit("see "), "url")
    lines = t.pages(spark, sf_dir).select(F.explode(F.array(link, junk, F.lit(""))).alias("value"))
    folder = new_path(spark, "drops")
    lines.write.text(folder)
    table = new_path(spark, "dropped-sources")
    link_drops.ingest_link_drops(spark, folder, table, new_path(spark, "drops-checkpoint"))
    return spark.read.parquet(table).drop("added_at")


# --- dedup, padding, limits ------------------------------------------------


@query
def dedup_sources(spark, sf_dir):
    return _docs(d.dedup_sources(t.sources(spark, sf_dir)), "source_url", "title")


@query
def dedup_by_watch_url(spark, sf_dir):
    return _docs(d.dedup_by_watch_url(t.sources(spark, sf_dir)), "source_url", "title")


def _videos(spark, sf_dir) -> DataFrame:
    return v.normalize_videos(t.video_details(spark, sf_dir))


@query
def dedup_video_ids(spark, sf_dir):
    return _events(d.dedup_video_ids(_videos(spark, sf_dir)), "id", "query", "title", "views")


@query
def pad_to_minimum(spark, sf_dir):
    """One record per language; there are fewer than ten, so seeds are added."""
    langs = t.sources(spark, sf_dir).groupBy("lang").agg(F.min(ORD).alias(ORD))
    records = langs.select(
        F.concat(F.lit("https://youtu.be/lang-"), "lang").alias("source_url"), ORD
    )
    return d.pad_to_minimum(v.master_projection(records))


@query
def top_n_per_query(spark, sf_dir):
    hits = t.video_details(spark, sf_dir)
    top = d.top_n_per_query(hits, t.query_specs(spark, sf_dir))
    return _events(top, "query", "id")


@query
def first_pages_per_query(spark, sf_dir):
    """The same within three landed pages, whose sizes differ."""
    hits = t.video_details(spark, sf_dir).withColumn("page", F.floor(F.col(ORD) / 50).cast("int"))
    top = d.top_n_per_query(hits, t.query_specs(spark, sf_dir), max_pages=3)
    return _events(top, "query", "id")


@query
def concat_collections(spark, sf_dir):
    videos = _videos(spark, sf_dir)
    blank = F.when(F.col("views") < 5000, " ")
    parts = [
        videos.select(source.alias("source"), "id", ORD)
        for source in (
            F.col("query"),
            F.coalesce(blank, F.col("channel")),
            F.concat(F.lit("list-"), F.col("source_extra.categoryId")),
        )
    ]
    out = d.concat_collections(*parts)
    place = F.col(ORD)
    return out.select("source", "id", place["kind"].alias("kind"), place["row"].alias("event_id"))


# --- projections, filters --------------------------------------------------


@query
def resolve_content_url(spark, sf_dir):
    return _docs(n.resolve_content_url(t.links(spark, sf_dir), strict=True), "content_url")


@query
def min_views_filter(spark, sf_dir):
    out = v.min_views_filter(_videos(spark, sf_dir), t.query_specs(spark, sf_dir))
    return _events(out, "query", "id", "views")


@query
def valid_items_filter(spark, sf_dir):
    return _events(v.valid_items_filter(_videos(spark, sf_dir)), "platform", "id")


@query
def quality_filter(spark, sf_dir):
    """The default filter, then a caller's rescoring."""
    out = v.quality_filter(
        _videos(spark, sf_dir), rescore=lambda df: df.withColumn("views", F.col("views") * 2)
    )
    return _events(out, "id", "title", "views")


def _prepared(spark, sf_dir) -> DataFrame:
    return ready_prompts.prepare_prompts(t.sources(spark, sf_dir), t.sample_templates(spark))


@query
def ready_projection(spark, sf_dir):
    return o.ready_projection(_prepared(spark, sf_dir))


@query
def prompts_projection(spark, sf_dir):
    return o.prompts_projection(_prepared(spark, sf_dir))


@query
def master_projection(spark, sf_dir):
    out = v.master_projection(
        t.links(spark, sf_dir), niche="STORY", lang="EN", carry=[ORD, "title"]
    )
    return out.withColumnRenamed(ORD, "doc_id")


@query
def duration_views_filter(spark, sf_dir):
    key = F.col(ORD)
    duration = F.concat(
        F.lit("PT"),
        F.when(key % 10 == 0, "1H").otherwise(""),
        F.when(key % 4 != 0, F.concat((key % 40).cast("string"), F.lit("M"))).otherwise(""),
        F.concat((key % 60).cast("string"), F.lit("S")),
    )
    timed = _videos(spark, sf_dir).withColumn("duration", duration)
    return _events(v.duration_views_filter(timed), "id", "views", "duration_sec", "score")


# --- text, URL and JSON columns --------------------------------------------


@query
def normalize_text(spark, sf_dir):
    out = n.normalize_text(t.sources(spark, sf_dir))
    return _docs(out, "niche", "lang", "rights", "usage_strategy", "origin_platform", "notes")


@query
def derive_raw_text(spark, sf_dir):
    out = n.derive_raw_text(n.resolve_content_url(t.sources(spark, sf_dir)))
    return _docs(out, "content_url", "raw_text")


@query
def derive_raw_text_draft(spark, sf_dir):
    return _docs(n.derive_raw_text(t.sources(spark, sf_dir), draft=True), "raw_text")


@query
def infer_platform(spark, sf_dir):
    out = c.infer_platform(n.normalize(t.sources(spark, sf_dir)))
    return _docs(out, "content_url", "origin_platform")


@query
def normalize_rights(spark, sf_dir):
    return _docs(c.normalize_rights(t.sources(spark, sf_dir)), "rights")


@query
def normalize_strategy(spark, sf_dir):
    return _docs(c.normalize_strategy(t.sources(spark, sf_dir)), "usage_strategy")


@query
def infer_niche(spark, sf_dir):
    return _docs(c.infer_niche(t.keyword_sources(spark, sf_dir)), "niche")


@query
def extract_video_id_query(spark, sf_dir):
    out = t.links(spark, sf_dir).withColumn("video_id", extract_video_id(F.col("source_url")))
    return _docs(out, "source_url", "video_id")


@query
def canonical_watch_url_query(spark, sf_dir):
    out = t.links(spark, sf_dir).withColumn("watch_url", canonical_watch_url(F.col("source_url")))
    return _docs(out, "source_url", "watch_url")


@query
def extract_page_links(spark, sf_dir):
    """All links of the crawled pages; these pages hold no watch links."""
    return li.extract_page_links(
        t.pages(spark, sf_dir), link_part="/", max_results=None, canonical=False
    )


def _watch_pages(spark, sf_dir) -> DataFrame:
    """The pages with their site links turned into watch links."""
    html = F.regexp_replace("html", r'href="/([^"]*)"', 'class=x href="/watch?v=$1&amp;t=1"')
    return t.pages(spark, sf_dir).select("page_id", html.alias("html"))


@query
def extract_watch_links(spark, sf_dir):
    return li.extract_page_links(_watch_pages(spark, sf_dir))


@query
def extract_raw_watch_links(spark, sf_dir):
    return li.extract_page_links(_watch_pages(spark, sf_dir), raw_pattern=True)


@query
def search_urls(spark, sf_dir):
    """Search address of every document's whole text."""
    out = t.sources(spark, sf_dir).withColumn("search_url", search_url(F.col("notes")))
    return _docs(out, "search_url")


@query
def source_ids(spark, sf_dir):
    key = F.col("page_id")
    host = F.regexp_extract("url", "^https?://[^/]*", 0)
    given = F.when(key % 4 == 0, F.concat(host, F.lit("/channel/UC_"), key, F.lit("/about")))
    given = given.when(key % 4 == 1, F.concat(F.lit(" UC-"), key)).otherwise(F.col("url"))
    listed = F.when(key % 2 == 0, F.concat("url", F.lit("&list=PL+"), key, F.lit("%21")))
    listed = listed.otherwise(F.concat(F.lit("PL"), key))
    return t.pages(spark, sf_dir).select(
        "page_id",
        channel_id(given).alias("channel_id"),
        playlist_id(listed).alias("playlist_id"),
        channel_videos_url(F.concat("url", F.when(key % 3 == 0, "/videos/").otherwise("//"))).alias(
            "videos_url"
        ),
    )


def _flat_extra(df: DataFrame, *more: str) -> DataFrame:
    extra = F.col("source_extra")
    fields = ["description", "categoryId", "likeCount", "commentCount", *more]
    return _events(
        df,
        "platform", "id", "title", "channel", "views", "published_at",
        *[extra[f].alias(f) for f in fields],
        F.array_join(extra["tags"], ",").alias("tags"),
    )


@query
def normalize_videos(spark, sf_dir):
    return _flat_extra(_videos(spark, sf_dir))


@query
def attribute_query(spark, sf_dir):
    out = v.attribute_query(_videos(spark, sf_dir), t.query_specs(spark, sf_dir))
    return _flat_extra(out, "query", "query_priority")


@query
def seed_fields(spark, sf_dir):
    out = g.seed_fields(n.normalize(t.sources(spark, sf_dir)))
    return _docs(out, "title_seed", "caption_seed", "raw_text")


@query
def ai_payload(spark, sf_dir):
    return _docs(_prepared(spark, sf_dir), "ai_enhancement_payload")


@query
def ai_status(spark, sf_dir):
    return _docs(_prepared(spark, sf_dir), "prompt_generated", "content_ready", "ai_status")


# --- scores ----------------------------------------------------------------


def _classified(spark, sf_dir) -> DataFrame:
    return c.classify(n.normalize(t.sources(spark, sf_dir)))


@query
def priority_score(spark, sf_dir):
    return _docs(_classified(spark, sf_dir), "priority_score")


@query
def manual_score(spark, sf_dir):
    out = _classified(spark, sf_dir)
    return _docs(out, "manual_score", "reviewer_decision", "reviewer_notes", "manual_priority_score")


@query
def blended_score(spark, sf_dir):
    """Over every pair of scores that the table's keys run through, besides its own."""
    key = F.col(ORD)
    pairs = _classified(spark, sf_dir).withColumns(
        {
            "priority_score": F.pmod(key, F.lit(101)).cast("int"),
            "manual_priority_score": F.pmod(F.floor(key / 101) + key * 7, F.lit(101)),
        }
    )
    swept = c.blended_score(pairs).select(ORD, F.col("blended_priority_score").alias("swept"))
    own = _classified(spark, sf_dir).select(ORD, "blended_priority_score")
    return _docs(own.join(swept, ORD), "blended_priority_score", "swept")


@query
def status(spark, sf_dir):
    return _docs(_classified(spark, sf_dir), "rights", "status")


@query
def legacy_score(spark, sf_dir):
    out = c.legacy_score(n.normalize_text(t.sources(spark, sf_dir)), "legacy_score")
    return _docs(out, "legacy_score")


# --- prompts ---------------------------------------------------------------


def _landed_templates(spark, sf_dir) -> DataFrame:
    """A template set per document, by way of JSON lines; some lack optional parts."""
    key = F.col(ORD)
    name = F.concat(F.lit("set-"), key)
    goal = F.struct(F.col("title").alias("objective"), F.col("lang").alias("tone"))
    docs = t.sources(spark, sf_dir).select(
        name.alias("template"),
        F.struct(
            F.when(key % 3 != 0, F.concat(F.lit("Editor of "), "lang")).alias("role"),
            F.when(key % 2 == 0, F.array(F.lit("Be short"), F.col("notes"))).alias("rules"),
            F.when(key % 5 != 0, F.lit("Plain text")).alias("format"),
        ).alias("base_prompt"),
        F.create_map(F.lit("viral"), goal, F.concat(F.lit("goal-"), "lang"), goal).alias(
            "content_goals"
        ),
        F.create_map(F.lit("rewrite"), F.col("source_url")).alias("transformation_levels"),
    )
    path = new_path(spark, "templates-json")
    docs.write.json(path)
    return templates.read_templates(spark, path, json_lines=True)


@query
def template_dims(spark, sf_dir):
    dims = templates.template_dims(_landed_templates(spark, sf_dir))
    base = dims["base"].select(
        "template", F.lit("base").alias("dim"), F.col("role").alias("key"),
        F.array_join("rules", "; ").alias("first"), F.col("format").alias("second"),
    )
    goals = dims["goals"].select(
        "template", F.lit("goal").alias("dim"), F.col("strategy").alias("key"),
        F.col("objective").alias("first"), F.col("tone").alias("second"),
    )
    levels = dims["levels"].select(
        "template", F.lit("level").alias("dim"), F.col("level").alias("key"),
        F.col("text").alias("first"), F.lit("").alias("second"),
    )
    return base.unionByName(goals).unionByName(levels)


@query
def template_lookup(spark, sf_dir):
    rows = p.with_template(_classified(spark, sf_dir), t.sample_templates(spark))
    return _docs(p.template_lookup(rows), "objective", "tone", "transformation")


@query
def render_prompt(spark, sf_dir):
    out = p.render_prompt(_classified(spark, sf_dir), t.sample_templates(spark))
    return _docs(out, "final_prompt")


@query
def render_prompt_by_template(spark, sf_dir):
    """Each row under a template set of its own choice; unknown ones fall back."""
    sets = stage(_landed_templates(spark, sf_dir).unionByName(t.sample_templates(spark)), "sets")
    key = F.col(ORD)
    chosen = F.when(key % 4 == 0, "nowhere").otherwise(F.concat(F.lit("set-"), F.floor(key / 2)))
    rows = _classified(spark, sf_dir).withColumn("prompt_template", chosen)
    return _docs(p.render_prompt(rows, sets, hint=None, per_row_template=True), "final_prompt")


@query
def prompt_quality(spark, sf_dir):
    return _docs(_prepared(spark, sf_dir), "prompt_quality_flags", "prompt_quality_score")


@query
def ready_flags(spark, sf_dir):
    return _docs(_prepared(spark, sf_dir), "status", "prompt_generated", "content_ready")


@query
def render_prompt_legacy(spark, sf_dir):
    rows = n.resolve_content_url(t.legacy_sources(spark, sf_dir))
    out = p.render_prompt_legacy(rows, templates.legacy_default_templates(spark))
    return _docs(out, "final_prompt", "prompt_generated", "content_ready")


@query
def render_prompt_draft(spark, sf_dir):
    rows = n.resolve_content_url(t.sources(spark, sf_dir))
    return _docs(p.render_prompt_draft(rows, t.sample_templates(spark)), "final_prompt")


# --- trends ----------------------------------------------------------------


@query
def recency_score(spark, sf_dir):
    return _docs(tr.recency_score(t.sources(spark, sf_dir), t.AS_OF), "recency_score")


@query
def extract_keywords(spark, sf_dir):
    out = tr.extract_keywords(t.sources(spark, sf_dir))
    return _docs(out, F.array_join("keywords", " ").alias("keywords"))


@query
def token_counts(spark, sf_dir):
    return tr.token_counts(t.sources(spark, sf_dir))


@query
def frequency_score(spark, sf_dir):
    return _docs(tr.frequency_score(t.sources(spark, sf_dir)), "frequency_score")


@query
def frequency_score_text_only(spark, sf_dir):
    """Over text without URL and niche and few hot keywords, so that most rows
    take the join on keyword."""
    texts = t.sources(spark, sf_dir).select(ORD, "notes")
    return _docs(tr.frequency_score(texts, hot_keywords=2), "frequency_score")


@query
def multi_source_score(spark, sf_dir):
    return _docs(tr.multi_source_score(t.sources(spark, sf_dir)), "multi_source_score")


def _trends(spark, sf_dir) -> DataFrame:
    return trend_report.trend_report(t.sources(spark, sf_dir), t.AS_OF)


@query
def trend_score(spark, sf_dir):
    return _docs(tr.trend_score(t.sources(spark, sf_dir), t.AS_OF), "trend_score")


@query
def priority_level(spark, sf_dir):
    return _docs(_trends(spark, sf_dir), "priority_level")


@query
def priority_counts(spark, sf_dir):
    return tr.priority_counts(_trends(spark, sf_dir))


# --- run statistics, requests ----------------------------------------------


@query
def query_stats(spark, sf_dir):
    return v.query_stats(_videos(spark, sf_dir), t.query_specs(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    videos = _videos(spark, sf_dir)
    unique = d.dedup_video_ids(videos)
    quota = r.quota_estimate(_search_log(spark, sf_dir), r.id_batches(videos))
    names = ["search_calls", "video_calls", "quota_units"]
    sums = quota.agg(F.struct(*[F.sum(x).alias(x) for x in names])).scalar()
    return v.run_summary(
        {
            "global_ids_collected": d.distinct_ids(videos),
            "rows_after_dedup": unique,
            "rows_after_quality_filter": v.quality_filter(unique),
            "api_search_calls": sums["search_calls"],
            "api_videos_calls": sums["video_calls"],
            "quota_units_estimated": sums["quota_units"],
        }
    )


@query
def id_batches(spark, sf_dir):
    out = r.id_batches(t.video_details(spark, sf_dir))
    return out.select("query", "batch", F.array_join("ids", ",").alias("ids"), "n_ids")


def _search_log(spark, sf_dir) -> DataFrame:
    """One row per search page: each event type's events, fifty at a time."""
    page = F.floor(F.col(ORD) / 50)
    return t.video_details(spark, sf_dir).select("query", page.alias("page")).distinct()


@query
def quota_estimate(spark, sf_dir):
    batches = r.id_batches(t.video_details(spark, sf_dir))
    return r.quota_estimate(_search_log(spark, sf_dir), batches)


@query
def pending_fetches(spark, sf_dir):
    """Every user's event types as requests, the events as the fetch log."""
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", "event_type", F.col("ts").alias("fetched_at")
    )
    day = 86400
    now = log.agg(F.max("fetched_at")).first()[0]
    return r.pending_fetches(log, log, now, ["user_id", "event_type"], ttl_seconds=7 * day)


# --- order, checks, sinks --------------------------------------------------


@query
def rank_for_review(spark, sf_dir):
    """With the place of each row, numbered from the order in which the rows come out."""
    ranked = o.rank_for_review(ready_prompts.score_sources(t.sources(spark, sf_dir)))
    ranked = ranked.select(F.col(ORD).alias("doc_id"), "blended_priority_score", "priority_score")
    placed = ranked.withColumn(ORD, F.monotonically_increasing_id()).withColumn("all", F.lit(0))
    placed = add_position(stage(placed, "ranked"), ["all"], "rank")
    return placed.select("doc_id", "blended_priority_score", "priority_score", F.col("rank").cast("bigint"))


@query
def top_n_for_review(spark, sf_dir):
    top = o.top_n_for_review(ready_prompts.score_sources(t.sources(spark, sf_dir)))
    return _docs(top, "blended_priority_score", "priority_score")


@query
def check_columns(spark, sf_dir):
    """All checks of a run's outputs; the row count to expect is that of the distinct URLs."""
    sources = t.sources(spark, sf_dir)
    prompts = stage(o.prompts_projection(_prepared(spark, sf_dir)), "prompts")
    master = v.master_projection(sources)
    expected = sources.agg(F.count_distinct("source_url").alias("n")).scalar()
    ready = o.ready_projection(prompts)
    return checks.check_outputs(ready, prompts, master, expected)


@query
def check_row_count(spark, sf_dir):
    out = ready_prompts.score_sources(t.sources(spark, sf_dir))
    return checks.check_row_count(out, 10, "ready")


@query
def check_template_parity(spark, sf_dir):
    """The landed template sets against themselves with one text changed in some."""
    one = _landed_templates(spark, sf_dir)
    odd = F.col("template").endswith("7")
    other = one.withColumn("role", F.when(odd, "Nobody").otherwise(F.col("role")))
    same = checks.check_template_parity(one, one).withColumn("check", F.lit("same"))
    return same.unionByName(checks.check_template_parity(one, other))


@query
def check_prompts_nonempty(spark, sf_dir):
    return checks.check_prompts_nonempty(_prepared(spark, sf_dir))


@query
def write_csv(spark, sf_dir):
    """The review table as CSV, read back as text."""
    ready = o.ready_projection(o.rank_for_review(_prepared(spark, sf_dir)))
    path = w.write_csv(ready, new_path(spark, "ready-csv"))
    back = csv_files.read_csv_text(spark, path)
    return back.select(*READY_COLUMNS)


@query
def write_master(spark, sf_dir):
    master = link_collection.links_to_master(t.links(spark, sf_dir), niche="STORY")
    path = w.write_master(master, new_path(spark, "master-csv"))
    return csv_files.read_csv_text(spark, path).drop(ORD)


@query
def write_telemetry(spark, sf_dir):
    """Statistics and summary written, the statistics read back."""
    stats = v.query_stats(_videos(spark, sf_dir), t.query_specs(spark, sf_dir))
    summary = v.run_summary({"rows": _videos(spark, sf_dir)})
    detail, short = w.write_telemetry(stats, summary, new_path(spark, "telemetry"))
    rows = csv_files.read_csv_text(spark, short).select(F.col("value").cast("bigint").alias("rows"))
    return spark.read.schema(stats.schema).json(detail).withColumn("rows", rows.scalar())


@query
def run_account(spark, sf_dir):
    """A collection's account with fixed times, written and read back."""
    ran, path = _collection(spark, sf_dir), new_path(spark, "account")
    begun, ended = (t.AS_OF.replace(tzinfo=timezone.utc, minute=m) for m in (0, 30))
    w.write_telemetry(ran.stats, ran.summary, path, begun, ended)
    schema = "started_at string, finished_at string, query_count bigint, totals map<string, bigint>"
    account = spark.read.schema(schema).json(f"{path}/run_json")
    named = F.explode("totals").alias("metric", "value")
    return account.select("started_at", "finished_at", "query_count", named)


@query
def export_prompt_text(spark, sf_dir):
    path = w.export_prompt_text(
        _prepared(spark, sf_dir),
        new_path(spark, "prompt-text"),
        ["blended_priority_score", "priority_score"],
    )
    return spark.read.parquet(path)


@query
def export_prompt_text_unranked(spark, sf_dir):
    return w.name_prompts(_prepared(spark, sf_dir))


# --- whole jobs ------------------------------------------------------------


@query
def ready_and_prompts(spark, sf_dir):
    """Sources to ranked prompts."""
    return ready_prompts.ready_and_prompts(
        t.sources(spark, sf_dir), t.sample_templates(spark)
    )[1]


@query
def ready_table(spark, sf_dir):
    """The review table of the same job, read back from the CSV that it writes."""
    ready, prompts = new_path(spark, "ready"), new_path(spark, "prompts")
    ready_prompts.run_and_write(t.sources(spark, sf_dir), t.sample_templates(spark), ready, prompts, strict=True)
    return csv_files.read_csv_text(spark, ready).select(*READY_COLUMNS)


@query
def run_trend_scoring(spark, sf_dir):
    return _docs(
        _trends(spark, sf_dir),
        "recency_score",
        "frequency_score",
        "multi_source_score",
        "trend_score",
        "priority_level",
    )


def _collection(spark, sf_dir) -> video_collection.Collection:
    """From landed search and detail pages; their numbers give the order of arrival."""
    found = _landed_search(spark, sf_dir).withColumn(ORD, F.struct("page"))
    details = _landed_details(spark, sf_dir).withColumn(ORD, F.struct("page"))
    return video_collection.collect_videos(
        landed_json.search_hits(found),
        landed_json.page_items(details),
        t.query_specs(spark, sf_dir),
        pages=found,
    )


@query
def run_video_collection(spark, sf_dir):
    videos = _collection(spark, sf_dir).videos
    extra = F.col("source_extra")
    return videos.select(
        "id", "query", extra["query_priority"].alias("query_priority"), "title", "channel", "views"
    )


@query
def video_collection_summary(spark, sf_dir):
    return _collection(spark, sf_dir).summary


@query
def video_collection_stats(spark, sf_dir):
    return _collection(spark, sf_dir).stats


@query
def run_link_collection(spark, sf_dir):
    """Watch links of all pages to strict source rows, each video once."""
    found = li.extract_page_links(_watch_pages(spark, sf_dir), max_results=None)
    records = found.withColumn(ORD, F.struct("page_id", F.col("pos").cast("bigint").alias("row")))
    return link_collection.links_to_master(records, carry=["title"])


@query
def trend_validation(spark, sf_dir):
    """Shared links against the prompts as they are stored."""
    prompts = stage(o.prompts_projection(_prepared(spark, sf_dir), carry=[ORD]), "stored-prompts")
    key = F.col(ORD)
    shared = t.sources(spark, sf_dir).select(
        ORD,
        F.when(key % 5 == 0, F.concat("source_url", F.lit("_unknown")))
        .otherwise(F.col("source_url"))
        .alias("source_url"),
    )
    out = link_collection.validate_links(shared, prompts)
    verdict = F.from_json(
        "verdict", "trend_score int, trend_reason string, improvement_prompt string"
    )
    return _docs(out.withColumn("v", verdict), "source_url", "v.*")


QUERIES["extract_video_id"] = QUERIES.pop("extract_video_id_query")
QUERIES["canonical_watch_url"] = QUERIES.pop("canonical_watch_url_query")

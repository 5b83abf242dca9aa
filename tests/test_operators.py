"""Operators on small tables: edge rows and error rules."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from content_signals.constants import ORD, WATCH_PREFIX
from content_signals.operators import classify, dedup, links, normalize, prompts, requests, trends, videos
from content_signals.operators.checks import check_columns, check_prompts_nonempty
from content_signals.plans.link_collection import links_to_master, validate_links
from content_signals.plans.video_collection import collect_videos
from content_signals.sources.query_specs import query_specs_from_list
from content_signals.tables import sample_templates


def _by_order(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy(ORD).collect()]


def test_blend_cuts_binary_floats(spark):
    pairs = spark.range(101 * 101).select(
        F.col("id").alias(ORD),
        F.floor(F.col("id") / 101).cast("int").alias("priority_score"),
        (F.col("id") % 101).alias("manual_priority_score"),
    )
    got = classify.blended_score(pairs).collect()
    for r in got:
        want = int(r.priority_score * 0.6 + r.manual_priority_score * 0.4)
        assert r.blended_priority_score == max(0, min(want, 100))


def test_manual_score(table):
    given = ["92", " 92 ", "", None, "abc", "92f", "NaN", "inf", "1e12", "-5", "87.9"]
    df = table([{"manual_score": v, "priority_score": 40} for v in given], priority_score="int")
    out = classify.blended_score(classify.manual_score(df))
    assert _by_order(out, "manual_priority_score") == [
        (v,) for v in [92, 92, 40, 40, 40, 40, 40, 40, 10**12, -5, 87]
    ]
    assert [b for (b,) in _by_order(out, "blended_priority_score")][-3:] == [100, 22, 58]
    assert out.first().reviewer_decision == "PENDING"


def test_content_url_column_choice(table):
    df = table([{"link": " a ", "url": "b"}, {"link": None, "url": "c"}])
    assert _by_order(normalize.resolve_content_url(df), "content_url") == [("a",), ("",)]
    with pytest.raises(ValueError):
        normalize.resolve_content_url(table([{"address": "a"}]))
    with pytest.raises(ValueError):
        normalize.resolve_content_url(table([{"url": " "}]), strict=True)


def test_normalize_adds_absent_columns(table):
    row = normalize.normalize(table([{"url": "u", "niche": " biz\xa0", "lang": None}])).first()
    assert (row.niche, row.lang, row.rights, row.usage_strategy) == (
        "BIZ", "FR", "REWRITE_REQUIRED", "viral",
    )
    assert (row.source_url, row.raw_text, row.notes) == ("u", "Source from u", "")


def test_platform_and_niche(table):
    urls = ["http://YouTube.com/x", "youtu.be/1", "tiktok.com", "fb.watch/1", "x.example", None]
    df = table([{"content_url": u, "origin_platform": ""} for u in urls])
    assert [p for (p,) in _by_order(classify.infer_platform(df), "origin_platform")] == [
        "YOUTUBE", "YOUTUBE", "TIKTOK", "FACEBOOK", "OTHER", "OTHER",
    ]
    texts = [("", "Money and health"), (None, "wellness"), ("", "EMOTION"), ("", "x"), (" a ", "money")]
    df = table([{"niche": n, "raw_text": t} for n, t in texts])
    assert [n for (n,) in _by_order(classify.infer_niche(df), "niche")] == [
        "BUSINESS", "HEALTH", "STORY", "MOTIVATION", "A",
    ]
    rules = [("PETS", ["cat"])]
    assert classify.infer_niche(table([{"raw_text": "a Cat"}]), rules).first().niche == "PETS"


def test_rows_without_url(spark, table):
    df = table([{"content_url": "", "rights": "AVOID"}, {"content_url": " ", "rights": ""},
                {"content_url": "u", "rights": ""}])
    sets = sample_templates(spark)
    with pytest.raises(Exception, match="no content_url"):
        prompts.render_prompt(df, sets).collect()
    good, bad = prompts.split_bad_rows(prompts.render_prompt(df, sets, on_bad_row="quarantine"))
    assert _by_order(bad, ORD) == [(1,)]
    assert [p == "" for (p,) in _by_order(good, "final_prompt")] == [True, False]
    with pytest.raises(ValueError):
        prompts.render_prompt(df, sets, on_bad_row="skip")


def test_prompt_quality(table):
    texts = ["", "ROLE: a\nOBJECTIVE: b", "ROLE:OBJECTIVE:SOURCE:" + "x" * 180]
    out = prompts.ready_flags(prompts.prompt_quality(table([{"final_prompt": t} for t in texts])))
    assert _by_order(out, "prompt_quality_score", "prompt_quality_flags", "prompt_generated") == [
        (15, "prompt_too_short|missing_role|missing_objective|missing_source", False),
        (55, "prompt_too_short|missing_source", True),
        (100, "OK", True),
    ]


def test_hint_is_optional(spark, table):
    df = table([{"content_url": "u", "rights": ""}])
    sets = sample_templates(spark)
    text = prompts.render_prompt(df, sets, hint=None).first().final_prompt
    assert text.endswith("FORMAT: One script, under a minute")
    assert "PRIORITY_SCORE: 0\nEDITOR_NOTES: None" in text


def test_recency(table):
    now = datetime(2024, 1, 11)
    dates = ["2024-01-01", "2024-01-06T00:00:00Z", "2025-01-01 00:00:00", "junk", None, "2024/01/11"]
    df = table([{"published_at": d} for d in dates])
    assert _by_order(trends.recency_score(df, now), "recency_score") == [
        (0.0,), (0.5,), (1.0,), (0.5,), (0.5,), (1.0,),
    ]
    assert trends.recency_score(table([{"date": "x"}]), now).first().recency_score == 0.5
    assert trends.recency_score(table([{"title": "x"}]), now).first().recency_score == 0.5
    # less than a day old: the age counts against one day
    recent = table([{"date": str(now - timedelta(hours=12))}])
    assert trends.recency_score(recent, now).first().recency_score == 0.5


@pytest.mark.parametrize("hot", [1, 2, 512])
def test_frequency_and_themes(table, hot):
    titles = ["cats dogs", "dogs dogs", "birds", "of a", None, "cats"]
    df = table([{"title": t, "niche": "x"} for t in titles])
    assert _by_order(trends.frequency_score(df, hot), "frequency_score") == [
        (1.0,), (1.0,), (1 / 3,), (0.5,), (0.5,), (2 / 3,),
    ]
    # themes: cats, dogs, birds, X, X, cats
    assert _by_order(trends.multi_source_score(df), "multi_source_score") == [
        (1.0,), (0.5,), (0.5,), (1.0,), (1.0,), (1.0,),
    ]
    marked = trends.frequency_score(df, hot, nan_as_token=True)
    assert _by_order(marked, "frequency_score")[4] == (1 / 3,)


def test_corpus_without_keywords(table):
    df = table([{"title": "a", "niche": ""}, {"title": "the", "niche": None}])
    assert _by_order(trends.frequency_score(df), "frequency_score") == [(0.5,), (0.5,)]
    assert _by_order(trends.multi_source_score(df), "multi_source_score") == [(1.0,), (1.0,)]


def test_weights_are_shared_out(table):
    names = ["recency_score", "frequency_score", "multi_source_score"]
    rows = [(1.0, 0.5, 0.0), (None, 0.5, 1.0), (None, None, None)]
    df = table([dict(zip(names, r)) for r in rows], **{n: "double" for n in names})
    scores = [s for (s,) in _by_order(trends.weighted_score(df), "trend_score")]
    assert scores == pytest.approx([0.55, 0.75, 0.5])


def test_priority_level_thresholds(table):
    df = table([{"trend_score": s} for s in (0.65, 0.6499, 0.4, 0.39)], trend_score="double")
    assert _by_order(trends.priority_level(df), "priority_level") == [
        ("HIGH",), ("MEDIUM",), ("MEDIUM",), ("LOW",),
    ]


def test_dedup_keeps_first_and_null_is_a_key(table):
    urls = ["a", " a", "a", None, "A", None]
    df = table([{"source_url": u} for u in urls])
    once = dedup.dedup_sources(df)
    assert _by_order(once, ORD) == [(0,), (1,), (3,), (4,)]
    assert _by_order(dedup.dedup_sources(once), ORD) == _by_order(once, ORD)


def test_padding(table):
    df = table([{"source_url": "abcdef"}, {"source_url": "https://youtu.be/abcdef"}])
    out = [r.source_url for r in links_to_master(df).collect()]
    assert sorted(out) == sorted(
        [WATCH_PREFIX + "abcdef"] + [f"{WATCH_PREFIX}demo_seed_{i}" for i in range(1, 10)]
    )
    many = table([{"source_url": f"video{i}"} for i in range(12)])
    assert links_to_master(many).count() == 12


def test_page_links(spark):
    html = (
        '<a href="/watch?v=aaaaaa">One</a><a href="/watch?v=bbbbbb&amp;t=1" title="Two">x</a>'
        '<a href="https://h.example/watch?v=aaaaaa">Again</a><a href="/watch?v=">None</a>'
        '<a href="/other">Other</a><a href="/watch?v=cccccc">Three</a>'
    )
    df = spark.createDataFrame([(1, html), (2, "no links"), (3, None)], "page_id bigint, html string")
    rows = links.extract_page_links(df).collect()
    assert [(r.page_id, r.pos, r.source_url[-6:], r.title) for r in rows] == [
        (1, 0, "aaaaaa", "One"), (1, 1, "bbbbbb", "Two"), (1, 2, "cccccc", "Three"),
    ]
    assert links.extract_page_links(df, max_results=2).count() == 2
    raw = links.extract_page_links(df, raw_pattern=True).collect()
    assert [(r.source_url[-6:], r.title) for r in raw] == [("aaaaaa", ""), ("bbbbbb", ""), ("cccccc", "")]


DETAILS = (
    "id string, snippet struct<title: string, channelTitle: string, publishedAt: string, "
    "description: string, tags: array<string>>, statistics struct<viewCount: string, likeCount: string>"
)


def _details(spark):
    rows = [
        ("a", ("A", "c", "2024", None, None), ("100", "1")),
        ("b", ("B", "c", "2024", "d", ["t"]), ("250", "x")),
        ("c", ("", "c", "2024", "d", []), ("900", None)),
    ]
    return spark.createDataFrame(rows, DETAILS)


def test_normalize_videos(spark):
    rows = {r.id: r for r in videos.normalize_videos(_details(spark)).collect()}
    assert (rows["a"].platform, rows["a"].views, rows["b"].views) == ("youtube", 100, 250)
    extra = rows["a"].source_extra
    assert (extra.description, extra.tags, extra.categoryId, extra.likeCount) == ("", [], "", 1)
    assert (rows["b"].source_extra.likeCount, rows["c"].source_extra.commentCount) == (0, 0)
    with pytest.raises(ValueError):
        videos.valid_items_filter(_details(spark))
    bare = videos.normalize_videos(_details(spark).select("id")).filter("id = 'a'").first()
    assert (bare.title, bare.views, bare.source_extra.tags) == ("", 0, [])


def test_video_collection(spark):
    hits = spark.createDataFrame(
        [("one", "a", 0), ("one", "a", 1), ("one", "b", 2), ("two", "b", 3), ("two", "c", 4),
         ("two", "a", 5), ("none", "a", 6), ("two", None, 7)],
        f"query string, id string, {ORD} bigint",
    )
    specs = query_specs_from_list(
        spark,
        [{"query": "one", "priority": "high", "max_results": 3, "min_views": 200},
         {"query": "two", "max_results": 2}, {"query": "idle"}],
    )
    details = _details(spark).withColumn(ORD, F.monotonically_increasing_id())
    run = collect_videos(hits, details, specs, search_calls=F.lit(4))
    got = {r.id: (r.query, r.source_extra.query_priority) for r in run.videos.collect()}
    # b belongs to the first query; c has no title; a has too few views for the
    # first query and lies beyond the second one's limit
    assert got == {"b": ("one", "HIGH")}
    stats = {r.query: (r.ids, r.valid_items, r.min_views_filtered_items) for r in run.stats.collect()}
    assert stats == {"one": (2, 2, 1), "two": (2, 2, 2), "idle": (0, 0, 0)}
    assert {r.metric: r.value for r in run.summary.collect()} == {
        "queries": 3, "global_ids_collected": 3, "rows_after_dedup": 2,
        "rows_after_quality_filter": 1, "rows_final": 1, "api_search_calls": 4,
        "api_videos_calls": 2, "cache_hits": 0, "quota_units_estimated": 404,
    }
    every = collect_videos(hits, details, specs, keep=lambda df: df, max_pages=None)
    assert sorted(r.id for r in every.videos.collect()) == ["b", "c"]


def test_search_calls_of_landed_pages(spark):
    pages = spark.createDataFrame(
        [("full", p) for p in (1, 2, 3, 3)] + [("short", 1), ("short", 2), ("idle", 1), ("other", 1)],
        "query string, page int",
    )
    taken = spark.createDataFrame(
        [("full", 1), ("full", 2), ("short", 1)], "query string, page int"
    )
    specs = query_specs_from_list(
        spark,
        [{"query": "full", "max_results": 2}, {"query": "short", "max_results": 9}, {"query": "idle"}],
    )
    specs = specs.withColumn("max_results", F.when(F.col("query") == "idle", 0).otherwise(F.col("max_results")))

    def calls(**limits):
        return {r.query: r.search_calls for r in requests.search_pages_read(pages, taken, specs, **limits).collect()}

    # the second page of "full" holds the last wanted hit; "short" runs out of pages
    assert calls() == {"full": 2, "short": 2}
    assert calls(max_pages=1) == {"full": 1, "short": 1}


def test_repeated_specs_are_an_error(spark):
    specs = query_specs_from_list(spark, ["one", "two", "one"])
    hits = spark.createDataFrame([("one", "a", 0)], f"query string, id string, {ORD} bigint")
    with pytest.raises(Exception, match="query in more than one spec: one"):
        dedup.top_n_per_query(hits, specs).collect()


def test_durations(column):
    values = ["PT1H2M3S", "PT45S", "P1DT1M", "PT", "1:30", None, "PT10M"]
    assert column(videos.duration_seconds, values) == [3723, 45, 86460, 0, None, None, 600]


def test_pending_fetches(spark):
    now = datetime(2024, 1, 1, 1)
    log = spark.createDataFrame(
        [("a", now - timedelta(seconds=900)), ("b", now - timedelta(seconds=901)),
         ("b", now - timedelta(days=2))],
        "key string, fetched_at timestamp",
    )
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "key string")
    left = requests.pending_fetches(wanted, log, now, ["key"])
    assert sorted(r.key for r in left.collect()) == ["b", "c"]


def test_times_are_utc_in_any_session(spark, table):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = table([{"date": "2024-01-01T00:00:00Z"}, {"date": "2024-01-11T00:00:00+02:00"}])
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        scores = _by_order(trends.recency_score(df, datetime(2024, 1, 11)), "recency_score")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert scores == [(0.0,), (pytest.approx(1 - 2 / 240),)]


def test_checks(table):
    df = table([{"status": "FILTERED", "final_prompt": ""}, {"status": "X", "final_prompt": ""}])
    assert not check_prompts_nonempty(df).first().ok
    row = check_columns(df, ["status", "other"], "ready").first()
    assert (row.ok, row.detail) == (False, "missing: other")


def test_link_verdicts(table):
    stored = table(
        [{"source_url": "https://youtu.be/abcdef", "blended_priority_score": 87, "status": "S",
          "final_prompt": "P"}],
        blended_priority_score="int",
    )
    shared = table([{"source_url": u} for u in ("abcdef", "/watch?v=abcdef&t=1", "nothing", None)])
    got = [v for (v,) in _by_order(validate_links(shared, stored), "verdict")]
    assert got[0] == got[1]
    assert got[0].startswith('{"trend_score":5,"trend_reason":"blended score 87')
    assert got[2] == got[3] == (
        '{"trend_score":1,"trend_reason":"link not found","improvement_prompt":""}'
    )


def test_blank_ids_and_pages_in_limits(spark):
    ids = [None, "a", "", "b", "c", "d"]
    hits = spark.createDataFrame(
        [("q", i, n, n // 2 + 1) for n, i in enumerate(ids)], f"query string, id string, {ORD} bigint, page int"
    )
    specs = spark.createDataFrame([("q", 2)], "query string, max_results bigint")
    top = lambda **limits: [r.id for r in dedup.top_n_per_query(hits, specs, **limits).orderBy(ORD).collect()]
    assert top() == ["a", "b"]
    assert top(max_pages=1) == ["a"]
    assert top(max_pages=2) == ["a", "b"]


def test_links_of_untidy_pages(spark):
    many = "".join(f'<a href="/watch?v=many{i:04}">{i}</a>' for i in range(70))
    html = (
        '<!-- <a href="/watch?v=hidden1">no</a> --><script>"<a href=\'/watch?v=hidden2\'>"</script>'
        '<a data-x="a>b" data-href="/x" href="/watch?v=abcdef2">it&#x27;s &eacute; &#233; &amp;lt;</a>' + many
    )
    rows = links.extract_page_links(spark.createDataFrame([(1, html)], "page_id bigint, html string")).collect()
    assert len(rows) == 71
    assert (rows[0].source_url[-7:], rows[0].title) == ("abcdef2", "it's é é &lt;")


def test_a_missing_template_set_raises(spark):
    from content_signals.tables import sample_templates

    other = sample_templates(spark).filter("template <> 'default'")
    row = spark.createDataFrame([("u", "viral")], "source_url string, usage_strategy string")
    with pytest.raises(Exception, match="no template set"):
        prompts.with_template(row, other).collect()


def test_date_spellings(spark):
    given = ["1/2/2024", "15 Jan 2024", "January 15, 2024", "20240115", "2024/1/5", "Jan 3, 2024", "soon"]
    rows = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    got = rows.orderBy("i").select(trends.parse_timestamp(F.col("t")).cast("date").cast("string")).collect()
    want = ["2024-01-02", "2024-01-15", "2024-01-15", "2024-01-15", "2024-01-05", "2024-01-03", None]
    assert [r[0] for r in got] == want

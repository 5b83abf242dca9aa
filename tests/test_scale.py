"""Plans and helpers that matter at scale: skew, positions, staging, plan shape."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from content_signals.constants import ORD
from content_signals.operators import dedup, links, ranking, requests, sinks, trends
from content_signals.plans import ready_prompts, staging
from content_signals.plans.order import add_position, add_rank_position
from content_signals.plans.skew import fits_broadcast, heavy_keys, lookup_join, salted_join
from content_signals.tables import AS_OF, pages, query_specs, sample_templates, sources, video_details


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some under null, the rest spread out."""
    key = F.when(F.col(ORD) % 3 == 0, "hot").when(
        F.col(ORD) % 50 != 1, (F.col(ORD) % 400).cast("string")
    )
    return spark.range(30_000).withColumnRenamed("id", ORD).withColumn("key", key)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(skewed, how):
    lookup = skewed.groupBy("key").agg(F.max(ORD).alias("top")).filter("key is not null and key != '7'")
    plain = skewed.join(lookup, "key", how).select(ORD, "key", "top")
    for salted in (
        salted_join(skewed, lookup, ["key"], how),
        salted_join(skewed, lookup, ["key"], how, target=100),
        lookup_join(skewed, lookup, ["key"], how, rows=10),
        lookup_join(skewed, lookup, ["key"], how),
    ):
        got = salted.select(ORD, "key", "top")
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_salted_join_spreads_the_hot_key(spark, skewed):
    lookup = skewed.groupBy("key").agg(F.max(ORD).alias("top")).filter("key is not null")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(skewed, lookup, ["key"], target=1000)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["count"] for r in sizes) < 0.45 * 30_000


def test_heavy_keys_are_few(skewed):
    counts = skewed.groupBy("key").agg(F.count("*").alias("n"))
    heavy = heavy_keys(counts, ["key"], target=1000).collect()
    assert {r.key: r._salts for r in heavy} == {"hot": 10}
    assert heavy_keys(counts, ["key"]).isEmpty()


def test_broadcast_is_measured(spark):
    small = spark.range(10).select(F.col("id").cast("string").alias("s"))
    assert fits_broadcast(small)
    assert not fits_broadcast(small, rows=9)
    assert not fits_broadcast(small, size=9)
    nested = small.select(F.array(F.repeat("s", 1000)).alias("a"))
    assert not fits_broadcast(nested, size=5000)


@pytest.mark.parametrize("bucket_rows", [1, 7, 1000, 10**6])
def test_positions(skewed, bucket_rows):
    from pyspark.sql import Window

    rows = skewed.filter(F.col(ORD) < 3000)
    want = rows.withColumn("p", F.row_number().over(Window.partitionBy("key").orderBy(ORD)))
    got = add_position(rows, ["key"], "p", bucket_rows)
    assert got.select(ORD, "p").exceptAll(want.select(ORD, "p")).isEmpty()
    assert got.count() == 3000


def test_positions_of_nested_order(spark):
    order = F.struct(
        F.struct(F.lit("f").alias("file"), F.floor(F.col("id") / 40).alias("row")).alias("page"),
        (F.col("id") % 40).alias("row"),
    )
    rows = spark.range(400).withColumn(ORD, order).withColumn("g", F.lit(1))
    got = add_position(rows, ["g"], bucket_rows=200)
    assert got.filter("position != id + 1").isEmpty()


def test_positions_of_sparse_order(spark):
    """Hashed keys make a bucket of every row; no window sees all buckets of the group."""
    from content_signals.plans.order import _bucketed, _starts

    rows = spark.range(4000).select(F.xxhash64("id").alias(ORD), F.lit("all").alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, sizes = _bucketed(rows, ["g"], 100)
        per_part = [r["count"] for r in sizes.groupBy("_part").count().collect()]
        got = add_position(rows, ["g"], bucket_rows=100).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_part) > 3900 and max(per_part) < 2000
    assert _starts(sizes).count() == sum(per_part)
    want = sorted(got, key=lambda r: r[ORD])
    assert [r.position for r in want] == list(range(1, 4001))


def test_too_many_scores_to_rank(spark, monkeypatch):
    monkeypatch.setattr("content_signals.plans.order.MOST_SCORES", 10)
    scored = spark.range(11).select(F.col("id").alias(ORD), F.col("id").alias("a"))
    with pytest.raises(ValueError, match="combinations"):
        add_rank_position(scored, ["a"])


def test_rank_positions(spark):
    scored = spark.range(2000).select(
        F.col("id").alias(ORD), (F.col("id") * 7 % 5).alias("a"), (F.col("id") * 3 % 4).alias("b")
    )
    got = add_rank_position(scored, ["a", "b"], bucket_rows=100).collect()
    want = sorted(got, key=lambda r: (-r.a, -r.b, r[ORD]))
    assert [r.position for r in want] == list(range(1, 2001))


@pytest.mark.parametrize("max_pages", [None, 3, 100])
def test_limit_per_query_on_a_hot_query(spark, skewed, max_pages):
    hits = skewed.withColumnRenamed("key", "query").withColumn("id", F.col(ORD).cast("string"))
    specs = spark.createDataFrame([("hot", 2000), ("5", 3), ("9", -1)], "query string, max_results bigint")
    got = dedup.top_n_per_query(hits, specs, max_pages)
    top = 2000 if max_pages != 3 else 150
    counts = {r["query"]: r["count"] for r in got.groupBy("query").count().collect()}
    assert counts == {"hot": top, "5": 3}
    assert got.filter("query = 'hot'").agg(F.max(ORD)).first()[0] == 3 * (top - 1)


def test_page_bound_of_a_spec(spark, skewed):
    hits = skewed.select(F.col("key").alias("query"), ORD)
    specs = spark.createDataFrame(
        [("hot", 500, 2), ("5", 500, None)], "query string, max_results bigint, max_pages bigint"
    )
    got = dedup.top_n_per_query(hits, specs, max_pages=1, page_size=20).groupBy("query").count()
    assert {r["query"]: r["count"] for r in got.collect()} == {"hot": 40, "5": 20}


def test_batches_of_a_hot_query(skewed):
    hits = skewed.select(F.col("key").alias("query"), F.concat(F.lit("v"), ORD).alias("id"), ORD)
    batches = requests.id_batches(hits.filter("query = 'hot'"))
    sizes = sorted(r.n_ids for r in batches.collect())
    assert sizes == [50] * 200
    first = batches.filter("batch = 0").first().ids
    assert first[:3] == ["v0", "v3", "v6"]


def test_scores_do_not_depend_on_partitioning(spark, sf_dir):
    rows = sources(spark, sf_dir)
    results = []
    for n in (1, 16):
        scored = trends.frequency_score(rows.repartition(n), hot_keywords=3)
        scored = trends.multi_source_score(scored)
        results.append(sorted(scored.select(ORD, "frequency_score", "multi_source_score").collect()))
    assert results[0] == results[1]


def test_duplicates_are_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(dedup.dedup_sources(sources(spark, sf_dir)))
    assert plan.count("WindowGroupLimit") >= 2  # before and after the exchange
    limited = dedup.top_n_per_query(video_details(spark, sf_dir), query_specs(spark, sf_dir), max_pages=3)
    assert plan_of(limited).count("WindowGroupLimit") >= 2


def test_no_cross_joins_and_no_python_in_plans(spark, sf_dir):
    templates = sample_templates(spark)
    plans = [
        plan_of(ready_prompts.ready_and_prompts(sources(spark, sf_dir), templates)[1]),
        plan_of(trends.trend_score(sources(spark, sf_dir), AS_OF)),
        plan_of(links.extract_page_links(pages(spark, sf_dir))),
        plan_of(sinks.name_prompts(ready_prompts.prepare_prompts(sources(spark, sf_dir), templates))),
    ]
    for plan in plans:
        for operator in ("NestedLoop", "Cartesian", "Python", "Pandas"):
            assert operator not in plan


def test_columns_are_pruned(spark, sf_dir):
    plan = plan_of(dedup.dedup_sources(sources(spark, sf_dir)).select("source_url"))
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    top = ranking.top_n_for_review(ready_prompts.score_sources(sources(spark, sf_dir)).select(
        ORD, "blended_priority_score", "priority_score"))
    assert "TakeOrderedAndProject" in plan_of(top)
    assert "text" not in plan_of(top).split("ReadSchema")[1].splitlines()[0]


def test_page_text_is_searched_once(spark, sf_dir):
    plan = plan_of(links.extract_page_links(pages(spark, sf_dir)))
    assert plan.count("regexp_extract_all") == 1


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    assert staging.staging_root(Session(spark_checkpoint_dir="s3a://b/c/")) == "s3a://b/c"
    with pytest.raises(RuntimeError):
        staging.staging_root(Session(spark_master="yarn"))

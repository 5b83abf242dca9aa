"""The ten demonstration rows: known scores, order, prompts and trend values."""

from __future__ import annotations

import json
from datetime import datetime

from content_signals.constants import MASTER_COLUMNS, ORD, PROMPTS_COLUMNS, READY_COLUMNS
from content_signals.operators.ranking import top_n_for_review
from content_signals.plans.link_collection import collect_links
from content_signals.plans.ready_prompts import (
    prepare_prompts,
    ready_and_prompts,
    run_and_write,
    score_sources,
)
from content_signals.operators.sinks import export_prompt_text, write_csv
from content_signals.plans.staging import new_path
from content_signals.plans.trend_report import run_trend_scoring, trend_report
from content_signals.sources.csv_files import read_csv_text, read_sources
from content_signals.sources.demo import demo_sources
from content_signals.tables import AS_OF, sample_templates, sources


def test_ranked_scores(spark):
    ready, _ = ready_and_prompts(demo_sources(spark), sample_templates(spark))
    rows = ready.collect()
    assert ready.columns == READY_COLUMNS
    numbers = [int(r.source_url.split("video")[1]) for r in rows]
    assert numbers == [2, 6, 10, 4, 8, 1, 3, 5, 7, 9]
    assert [r.blended_priority_score for r in rows] == [87, 87, 85, 80, 80] + [65] * 5
    assert [r.priority_score for r in rows] == [85, 85, 85, 80, 80] + [65] * 5
    assert [r.manual_priority_score for r in rows] == [92, 92, 85, 80, 80] + [65] * 5
    assert {r.status for r in rows} == {"READY_TO_GENERATE"}
    assert {(r.prompt_quality_score, r.content_ready, r.ai_status) for r in rows} == {
        (100, True, "READY_FOR_AI")
    }
    assert {r.origin_platform for r in rows} == {"YOUTUBE"}


def test_prompt_and_payload(spark):
    _, prompts = ready_and_prompts(demo_sources(spark), sample_templates(spark))
    row = prompts.first()
    assert prompts.columns == PROMPTS_COLUMNS
    lines = row.final_prompt.split("\n")
    assert [line.split(":")[0] for line in lines] == [
        "ROLE", "RULES", "OBJECTIVE", "TONE", "TRANSFORMATION", "NICHE", "LANGUAGE", "SOURCE",
        "PRIORITY_SCORE", "EDITOR_NOTES", "FORMAT", "AI_ENHANCEMENT_HINT",
    ]
    assert lines[7] == "SOURCE: https://youtube.com/watch?v=video2"
    assert lines[8] == "PRIORITY_SCORE: 87"
    payload = json.loads(row.ai_enhancement_payload)
    assert payload["input_prompt"] == row.final_prompt
    assert payload["metadata"] == {
        "niche": "MOTIVATION", "lang": "FR", "usage_strategy": "viral", "blended_priority_score": 87,
    }
    # the text is what a plain JSON writer gives
    assert row.ai_enhancement_payload == json.dumps(payload, ensure_ascii=False)


def test_trend_values(spark):
    rows = trend_report(demo_sources(spark), datetime(2024, 1, 1)).collect()
    assert len(rows) == 10
    for r in rows:
        assert (r.recency_score, r.frequency_score, r.multi_source_score) == (0.5, 1.0, 1.0)
        assert abs(r.trend_score - 0.8) < 1e-12
        assert r.priority_level == "HIGH"


def test_top_rows(spark):
    top = top_n_for_review(score_sources(demo_sources(spark)), 2).collect()
    assert [r["_ord"] for r in top] == [2, 6]


def test_written_tables(spark):
    ready_path, prompts_path = new_path(spark, "ready"), new_path(spark, "prompts")
    templates = sample_templates(spark)
    assert run_and_write(demo_sources(spark), templates, ready_path, prompts_path)
    ready = read_csv_text(spark, ready_path)
    assert ready.count() == 10
    assert {r.processed for r in ready.collect()} == {"False"}
    prompts = read_csv_text(spark, prompts_path).collect()
    # the prompts' line breaks survive
    assert {len(r.final_prompt.split("\n")) for r in prompts} == {12}
    empty = demo_sources(spark, 0)
    unused = new_path(spark, "unused")
    assert not run_and_write(empty, templates, unused, unused)


def test_same_result_however_partitioned(spark):
    templates = sample_templates(spark)
    results = [
        sorted(map(str, prepare_prompts(demo_sources(spark, 200).repartition(n), templates).collect()))
        for n in (1, 16)
    ]
    assert results[0] == results[1]


def test_from_csv_to_named_prompts(spark):
    """Rows keep their place in the file all the way to the prompt names."""
    path, out = new_path(spark, "demo-csv"), new_path(spark, "demo-prompts")
    write_csv(demo_sources(spark, 30).coalesce(1), path)
    read = read_sources(spark, path)
    templates = sample_templates(spark)
    ready, _ = ready_and_prompts(read, templates)
    direct, _ = ready_and_prompts(demo_sources(spark, 30), templates)
    columns = ["source_url", "blended_priority_score", "content_ready", "title_seed", "processed"]
    assert ready.select(columns).collect() == direct.select(columns).collect()
    ranks = ["blended_priority_score", "priority_score"]
    export_prompt_text(prepare_prompts(read, templates), out, ranks)
    named = {r.prompt_name: r.text for r in spark.read.parquet(out).collect()}
    assert sorted(named) == [f"prompt_{i:03d}" for i in range(1, 31)]
    first = ready.first().source_url
    assert f"SOURCE: {first}\n" in named["prompt_001"]


def test_scores_stay_in_range(spark, sf_dir):
    rows = trend_report(score_sources(sources(spark, sf_dir)), AS_OF)
    wrong = [f"{c} < 0 OR {c} > 1" for c in
             ("recency_score", "frequency_score", "multi_source_score", "trend_score")]
    wrong += [f"{c} < 0 OR {c} > 100" for c in ("priority_score", "blended_priority_score")]
    assert rows.filter(" OR ".join(wrong)).isEmpty()


def test_written_trends_and_links(spark, table):
    path = run_trend_scoring(demo_sources(spark), AS_OF, new_path(spark, "trends"))
    rows = read_csv_text(spark, path).collect()
    assert len(rows) == 10
    assert {r.priority_level for r in rows} == {"HIGH"}
    records = table([{"source_url": "abcdef"}, {"source_url": "https://x.example/none"}])
    path = collect_links(records, new_path(spark, "links"), niche="STORY")
    rows = read_csv_text(spark, path)
    assert rows.columns == MASTER_COLUMNS + [ORD]
    assert rows.count() == 10
    assert rows.filter("niche = 'STORY'").count() == 1

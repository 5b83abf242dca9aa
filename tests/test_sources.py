"""Files: required columns, blanks, bad rows, templates, dropped links, landed JSON."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from content_signals.constants import DEFAULT_FORMAT, DEFAULT_ROLE, ORD
from content_signals.operators.checks import check_template_parity
from content_signals.operators.dedup import dedup_sources
from content_signals.operators.sinks import write_csv, write_master
from content_signals.sources import csv_files, landed_json, query_specs, templates
from content_signals.streaming import link_drops

HEADER = "source_url,niche,lang,rights,usage_strategy"


@pytest.fixture
def csv(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write


def test_missing_file_and_columns(spark, csv):
    with pytest.raises(FileNotFoundError):
        csv_files.read_sources(spark, "/tmp/there-is-no-such-file.csv")
    with pytest.raises(ValueError, match="'rights', 'usage_strategy'"):
        csv_files.read_sources(spark, csv("a.csv", "source_url,niche,lang", "a,b,c"))
    with pytest.raises(ValueError, match="missing required"):
        csv_files.read_sources(spark, csv("b.csv", ""))


def test_no_value_spellings_are_null(spark, csv):
    path = csv("a.csv", HEADER + ",notes", "u,NA,n/a,None,nan, ", 'u2,"",null,#N/A,<NA>,Nan')
    rows = csv_files.read_sources(spark, path).orderBy(ORD).collect()
    assert [r.niche for r in rows] == [None, None]
    assert [(r.lang, r.rights, r.usage_strategy) for r in rows] == [(None, None, None)] * 2
    assert [r.notes for r in rows] == [" ", "Nan"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_of_wrong_length(spark, csv, multi_line):
    short = csv("short.csv", HEADER, "a,b")
    row = csv_files.read_sources(spark, short, multi_line=multi_line).first()
    assert (row.niche, row.lang) == ("b", None)
    long = csv("long.csv", HEADER, 'a,b,c,d,"e,""f"', "a,b,c,d,e,f")
    strict = csv_files.read_sources(spark, long, multi_line=multi_line)
    for plan in (strict, strict.select("niche"), strict.drop(ORD), strict.groupBy().count()):
        with pytest.raises(Exception, match="too many cells"):
            plan.collect()
    lenient = csv_files.read_sources(spark, long, multi_line=multi_line, bad_rows="permissive")
    assert [r.usage_strategy for r in lenient.orderBy(ORD).collect()] == ['e,"f', "e"]


def test_line_breaks_and_file_order(spark, csv):
    path = csv("a.csv", HEADER + ",notes", 'u,b,c,d,e,"one\ntwo, ""x"""', "u,b,c,d,e,later")
    rows = dedup_sources(csv_files.read_sources(spark, path)).collect()
    assert [r.notes for r in rows] == ['one\ntwo, "x"']


def test_processed_is_boolean_and_defaults(spark, csv):
    path = csv("a.csv", HEADER + ",processed", "u,b,c,d,e,True", "u2,b,c,d,e,")
    df = csv_files.add_defaults(csv_files.read_sources(spark, path))
    rows = df.orderBy(ORD).collect()
    assert [r.processed for r in rows] == [True, None]
    assert rows[0].prompt_template == "default"
    assert rows[0].source_file == "master_sources.csv"


def test_folder_with_differing_headers(spark, tmp_path, csv):
    csv("m1.csv", "source_url,niche", "u1,a")
    csv("m2.csv", "source_url,lang", "u2,fr", "u3,en")
    csv("other.txt", "source_url", "no")
    df = csv_files.read_sources_dir(spark, str(tmp_path), "m*.csv", mixed_headers=True)
    rows = {r.source_url: (r.niche, r.lang, r.source_file) for r in df.collect()}
    assert rows == {"u1": ("a", None, "m1.csv"), "u2": (None, "fr", "m2.csv"), "u3": (None, "en", "m2.csv")}
    assert csv_files.read_sources_dir(spark, str(tmp_path), "z*.csv").count() == 0


def test_query_specs(spark, csv):
    path = csv(
        "q.csv",
        "query,priority,max_results,min_views,more",
        " one , high ,15,1000,x",
        "  ,HIGH,1,1,x",
        "NA,,0,abc,x",
        "three,low,abc,,x",
        "four,low,-1, 7 ,x",
    )
    rows = query_specs.read_query_specs(spark, path).orderBy(ORD).drop(ORD).collect()
    assert [tuple(r) for r in rows] == [
        ("one", "HIGH", 15, 1000),
        ("NA", "MEDIUM", 30, 0),
        ("three", "LOW", 30, 0),
        ("four", "LOW", -1, 7),
    ]
    with pytest.raises(ValueError):
        query_specs.read_query_specs(spark, csv("r.csv", "query,priority", "a,b"))
    given = [" a ", {"query": "b", "priority": " high", "max_results": 5, "min_views": "x"}, ""]
    rows = query_specs.query_specs_from_list(spark, given).orderBy(ORD).drop(ORD).collect()
    assert [tuple(r) for r in rows] == [("a", "MEDIUM", 30, 0), ("b", " HIGH", 5, 0)]


def _template_file(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(json.dumps(content), encoding="utf-8")
    return str(path)


TEMPLATE = {
    "base_prompt": {"role": "R", "rules": ["a", "b"], "format": "F"},
    "content_goals": {"viral": {"objective": "O", "tone": "T"}},
    "transformation_levels": {"rewrite": "W"},
}


def test_templates(spark, tmp_path):
    _template_file(tmp_path, "prompt_template.json", TEMPLATE)
    row = templates.read_templates(spark, folder=str(tmp_path)).first()
    assert (row.template, row.role, row.rules, row.format) == ("default", "R", ["a", "b"], "F")
    assert row.goals["viral"].objective == "O"
    bare = dict(TEMPLATE, base_prompt={})
    row = templates.read_templates(spark, _template_file(tmp_path, "bare.json", bare)).first()
    assert (row.role, len(row.rules), row.format) == (DEFAULT_ROLE, 3, DEFAULT_FORMAT)
    with pytest.raises(FileNotFoundError):
        templates.read_templates(spark, str(tmp_path / "none.json"))


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"content_goals": None}, "missing template section: content_goals"),
        ({"base_prompt": "text"}, "base_prompt must be an object"),
        ({"base_prompt": {"rules": "one"}}, "rules must be a list"),
    ],
)
def test_template_contract(spark, tmp_path, change, message):
    bad = {k: v for k, v in {**TEMPLATE, **change}.items() if v is not None}
    path = _template_file(tmp_path, "bad.json", bad)
    with pytest.raises(ValueError, match=message):
        templates.read_templates(spark, path)
    with pytest.raises(ValueError, match=message):
        templates.templates_from_dict(spark, bad)


def test_legacy_templates_and_parity(spark, tmp_path):
    path = _template_file(tmp_path, "old.json", {"base_prompt": "B"})
    row = templates.read_legacy_templates(spark, path).first()
    assert row.base_prompt == "B"
    assert set(row.levels) == {"rewrite", "summary", "none"}
    one = templates.templates_from_dict(spark, TEMPLATE)
    other = templates.templates_from_dict(spark, dict(TEMPLATE, transformation_levels={}))
    assert check_template_parity(one, one).first().ok
    assert not check_template_parity(one, other).first().ok


def test_landed_pages(spark, tmp_path):
    search = {"query": "q", "page": 1, "items": [
        {"id": {"videoId": "s1"}, "snippet": {"title": "T", "channelTitle": "C"}},
        {"id": {}, "snippet": {"title": "no id"}},
        {"id": {"videoId": "s2"}},
    ]}
    path = _template_file(tmp_path, "search.json", search)
    pages = landed_json.read_pages(spark, path, landed_json.SEARCH_PAGE)
    rows = landed_json.video_items_from_json(pages).orderBy(ORD).collect()
    assert [(r.id, r.title, r.channel) for r in rows] == [("s1", "T", "C"), ("s2", "", "")]
    listed = {"query": "p", "items": [
        {"snippet": {"videoOwnerChannelTitle": "O", "resourceId": {"videoId": "p1"}}}
    ]}
    path = _template_file(tmp_path, "list.json", listed)
    pages = landed_json.read_pages(spark, path, landed_json.PLAYLIST_PAGE)
    row = landed_json.video_items_from_json(pages).first()
    assert (row.id, row.channel, row.source) == ("p1", "O", "p")
    assert row.source_url.endswith("/watch?v=p1")


def test_dropped_links_are_taken_in_once(spark, tmp_path):
    drops, table, checkpoint = (str(tmp_path / n) for n in ("drops", "table", "checkpoint"))
    (tmp_path / "drops").mkdir()
    first = tmp_path / "drops" / "a.txt"
    first.write_text("  https://x.example/1 \n\nftp://no\nhttp://x.example/2\n")
    link_drops.ingest_link_drops(spark, drops, table, checkpoint)
    link_drops.ingest_link_drops(spark, drops, table, checkpoint)
    (tmp_path / "drops" / "b.txt").write_text("https://x.example/3\n")
    (tmp_path / "drops" / "c.csv").write_text("https://x.example/4\n")
    link_drops.ingest_link_drops(spark, drops, table, checkpoint)
    rows = spark.read.parquet(table).collect()
    assert sorted(r.source_url for r in rows) == [
        "http://x.example/2", "https://x.example/1", "https://x.example/3",
    ]
    assert {(r.niche, r.processed) for r in rows} == {("MOTIVATION", False)}
    batch = link_drops.read_link_drops(spark, drops, added_at=datetime(2024, 5, 1))
    assert batch.count() == 3
    assert batch.first().added_at == datetime(2024, 5, 1)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "flags")
    df = spark.sql("SELECT true AS a, CAST(NULL AS boolean) AS b, ' x ' AS c")
    write_csv(df, path)
    row = csv_files.read_csv_text(spark, path).first()
    assert (row.a, row.b, row.c) == ("True", None, " x ")
    write_csv(df, path, bool_style="lower")
    assert csv_files.read_csv_text(spark, path).first().a == "true"
    empty = spark.range(0).select(*[F.lit("").alias(c) for c in
                                    ["source_url", "niche", "lang", "rights", "usage_strategy", "origin_platform"]])
    with pytest.raises(ValueError):
        write_master(empty, path)

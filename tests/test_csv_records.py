"""CSV files read in splits against the reader that takes a whole file as one task."""

from __future__ import annotations

import random

import pytest
from content_signals.constants import ORD
from content_signals.sources import csv_files
from content_signals.sources.csv_records import records


def _cell(rng):
    text = "".join(rng.choices(["a", "b c", ",", "\n", '"', "é", "\r\n", "", "x" * 30], k=rng.randint(0, 6)))
    if any(c in text for c in ',"\n\r') or rng.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


def _file(folder, name, rows, end="\n", names=("one", "two", "three"), seed=1):
    rng = random.Random(seed)
    lines = [",".join(names)] + [",".join(_cell(rng) for _ in names) for _ in range(rows)]
    path = folder / name
    path.write_bytes((end.join(lines) + end).encode())
    return path


def _rows(df, names=("one", "two", "three")):
    return [tuple(r[c] for c in names) for r in df.orderBy(ORD).collect()]


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that records and quotes lie across them."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rows_equal_those_of_one_task(spark, tmp_path, small_splits, end, seed):
    path = str(_file(tmp_path, "big.csv", 300, end, seed=seed))
    whole = csv_files.read_csv_text(spark, path, split=False, na_null=False)
    split = csv_files.read_csv_text(spark, path, na_null=False)
    assert _rows(split) == _rows(whole)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20


def test_quotes_in_odd_places(spark, tmp_path, small_splits):
    lines = [
        "one,two,three", 'a"b,c,d"', '"",x,""', '"a""",b,c', '"open', "", 'still ""open"", yes",2,3', "",
        '5" disk,6" disk,7"', '"x,y","z', '"",q', '",r', 's,t,"', '"""', '",u,v', ",,", '"a\tb",c,"d"',
    ]
    path = tmp_path / "odd.csv"
    for times in (1, 40):
        path.write_text("\n".join(lines[:1] + lines[1:] * times))
        whole = csv_files.read_csv_text(spark, str(path), bad_rows="permissive", split=False, na_null=False)
        split = csv_files.read_csv_text(spark, str(path), bad_rows="permissive", na_null=False)
        assert _rows(split) == _rows(whole)


def test_one_long_record_over_many_splits(spark, tmp_path, small_splits):
    text = "\n".join(f"line {i}, with a comma" for i in range(200))
    path = tmp_path / "long.csv"
    path.write_text(f'﻿one,two\n1,"{text}"\n2,end\n3,"never closed\nat all')
    got = [(r.record, r.is_header) for r in records(spark, str(path)).orderBy(ORD).collect()]
    assert got == [("one,two", True), (f'1,"{text}"', False), ("2,end", False), ('3,"never closed\nat all', False)]


def test_several_files_and_an_empty_one(spark, tmp_path, small_splits):
    for i in range(3):
        _file(tmp_path, f"part-{i}.csv", 40 * i, seed=i)
    (tmp_path / "part-9.csv").write_text("")
    (tmp_path / "other.txt").write_text("not,a,csv\n1,2,3\n")
    got = csv_files.read_sources_dir(spark, str(tmp_path), "part-*.csv", required=[], na_null=False)
    want = [r for i in range(3) for r in _rows(csv_files.read_csv_text(spark, str(tmp_path / f"part-{i}.csv"), na_null=False, split=False))]
    assert sorted(_rows(got), key=str) == sorted(want, key=str)
    assert {r.source_file for r in got.select("source_file").distinct().collect()} == {"part-1.csv", "part-2.csv"}


def test_too_many_cells(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text('one,two\n1,2\n1,"2\n3",4\n')
    with pytest.raises(Exception, match="too many cells"):
        csv_files.read_csv_text(spark, str(path)).collect()
    got = csv_files.read_csv_text(spark, str(path), bad_rows="permissive")
    assert [(r.one, r.two) for r in got.orderBy(ORD).collect()] == [("1", "2"), ("1", "2\n3")]


def test_mixed_headers_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n2,\n')
    (tmp_path / "b.csv").write_text("y,z,processed\nq,w,true\n")
    (tmp_path / "c.csv").write_text("x,y\n3,c\n")
    got = csv_files.read_sources_dir(spark, str(tmp_path), mixed_headers=True)
    assert got.columns == ["x", "y", "z", "processed", ORD, "source_file"]
    rows = [tuple(r) for r in got.drop(ORD).orderBy("source_file", "x").collect()]
    assert rows == [
        ("1", "a\nb", None, None, "a.csv"), ("2", None, None, None, "a.csv"), (None, "q", "w", True, "b.csv"),
        ("3", "c", None, None, "c.csv"),
    ]
    with pytest.raises(Exception, match="too many cells"):
        (tmp_path / "d.csv").write_text("x,y\n3,c,4\n")
        csv_files.read_sources_dir(spark, str(tmp_path), mixed_headers=True).collect()


def test_lines_are_read_once_whatever_the_layouts(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.csv").write_text(f"x,y{i}\n1,2\n")
    read = csv_files.read_sources_dir(spark, str(tmp_path), mixed_headers=True)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert not any("csv" in line.lower() and "Relation" in line for line in plan.splitlines())
    assert read.count() == 4 and len(read.columns) == 7

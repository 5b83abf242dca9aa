"""Repeated byte strings against all strings of a small table compared by a dictionary."""

from __future__ import annotations

import collections
import os
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from content_signals.llm import suffix_dedup
from content_signals.plans.staging import staging_root

SCHEMA = "doc_id long, text string, row int, i string, packed string"


def _rows() -> list[tuple]:
    rng = random.Random(8)
    letters = "abcdé \n"
    passage = "".join(rng.choices(letters, k=150))
    twice = "".join(rng.choices(letters, k=60))
    texts = [None, "", " ", "x", "ab", "aaaa" * 40, "a" * 39, "ab" * 50, passage, passage[:90], f"{passage}{passage}"]
    texts += [f"{twice}{''.join(rng.choices(letters, k=rng.randint(0, 80)))}{twice}" for _ in range(3)]
    for _ in range(25):
        start, end = sorted(rng.sample(range(150), 2))
        texts.append("".join(rng.choices(letters, k=rng.randint(0, 60))) + passage[start:end])
    texts += ["".join(rng.choices("ab", k=120)) for _ in range(4)]
    texts += [f"{rng.random()} {passage[20:130]} {rng.random()}" for _ in range(30)]
    rows = [(i, t, 1, "clash", "x") for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (8, "another text of row eight", 2, None, None), (None, passage, None, None, None)]


def _want(texts: list[bytes], threshold: int) -> list[tuple]:
    times = collections.Counter(t[s : s + threshold] for t in texts for s in range(len(t) - threshold + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - threshold + 1):
            if times[t[s : s + threshold]] > 1:
                gone[s : s + threshold] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((kept, len(t), len(t) - len(kept), int(np.count_nonzero(np.diff(gone.astype(int)) == -1))))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("threshold", [12, 31, 75])
def test_repeated_bytes(docs, threshold):
    texts = [(r[1] or "").encode() for r in _rows()]
    want = collections.Counter((r[0], *w) for r, w in zip(_rows(), _want(texts, threshold)))
    got = suffix_dedup.drop_repeated_bytes(docs, threshold)
    names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
    assert collections.Counter(tuple(bytes(r[c]) if c == "kept" else r[c] for c in names) for r in got.collect()) == want
    assert sum(k[3] for k in want) > 0


def test_the_contracts_threshold(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    shared = prose(300)
    texts = [prose(200) for _ in range(20)] + [f"{prose(40)} {shared[i * 40 : i * 40 + 430]} {prose(30)}" for i in range(25)]
    texts += [shared, shared, prose(50), shared[:399], texts[3][100:499], texts[4][100:500]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.drop_repeated_bytes(df).collect()}
    assert got == dict(enumerate(_want([t.encode() for t in texts], 400)))
    assert got[3][2] == 0 and got[4][2] == 400


def test_no_rows(spark):
    got = suffix_dedup.drop_repeated_bytes(spark.createDataFrame([], SCHEMA))
    assert got.collect() == []
    assert got.columns == ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
    short = spark.createDataFrame([(1, "short"), (2, None)], "doc_id long, text string")
    rows = suffix_dedup.drop_repeated_bytes(short).orderBy("doc_id").collect()
    assert [(bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in rows] == [(b"short", 5, 0, 0), (b"", 0, 0, 0)]


@pytest.mark.parametrize("threshold, piece", [(400, 1 << 20), (400, 1000), (24, 50), (24, 7)])
def test_positions_do_not_depend_on_pieces(threshold, piece):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefg ", k=k)).encode() for k in (0, 30, 399, 400, 2500, 7000)] + [b"a" * 900]

    def rows(piece):
        return sorted(
            row for part in suffix_dedup.positions(texts, threshold, piece) for row in zip(*(c.tolist() for c in part))
        )

    assert rows(piece) == rows(1 << 24) != []


def test_two_phrases_lie_in_every_string():
    for threshold in [*range(3, 60), 400]:
        gram, width = suffix_dedup.geometry(threshold)
        assert threshold - 2 * width - gram + 2 > width


def test_pairs_across_ranges_share_a_rank(spark):
    """A group of equal pairs that fills several ranges, between unique pairs."""
    rows = [(5, 5, r, r % 7) for r in range(5000)] + [(1, r, r, 0) for r in range(300)] + [(9, 1, r, 1) for r in range(2)]
    df = spark.createDataFrame(rows, "a long, b long, row long, i int").repartition(4)
    ranked = suffix_dedup.rank_pairs(df, keep_alone=True).cache()
    groups = {(r.row < 5000 and r.i, r.rank) for r in ranked.filter("repeated").collect()}
    by_rank = ranked.groupBy("rank", "repeated").agg(F.count("*").alias("n"), F.sum(F.col("leads").cast("int")).alias("l"))
    found = collections.Counter((r.n, r.repeated, r.l) for r in by_rank.collect())
    assert found == {(5000, True, 1): 1, (2, True, 1): 1, (1, False, 1): 300}
    assert len({rank for _, rank in groups}) == 2


def test_one_hot_pair_in_every_range(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).selectExpr("7L as a", "7L as b", "id as row", "0 as i")
        ranked = suffix_dedup.rank_pairs(df)
        got = ranked.agg(F.countDistinct("rank"), F.count("*"), F.sum(F.col("leads").cast("int")), F.min("repeated")).first()
        assert tuple(got) == (1, 20000, 1, True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_staged_tables_go_once_they_are_ranked(spark, docs):
    """What stays is what the result is read from: the packed texts and the ranked positions, runs and strings."""
    root = staging_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    got = suffix_dedup.drop_repeated_bytes(docs, 31)
    left = collections.Counter(name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before)
    assert {k: left[k] for k in ("packed-texts", "ranked-pairs", "named-positions", "runs-of-strings", "strings")} == {
        "packed-texts": 1, "ranked-pairs": 3, "named-positions": 0, "runs-of-strings": 0, "strings": 0
    }
    assert got.count() == len(_rows())


def test_ranking_leaves_no_shuffle_files_and_no_settings(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = files.getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before, settings = shuffled(), {k: spark.conf.get(k, None) for k in suffix_dedup._SETTINGS}
    df = spark.range(5000).selectExpr("id % 900 as a", "7L as b", "id as row", "0 as i").repartition(4, "row")
    pairs = suffix_dedup._staged(df.groupBy("a", "b", "i").agg(F.max("row").alias("row")), "pairs")
    assert shuffled() <= before
    assert pairs.count() == 900
    assert {k: spark.conf.get(k, None) for k in suffix_dedup._SETTINGS} == settings


@pytest.mark.parametrize("run", [1, 16])
def test_many_texts_are_hashed_together(run):
    """Runs of many texts come in one batch, with the hashes that each text has by itself."""
    rng = random.Random(4)
    texts = ["".join(rng.choices("abc ", k=rng.randint(90, 160))).encode() for _ in range(60)] + [b"a" * 120] * 3
    kind = pa.struct([(c, pa.int64()) for c in ("start", "n", "place", "group")] + [("settled", pa.bool_())])

    def one(n):
        start, back = rng.randint(0, 9), rng.randint(0, 30)
        return {"start": start, "n": n, "place": start + (back if run > 1 else 0), "group": 5, "settled": False}

    listed = [[one(rng.randint(1, 20)) for _ in range(rng.randint(1, 3))] for _ in texts]
    packed = [zstandard.ZstdCompressor().compress(t) for t in texts]

    def batch(at):
        columns = [pa.array(list(range(len(texts)))[at]), pa.array(packed[at]), pa.array(listed[at], pa.list_(kind))]
        return pa.RecordBatch.from_arrays(columns, names=["row", "packed", "listed"])

    def rows(batches):
        return sorted(tuple(r.values()) for b in batches for r in b.to_pylist())

    together = list(suffix_dedup._hashed(60, run)(iter([batch(slice(None))])))
    assert len(together) == 1
    alone = (b for i in range(len(texts)) for b in suffix_dedup._hashed(60, run)(iter([batch(slice(i, i + 1))])))
    got = rows(together)
    assert got == rows(alone)
    covered = collections.Counter((row, s) for _, _, row, i, n, *_ in got for s in range(i, i + n))
    assert covered == collections.Counter((r, s) for r, l in enumerate(listed) for x in l for s in range(x["start"], x["start"] + x["n"]))
    by_bytes = collections.defaultdict(set)
    for _, _, row, i, n, _, _, h1, h2 in got:
        by_bytes[texts[row][i : i + n - 1 + 60]].add((h1, h2))
    assert all(len(h) == 1 for h in by_bytes.values()) and len(set.union(*by_bytes.values())) == len(by_bytes)


def test_stretches_that_touch_are_one():
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    spans = [[(5, 9), (0, 5)], None, [(0, 4)], [], [(2, 8), (3, 4), (9, 12), (10, 11)]]
    cuts = pa.array([x and [{"start": s, "end": e} for s, e in x] if x is not None else None for x in spans], kind)
    found = [c.tolist() for c in suffix_dedup._stretches(cuts)]
    assert [*zip(*found)] == [(0, 0, 9), (2, 0, 4), (4, 2, 8), (4, 9, 12)]
    assert [len(c) for c in suffix_dedup._stretches(pa.array([None, []], kind))] == [0, 0, 0]

"""Ranked search against scores worked out text by text."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest

from content_signals.llm import lexical_search

SCHEMA = "doc_id long, text string, item_id int, score string"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return re.findall(TERM, (text or "").translate(FOLD))


def _want(docs, items, k):
    counted = [(i, collections.Counter(_terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    total = sum(c.total() for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    merged = collections.defaultdict(set)
    for item, text in items:
        if item is not None:
            merged[item].update(_terms(text))
    out = []
    for item, own in merged.items():
        scored = []
        for i, c in counted:
            m = 50 + (50 * c.total() * n_docs) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in own & c.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return collections.Counter(out)


def _rows():
    rng = random.Random(6)
    words = ["alpha", "Beta", "gamma", "naïve", "ÉCOLE", "école", "x1", "漢字", "a-b", "it's", "the", "THE", "K"]
    words += [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "-- \n ..."), (203, "alpha " * 40_000), (3, "alpha beta"), (None, "alpha"), (None, "beta alpha")]
    docs += [(7, docs[7][1])] * 3 + [(i, "gamma ray") for i in range(300, 320)]
    items = [(1, "alpha"), (2, "Gamma, gamma: RAY"), (3, "É école naïve"), (4, "unknown words"), (5, ""), (6, None), (None, "alpha")]
    items += [(1, "beta!"), (8, "a b it s"), (9, " ".join(words)), (10, "k K K")]
    return docs, items


@pytest.mark.parametrize("cells", [lexical_search.BLOCK_CELLS, 200, 1])
def test_ranked_documents(spark, monkeypatch, cells):
    monkeypatch.setattr(lexical_search, "BLOCK_CELLS", cells)
    monkeypatch.setattr(lexical_search.blocks, "__defaults__", (cells,))
    docs, items = _rows()
    df = spark.createDataFrame([(*d, 1, "clash") for d in docs], SCHEMA).repartition(3)
    bench = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, doc_id int").repartition(2)
    for k in (5, 50):
        got = lexical_search.search(df, bench, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert collections.Counter(map(tuple, got.collect())) == _want(docs, items, k)


def test_empty_tables(spark):
    docs, items = _rows()
    full = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for d, b in ((full.limit(0), bench), (full, bench.limit(0)), (full.filter("doc_id in (200, 201)"), bench)):
        assert lexical_search.search(d, b).collect() == []


def test_terms_are_guarded():
    block = lexical_search.Block([1], [b"art", b"art1", b"part"], [[0, 1, 2]])
    n, times = lexical_search._found(block.automaton(), b"art ART part, art1 smart party\xc3\xa9 art")
    assert (n, dict(times)) == (7, {0: 3, 1: 1, 2: 1})


def test_best_keeps_ties_by_id():
    best = lexical_search.Best(1, 3)
    for ids, scores in (([9, 4], [5, 5]), ([1, 8], [5, 2]), ([2], [5]), ([0], [1])):
        best.add(np.array(ids), np.array([scores]))
    assert best.ids.tolist() == [[1, 2, 4]]

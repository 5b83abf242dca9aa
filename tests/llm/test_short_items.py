"""Short benchmark items inside longer prose."""

from __future__ import annotations

import random

import pytest

from content_signals.llm import decontaminate


@pytest.fixture(scope="module")
def prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("text is not null")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    return docs, [r.text for r in items.orderBy("item_id").limit(40).collect()], decontaminate.fit(docs)


@pytest.mark.parametrize("length", [1, 2, 4, 5, 6, 8, 10, 13, 15])
def test_verbatim_short_items_are_found(spark, prose, length):
    docs, texts, space = prose
    rng = random.Random(length)
    others = [w for r in docs.limit(30).collect() for w in r.text.split()]
    items, rows = [], []
    for i, text in enumerate(texts):
        words = decontaminate.plain(text.encode()).decode().split()
        start = rng.randrange(len(words) - length)
        items.append((i, " ".join(words[start : start + length])))
        rows.append((i, " ".join([*rng.choices(others, k=41 + i), items[-1][1], *rng.choices(others, k=40)])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(table, bench, space).collect()}
    assert [i for i, _ in items if (i, i) not in found] == []
    assert all(found[i, i].common == 1 for i, _ in items)


def test_short_items_with_a_word_replaced(spark, prose):
    docs, texts, space = prose
    rng = random.Random(3)
    items, rows = [], []
    for i, text in enumerate(texts):
        words = decontaminate.plain(text.encode()).decode().split()[:8]
        items.append((i, " ".join(words)))
        words[rng.randrange(8)] = "zzz"
        rows.append((i, " ".join(["qqq"] * rng.randint(20, 40) + words + ["qqq"] * 30)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(table, bench, space).collect()}
    assert [i for i, _ in items if (i, i) not in found] == []

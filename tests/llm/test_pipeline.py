"""Every stage of the pipeline, and ``run``, against plain Python over a small fixture."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from content_signals.llm import quality
from content_signals.llm.queries import quality_model

SF = "/root/testdata/sf0.001"
LINE = "This line of boilerplate stands in a lot of the documents, word for word."


def _plain(text):
    return "".join(c if ord(c) >= 128 or c.isalnum() else " " for c in text.lower()).split()


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """The smallest tables with copies, near copies, a common line, a benchmark item and junk added."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = docs.sparkSession.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rng = random.Random(5)
    rows = [r.asDict() for r in docs.collect()]
    good = [r for r in rows if 60 <= len((r["text"] or "").split()) <= 300][:30]
    words = [w for r in good for w in r["text"].split()]
    at = max(r["doc_id"] for r in rows) + 1

    def add(text):
        rows.append({**good[0], "doc_id": at + len(rows), "text": text, "n_chars": len(text)})

    for r in good[:15]:
        add(r["text"])
        copy = r["text"].split(" ")
        copy[rng.randrange(len(copy))] = "changed"
        add(" ".join(copy))
        add(f"{r['text']}\n{LINE}")
    for r in good[15:25]:
        add(f"{r['text']}\n{item}\n{' '.join(rng.choices(words, k=20))}")
        add("".join(rng.choices("~#%^x0", k=200)))
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages_and_run(spark, fixture, monkeypatch):
    staged = []
    stage = corpus_pipeline.stage
    monkeypatch.setattr(corpus_pipeline, "stage", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    tokens = {r.doc_id: r for r in corpus_pipeline.run(spark, fixture).collect()}
    given = spark.read.parquet(f"{fixture}/documents.parquet")
    texts = [{r.doc_id: r.text for r in df.collect()} for df in (given, *staged)]
    assert len(texts) == len(corpus_pipeline.STAGES) and all(df.columns == given.columns for df in staged)

    scored = quality.score_quality(given, quality_model(spark, fixture))
    good = {r.doc_id for r in scored.filter(F.col("score") >= quality.THRESHOLD).collect()}
    assert texts[1] == {i: t for i, t in texts[0].items() if i in good}
    assert len(texts[1]) < len(texts[0])

    def key(line):
        fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return line.strip(" \t\n\x0b\x0c\r").translate(fold)

    holders = collections.defaultdict(set)
    for i, t in texts[1].items():
        for line in t.split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    common = {k: max(ids) for k, ids in holders.items() if len(ids) >= 5}
    assert key(LINE) in common
    want = {
        i: "\n".join(line for line in t.split("\n") if common.get(key(line), i) == i) for i, t in texts[1].items()
    }
    assert texts[2] == want
    assert all(r.n_chars == len(r.text) for r in staged[1].collect())

    ids = sorted(texts[2])
    prints, group = {i: _fingerprint(texts[2][i]) for i in ids}, {i: {i} for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] is not group[j]:
                group[i] |= group[j]
                for k in group[j]:
                    group[k] = group[i]
    least = {min(g) for g in group.values()}
    assert texts[3] == {i: texts[2][i] for i in least} and len(least) < len(ids)

    items = [" ".join(_plain(r.text)) for r in spark.read.parquet(f"{fixture}/benchmark.parquet").collect()]
    held = {i for i, t in texts[3].items() if any(f" {x} " in f" {' '.join(_plain(t))} " for x in items)}
    assert held and not held & set(texts[4])
    assert texts[4].items() <= texts[3].items()
    assert len(texts[3]) - len(texts[4]) - len(held) <= 0.05 * len(texts[3])

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokens.keys() == texts[4].keys()
    for i, t in texts[4].items():
        assert tokens[i].n_tokens == len(library.encode(t, add_special_tokens=False).ids)
        assert tokens[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_an_id_may_name_several_groups(spark):
    rng = random.Random(2)
    texts = [" ".join(f"{c}{rng.randrange(10**6)}" for _ in range(60)) for c in "abc"]
    rows = [(1, t) for t in texts] + [(i + 2, t.upper()) for i, t in enumerate(texts)] + [(None, texts[0]), (1, texts[1])]
    rows += [(None, "nobody names these words"), (None, "nobody names these words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = collections.Counter(map(tuple, corpus_pipeline.near_deduplication(spark, docs, "").collect()))
    assert kept == collections.Counter([*rows[:3], rows[-1]])

"""Fits that read every row, whatever their number."""

from __future__ import annotations

import random

import numpy as np

from pyspark.sql import functions as F

from content_signals.llm import decontaminate, quality
from content_signals.llm.common import text_key


def test_the_latent_space_is_that_of_all_distinct_texts(spark):
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(2, 12))) + f" word{i % 40}" for i in range(9_000)]
    rows = [(t,) for t in [*texts, *texts[:5] * 400, "", "...", None]]
    space = decontaminate.fit(spark.createDataFrame(rows, "text string").repartition(5))

    docs = [decontaminate._buckets(decontaminate.Words([t.encode()]).hashes) for t in texts]
    used = np.unique(np.concatenate(docs))
    every = [*docs, *docs[:5] * 400]
    held = np.array([np.isin(used, d) for d in every])
    idf = np.log((1 + len(every)) / (1 + held.sum(0)))
    a = np.array([np.bincount(np.searchsorted(used, docs[texts.index(t)]), minlength=len(used)) for t in sorted(set(texts))]) * idf
    a /= np.linalg.norm(a, axis=1)[:, None]
    want = idf[:, None] * np.linalg.inv(a.T @ a) * idf
    got = space.vectors[used].astype(float)
    assert np.allclose(space.idf[used], idf, rtol=1e-5)
    assert np.abs(got @ got.T - want).max() < 0.01 * np.abs(want).max()


def test_the_quality_fit_reads_every_row(spark, monkeypatch):
    rng = random.Random(6)
    plain = lambda i: f"Some plain words, {i} of them. {' '.join(rng.choices(['so', 'on', 'again'], k=i % 9))}"
    texts = {i: f"BUY!! {i} $$$ NOW!!" if i % 4 == 0 else plain(i) for i in range(9_000)}
    rows = [(i, t) for i, t in texts.items()] + [(7, "~ a later copy of seven"), (None, "nobody's")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(9_000) if i % 4 and i % 2] * 2 + [(None,), (10**6,)], "doc_id long")
    monkeypatch.setattr(quality, "_STEPS", 30)
    monkeypatch.setattr(quality, "_GROUP", 3_000)
    first = quality.fit_on(docs.repartition(5), trusted)
    again = quality.fit_on(docs.repartition(2), trusted)
    assert all(np.allclose(a, b, atol=0.01) for a, b in zip(first.layers, again.layers))
    assert abs(first.prior - again.prior) < 0.01
    keys = {r.text: r.key for r in docs.select("text", text_key(docs.text).alias("key")).collect()}
    texts[7] = min(texts[7], "~ a later copy of seven", key=keys.get)
    x = quality.features([t.encode() for t in texts.values()]).astype(float)
    every = np.concatenate([x, x[[i for i in texts if i % 4 and i % 2]]])
    assert np.allclose(first.mean, every.mean(0), rtol=1e-3, atol=1e-5)
    scores = first.score(x.astype(np.float32))
    assert np.mean([(s >= 0.5) == (i % 4 > 0) for i, s in enumerate(scores)]) > 0.95


def test_few_trusted_rows_stand_in_every_group(spark, monkeypatch):
    monkeypatch.setattr(quality, "_GROUP", 100)
    monkeypatch.setattr(quality, "_GROUP_TRUSTED", 10)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1_000)], "doc_id long, text string")
    dealt, groups, counts = quality._dealt(docs, docs.filter("doc_id < 20").select("doc_id"))
    per = {r.part: (r.t, r.n) for r in dealt.groupBy("part").agg(F.sum(F.col("trusted").cast("int")).alias("t"), F.sum(F.col("learned").cast("int")).alias("n")).collect()}
    assert groups == len(per) == 10 and (counts["positives"], counts["unlabelled"]) == (20, 1_000)
    assert min(t for t, _ in per.values()) > 0 and sum(n for _, n in per.values()) == 1_000

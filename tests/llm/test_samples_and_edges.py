"""Bounded samples, absent labels, and texts that once broke an operator."""

from __future__ import annotations

import time

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from content_signals.llm import decontaminate, pii, quality, token_counts, toxicity
from content_signals.llm.queries import QUERIES
from content_signals.plans.staging import new_path


def test_addresses_of_many_zeros():
    zeros = "0" * 5000
    spans = pii.find(f"{zeros}1.2.3.{zeros}4 {zeros}.0.0.00 {zeros}999.1.1.1", ("ip",))
    assert [(s["start"], s["end"]) for s in spans] == [(0, 10007), (10008, 15015)]


def test_equal_rows_are_encoded_once(spark):
    rows = [(1, "the same text")] * 50 + [(2, "another"), (None, "nobody's")] + [(None, "nobody's")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cache = new_path(spark, "test-cache")
    assert token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), cache).count() == len(rows)
    assert spark.read.parquet(cache).count() == 3


def _toxic_rows(n, text):
    return [(i, text.format(i), int(i % 2)) for i in range(n)]


def test_toxicity_sample_passes_over_what_does_not_fit(spark):
    rows = [(i, ("scum here. fine." if i % 2 else "fine words here.") + (" x" * 4000 if i % 10 == 1 else ""), i % 2) for i in range(60)]
    rows += [(1, None, 1), (3, "scum again", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    for bound in (2_000, 20_000, toxicity.MAX_BYTES):
        model = toxicity.fit_on(docs.drop("toxic"), docs.select("doc_id", "toxic"), max_bytes=bound)
        assert model.weights.get("scum", 0) > 0
    again = toxicity.fit_on(docs.drop("toxic").repartition(5), docs.select("doc_id", "toxic"))
    assert again.weights == model.weights
    with pytest.raises(ValueError):
        toxicity.fit_on(docs.drop("toxic"), docs.select("doc_id", "toxic"), max_bytes=10)
    assert toxicity.fit_on(docs.drop("toxic"), docs.select("doc_id", "toxic"), max_bytes=10, if_too_few=toxicity.Model({})).weights == {}


def test_quality_sample_has_one_row_of_each_id(spark):
    rows = [(i, f"text number {i}. It is plain.") for i in range(30)] + [(5, "copy of five")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    trusted = docs.filter("doc_id < 15").select("doc_id")
    first = quality.fit_on(docs, trusted, 10, 20)
    again = quality.fit_on(docs.repartition(2), trusted, 10, 20)
    assert all((a == b).all() for a, b in zip(first.layers, again.layers)) and first.prior == again.prior
    fetched = quality._fetch(docs, docs.select("doc_id").distinct())
    assert fetched.shape == (30, quality.WIDTH)


def test_without_labels_or_documents(spark, tmp_path):
    docs = [(i, f"some words {i}", "en", "web", 12) for i in range(5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("full", docs), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        for query in ("op1_quality_classifier", "op4_toxicity", "op12_suffix_array_dedup"):
            assert QUERIES[query](spark, folder).count() == len(rows)
        assert QUERIES["op11_lexical_search"](spark, folder).count() == 0
        assert corpus_pipeline.run(spark, folder).count() == len(rows)


def _risk(model, p, u, prior):
    z = [model.logits(x) for x in (p, u)]
    loss = lambda v: np.logaddexp(0, v).mean()
    return prior * loss(-z[0]) + max(0.0, loss(z[1]) - prior * loss(z[0]))


def test_training_lowers_the_non_negative_risk(monkeypatch):
    rng = np.random.default_rng(3)
    good = lambda n: rng.normal(1.0, 1, (n, 6)).astype(np.float32)
    bad = lambda n: rng.normal(-1.0, 1, (n, 6)).astype(np.float32)
    p, u = good(400), np.concatenate([good(300), bad(300)])
    risks = []
    for steps in (0, 30, 600):
        monkeypatch.setattr(quality, "_STEPS", steps)
        risks.append(_risk(quality._train(p, u, 0.5, 1), p, u, 0.5))
    assert risks[0] > risks[1] > risks[2]
    scores = quality._train(p, u, 0.5, 1)
    assert (scores.score(good(500)) > 0.5).mean() > 0.9 and (scores.score(bad(500)) < 0.5).mean() > 0.9
    assert 0.35 < quality.estimate_prior(scores.logits(good(400)), scores.logits(u)) < 0.65


def test_documents_score_the_noisy_or_of_their_sentences():
    model = toxicity.Model({"scum": 3.0, "vile": 5.0, "^sli": 1.0})
    words = toxicity._Words(model.weights)
    text = "Scum and vile. Fine words!\nA slimy thing? scum scum"
    chances = []
    for sentence, evidence in (("Scum and vile", 8.0), ("A slimy thing", 1.0), (" scum scum", 3.0)):
        low, high = np.logaddexp(0, toxicity._BIAS), np.logaddexp(0, toxicity._BIAS + evidence)
        chances.append(1 - np.exp(low - high))
        assert np.isclose(toxicity.score_text(sentence, model, words)[0], chances[-1])
    assert np.isclose(toxicity.score_text(text, model, words)[0], 1 - np.prod(1 - np.array(chances)))


def test_blocks_of_short_items_stay_small(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vocabulary = np.array([f"w{i}" for i in range(5000)])
    items = [(i, " ".join(rng.choice(vocabulary, 5))) for i in range(35_000)]
    space = decontaminate.Space(np.append(rng.random(decontaminate.BUCKETS), 0).astype(np.float32),
                                rng.normal(size=(decontaminate.BUCKETS + 1, decontaminate.RANK)).astype(np.float32))
    frame = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate._blocks(frame))
    assert sum(map(len, blocks)) == len(items) and max(map(len, blocks)) <= decontaminate.BLOCK_ITEMS
    start = time.time()
    block = decontaminate.prepare(blocks[0], space)
    size = sum(level.latent.nbytes + sum(w.held.nbytes + w.weight.nbytes + w.row.nbytes for w in level.words) for level in block.levels)
    assert size < 128 << 20
    text = f"{' '.join(rng.choice(vocabulary, 300))} {items[17][1]} end".encode()
    found = {hit["item_id"] for hit in decontaminate.search([text], block, space)[0]}
    assert 17 in found and time.time() - start < 120

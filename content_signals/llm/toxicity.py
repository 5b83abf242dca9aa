"""Toxic documents and the sentences that make them so, learned from document labels.

Multiple-instance learning: a document is a bag of sentences. A sentence's score grows
with the evidence of its words, and the document's is their noisy-or, one minus the
chance that no sentence offends. Only the document's label is known in training; the
sentences' scores follow from it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from content_signals.llm.common import as_bytes, bounded_sample, slices, text_key

#: Bounds of the rows that the fit reads, and of their texts' bytes in all.
MAX_TOXIC = 3_000
MAX_CLEAN = 5_000
MAX_BYTES = 48 << 20
THRESHOLD = 0.5
#: Lengths of word beginnings that are evidence besides the whole word.
PREFIXES = (3, 4, 5, 6, 7, 8)
_MIN_TOXIC, _MIN_RATIO = 3, 4.0
_BIAS = -4.0
_STEPS, _RATE, _PENALTY = 300, 0.1, 3e-5
_KNOWN_WORDS = 1 << 19
_SLICE_BYTES = 4 << 20
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")
_SCHEMA = "doc_id long, score double, sentences array<struct<start:int,end:int,score:double>>"
_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def evidence(word: str) -> list[str]:
    """What of a word may have a weight: the word, and its beginnings."""
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


@dataclass
class Model:
    """Weights of words and beginnings; all are positive, the rest is no evidence."""

    weights: dict[str, float]

    def sentence(self, x: float) -> float:
        """Chance that a sentence with evidence ``x`` offends; none without evidence."""
        return float(-np.expm1(_softplus(_BIAS) - _softplus(_BIAS + x)))


class _Words(dict):
    """Evidence of a word, remembered up to a bound."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = sum(self.weights.get(e, 0.0) for e in evidence(word))
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = value
        return value


def score_text(text: str, model: Model, words: _Words) -> tuple[float, list[dict]]:
    """The document's score and its offending sentences, in code points of the text."""
    if not any(map(words.__getitem__, set(_WORD.findall(text.lower())))):
        return 0.0, []
    clean, offending = 0.0, []  # log of the chance that no sentence offends
    for m in _SENTENCE.finditer(text):
        x = sum(map(words.__getitem__, set(_WORD.findall(m[0].lower()))))
        if x > 0:
            chance = model.sentence(x)
            clean += np.log1p(-min(chance, 1 - 1e-12))
            if chance >= THRESHOLD:
                offending.append({"start": m.start(), "end": m.end(), "score": chance})
    return float(-np.expm1(clean)), offending


def fit(texts: list[str], toxic: list[bool], toxic_share: float | None = None) -> Model:
    """Weights from whole texts and their labels.

    Evidence is screened first: it must stand in enough toxic texts, and far more often
    in them than in clean ones. ``toxic_share`` is the share among all labelled texts,
    by which a sample with more toxic ones is weighed back.
    """
    y = np.array(toxic, bool)
    n_toxic, n_clean = int(y.sum()), int((~y).sum())
    if not n_toxic or not n_clean:
        raise ValueError("both toxic and clean texts are needed to learn from")
    seen = {True: Counter(), False: Counter()}
    for text, label in zip(texts, toxic):
        words = set(_WORD.findall(text.lower()))
        seen[bool(label)].update({e for w in words for e in evidence(w)})
    least = min(_MIN_TOXIC, n_toxic)
    kept = [
        e
        for e, n in seen[True].items()
        if n >= least and n / n_toxic >= _MIN_RATIO * (seen[False][e] + 0.5) / n_clean
    ]
    place = {e: i for i, e in enumerate(sorted(kept))}
    of_word: dict[str, list[int]] = {}
    sentence_of, column, doc_of = [], [], []
    for d, text in enumerate(texts):
        for m in _SENTENCE.finditer(text.lower()):
            found = []
            for w in set(_WORD.findall(m[0])):
                if w not in of_word:
                    of_word[w] = [place[e] for e in evidence(w) if e in place]
                found += of_word[w]
            if found:
                sentence_of += [len(doc_of)] * len(found)
                column += found
                doc_of.append(d)
    row, column, doc = (np.array(v, np.int64) for v in (sentence_of, column, doc_of))
    share = n_toxic / len(y) if toxic_share is None else toxic_share
    weight = np.where(y, share / n_toxic, (1 - share) / n_clean)
    w, m1, m2 = (np.full(len(place), v) for v in (0.5, 0.0, 0.0))
    for step in range(1, _STEPS + 1):
        z = _BIAS + np.bincount(row, w[column], minlength=len(doc))
        total = np.bincount(doc, _softplus(z) - _softplus(_BIAS), minlength=len(y))
        # loss: -log(1 - exp(-total)) of toxic texts, total of clean ones
        slope = weight * np.where(y, -1 / np.expm1(np.maximum(total, 1e-6)), 1.0)
        slope[y & (total <= 0)] = 0
        grad = np.bincount(column, (slope[doc] / (1 + np.exp(-z)))[row], minlength=len(place))
        m1 += 0.1 * (grad - m1)
        m2 += 0.01 * (grad * grad - m2)
        move = (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8 + _PENALTY)
        w = np.maximum(w - _RATE * move - _RATE * _PENALTY / (np.sqrt(m2) + _PENALTY), 0)
    return Model({e: float(w[i]) for e, i in place.items() if w[i] > 1e-3})


def _within(rows: list, share: int) -> list:
    """The rows in their order as long as their texts fit into so many bytes; one that doesn't is passed over."""
    out, size = [], 0
    for row in rows:
        if size + row.bytes <= share:
            out.append(row)
            size += row.bytes
    return out


def fit_on(
    docs: DataFrame,
    labels: DataFrame,
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    max_bytes: int = MAX_BYTES,
    if_too_few: Model | None = None,
) -> Model:
    """Fit on at most so many toxic and clean documents, and ``max_bytes`` of text, half of it for each.

    ``labels`` holds ``doc_id`` and ``toxic``; rows with nulls are not read, a document
    with several labels counts as toxic if one says so. The sample is fixed by a hash of the
    id: sizes are looked up first, documents are taken in that order while they fit into
    their class's bytes, and the texts of those alone are fetched. Of rows that share an id the one
    with the smallest text key counts; null texts are empty. Without a document of each class
    ``if_too_few`` is returned, if given, and else an error raised.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = known.agg(F.avg((F.col("toxic") > 0).cast("int"))).first()[0]
    ids = bounded_sample(known.filter("toxic > 0"), "doc_id", max_toxic, 1).union(
        bounded_sample(known.filter("toxic <= 0"), "doc_id", max_clean, 1)
    )
    rows = docs.select(
        F.col("doc_id").cast("long"), text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    )
    sizes = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic")
    first = F.min(F.struct("key", F.octet_length("text").alias("bytes"))).alias("least")
    order = [F.xxhash64(F.lit(1), "doc_id"), F.col("doc_id")]
    found = sizes.agg(first).select("doc_id", "toxic", "least.*").orderBy(*order).collect()  # a row per chosen id
    label = {
        (r.doc_id, r.key): r.toxic > 0
        for toxic in (True, False)
        for r in _within([r for r in found if (r.toxic > 0) == toxic], max_bytes // 2)
    }
    if if_too_few is not None and len(set(label.values())) < 2:
        return if_too_few
    names = docs.sparkSession.createDataFrame([*label], "doc_id long, key long")
    chosen = rows.join(F.broadcast(names), ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])
    texts = sorted((r.doc_id, r.text, label[r.doc_id, r.key]) for r in chosen.toLocalIterator())
    return fit([t for _, t, _ in texts], [y for _, _, y in texts], share)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, sentences) for every row of ``docs``: whole texts, and where they offend.

    Reads ``doc_id`` and ``text`` only. ``sentences`` lists start, end (exclusive, in code
    points) and score of the offending ones. A null or empty text scores zero; a null
    ``doc_id`` stays null; repeated rows give repeated results. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(model.weights)
        for batch in slices(batches, "text", _SLICE_BYTES):
            found = [score_text(t.decode(), model, words) for t in as_bytes(batch.column("text"))]
            arrays = [
                batch.column("doc_id"),
                pa.array([s for s, _ in found], pa.float64()),
                pa.array([o for _, o in found], _TYPE),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "score", "sentences"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SCHEMA)

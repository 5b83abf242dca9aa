"""Ranked lexical search: every document is scanned for the terms of all items at once.

The items' terms, each between two guards, make one automaton, which is sent to the
tasks. A first scan counts documents and terms, a second one scores: the automaton's
outputs are term numbers, which map to the items that hold the term. Neither scan
keeps anything of a document; a task passes on the best of each item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from content_signals.llm.common import as_bytes, slices

TOP = 50
#: Constants of the score; fixed values.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 1000, 50
#: Cells of the matrix of a block's terms and items: more items are searched for in further passes.
BLOCK_CELLS = 1 << 22
_SLICE_BYTES = 1 << 20
#: Sums of this many terms are exact in doubles: weights stay below 2**16, shares at 10**6.
_EXACT_TERMS = 1 << 16
_ROWS_AT_ONCE = 1024
_GUARD = b" "
_NO_ID = np.iinfo(np.int64).max

#: A-Z in lower case; ASCII other than letters and digits becomes the guard.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def folded(text: bytes) -> bytes:
    """The text with guards for what is in no term; other letters than A-Z are left alone."""
    return text.translate(_FOLD)


def terms(text: bytes) -> list[bytes]:
    return folded(text).split()


@dataclass
class Block:
    """Some items: ids, all their terms, and the numbers of each item's terms."""

    ids: list[int]
    terms: list[bytes]
    held: list[list[int]]

    def automaton(self) -> ahocorasick.Automaton:
        """Bytes stand as the characters 0 to 255; the guards keep matches to whole terms."""
        out = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            out.add_word((_GUARD + term + _GUARD).decode("latin-1"), number)
        out.make_automaton()
        return out

    def incidence(self) -> np.ndarray:
        out = np.zeros((len(self.terms), len(self.ids)))
        for item, numbers in enumerate(self.held):
            out[numbers, item] = 1
        return out


def blocks(items: DataFrame, cells: int = BLOCK_CELLS) -> Iterator[Block]:
    """The items in blocks of bounded size, one in the driver at a time.

    Rows that share an id are one item; rows without id, and items without terms, are left out.
    """
    rows = items.select(F.col("item_id").cast("long"), "text").filter("item_id is not null").orderBy("item_id")
    block, numbers = Block([], [], []), {}
    last, own = None, set()

    def flushed(item: int, own: set[bytes]) -> Iterator[Block]:
        nonlocal block, numbers
        new = own - numbers.keys()
        if block.ids and (len(numbers) + len(new)) * (len(block.ids) + 1) > cells:
            yield block
            block, numbers, new = Block([], [], []), {}, own
        for term in sorted(new):
            numbers[term] = len(numbers)
            block.terms.append(term)
        block.ids.append(item)
        block.held.append(sorted(numbers[term] for term in own))

    for item, text in rows.toLocalIterator():
        if item != last and own:
            yield from flushed(last, own)
            own = set()
        last = item
        own.update(terms((text or "").encode()))
    if own:
        yield from flushed(last, own)
    if block.ids:
        yield block


def _found(automaton: ahocorasick.Automaton | None, text: bytes) -> tuple[int, Counter]:
    """Terms of the text, and how often each term of the automaton stands in it."""
    plain = folded(text)
    n = len(plain.split())
    if not n:
        return 0, Counter()
    guarded = (_GUARD + plain + _GUARD).decode("latin-1")
    return n, Counter(number for _, number in automaton.iter(guarded))


def statistics(docs: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """(documents with a term, their terms with repeats, documents that hold each term of the block)."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    size = len(block.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        out = np.zeros(size + 2, np.int64)
        for batch in slices(batches, "text", _SLICE_BYTES):
            for text in as_bytes(batch.column("text")):
                n, times = _found(automaton, text)
                out[size] += n > 0
                out[size + 1] += n
                out[list(times)] += 1
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], names=["number", "n"])

    counted = docs.select("text").mapInArrow(count, "number long, n long").groupBy("number").agg(F.sum("n"))
    out = np.zeros(size + 2, np.int64)
    for number, n in counted.collect():  # one row per term of the block at most
        out[number] = n
    return int(out[size]), int(out[size + 1]), out[:size]


def weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    """What a term is worth: more, the fewer documents hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency])


def share(times: int, length: int, documents: int, total: int) -> int:
    """A term's part of its weight: grows with its occurrences, less in a long document."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * documents) // total
    return (SCALE * times) // (SATURATION * times + 20 * m)


class Best:
    """The highest-scoring documents of every item, equal scores by ascending id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = np.zeros((items, 0), np.int64)
        self.ids = np.zeros((items, 0), np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: a row per item, a column per document."""
        if self.scores.shape[1] == self.k:  # documents that reach no item's last place are out
            able = (scores >= self.scores[:, -1:]).any(0)
            ids, scores = ids[able], scores[:, able]
        all_scores = np.hstack([self.scores, scores])
        all_ids = np.hstack([self.ids, np.broadcast_to(ids, scores.shape)])
        order = np.lexsort((all_ids, -all_scores), axis=-1)[:, : self.k]
        self.scores = np.take_along_axis(all_scores, order, 1)
        self.ids = np.take_along_axis(all_ids, order, 1)


def _scored(docs: DataFrame, block: Block, k: int) -> DataFrame | None:
    documents, total, frequency = statistics(docs, block)
    if not documents:
        return None
    shared = docs.sparkSession.sparkContext.broadcast((block, weights(documents, frequency)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value
        automaton, worth = block.automaton(), block.incidence() * weight[:, None]
        best = Best(len(block.ids), k)
        held: list[tuple[int, int, Counter]] = []

        def settle() -> None:
            parts = np.zeros((len(held), len(block.terms)))
            for row, (_, n, times) in enumerate(held):
                parts[row, list(times)] = [share(tf, n, documents, total) for tf in times.values()]
            scores = np.zeros((len(held), len(block.ids)), np.int64)
            for at in range(0, len(block.terms), _EXACT_TERMS):
                scores += (parts[:, at : at + _EXACT_TERMS] @ worth[at : at + _EXACT_TERMS]).astype(np.int64)
            best.add(np.array([i for i, _, _ in held]), scores.T)
            held.clear()

        rows = max(1, min(_ROWS_AT_ONCE, BLOCK_CELLS // len(block.terms)))
        for batch in slices(batches, "text", _SLICE_BYTES):
            for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                n, times = _found(automaton, text)
                if times:
                    held.append((_NO_ID if doc is None else doc, n, times))
                if len(held) == rows:
                    settle()
        if held:
            settle()
        item, place = np.nonzero(best.scores > 0)
        ids, ours = best.ids[item, place], np.array(block.ids)[item]
        arrays = [
            pa.array(ours, pa.int64()),
            pa.array(ids, pa.int64(), mask=ids == _NO_ID),
            pa.array(best.scores[item, place], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        score, "item_id long, doc_id long, score long"
    )


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring rows of ``docs`` for each item.

    ``docs`` holds ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns
    are not read. Terms are maximal runs of ASCII letters, digits and any character beyond
    ASCII, with A-Z in lower case. Only scores above 0 count; equal ones are ranked by
    ascending ``doc_id``, rows without one last, and repeated rows of ``docs`` are documents of
    their own. Null and empty texts hold no term. Items that share an id are one item;
    those without id or terms have no rows.

    Each block of items is two scans of the documents. A task passes on at most ``k`` rows
    per item, which are cut to ``k`` again before and after they are shuffled.
    """
    found = [s for block in blocks(items) if (s := _scored(docs, block, k)) is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    by_item = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = rows.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

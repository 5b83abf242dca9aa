"""Benchmark passages in documents, also reworded ones, by latent semantic retrieval.

Passages become TF-IDF vectors over hashed words. A randomised SVD, worked out by Spark
tasks over every distinct text, gives the latent space; inverse document frequencies are
counted over all documents. Every document's overlapping windows are then compared with
the benchmark's by cosine; candidates are confirmed by the longest common subsequence of
words, and by whether the item's last sentence, its answer, is there too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from content_signals.llm.common import as_bytes, bounded_sample, slices, stage
from content_signals.llm.hashing import Words, chunks

BUCKETS = 1 << 15
RANK, OVERSAMPLE = 48, 8
#: Words of a passage in the statistics, and of a window in the search; windows overlap by half.
PASSAGE = 32
WINDOW, STRIDE = 16, 8
#: Windows for items with fewer words: the longest that fits, from every word. One word is a large part of
#: them, so that a replaced one takes away more of the cosine, and the weight is not asked for.
SHORT_WINDOWS = (8, 4, 2, 1)
#: Words between the starts of an item's own windows, where they are long.
ITEM_STRIDE = 2
MIN_COSINE, MIN_SHORT_COSINE = 0.5, 0.1
#: Share of a window's words, weighed by rarity, that must be the item's.
MIN_WEIGHT = 0.35
#: Share of an item's words in common, in order: alone, or with its answer.
MIN_COMMON, MIN_COMMON_WITH_ANSWER, MIN_ANSWER = 0.7, 0.55, 0.8
#: Benchmark text, and items, sent to the tasks at once; more are searched for in further passes.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 20, 1 << 13
_SLICE_BYTES = 4 << 20
#: In the fit, buckets' bytes read and terms multiplied at once, and passages of one task, whose sum is as large
#: whatever it reads.
_TERM_BYTES, _TERMS_AT_ONCE = 1 << 20, 1 << 13
_FIT_TASKS, _PASSAGES_PER_TASK = 8, 1 << 18
_WINDOWS_AT_ONCE, _ITEMS_AT_ONCE, _CELLS = 2048, 64, 1 << 22
_ROWS_PER_BLOCK = 128

#: ASCII other than letters and digits becomes a blank, the rest stays.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    return text.decode().lower().encode().translate(_PLAIN)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - int(math.log2(BUCKETS)))).astype(np.int64)


def _cut(first: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``step`` words that begin anew in every document, and their documents."""
    counts = np.diff(first)
    blocks = -(-counts // step)
    doc = np.repeat(np.arange(len(counts)), blocks)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return first[:-1][doc] + place * step, doc


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per passage its document and how many distinct words it has; of these, by passage, bucket and times."""
    w = Words(texts)
    starts, doc = _cut(w.first, PASSAGE)
    passage = np.zeros(len(w.hashes), np.int64)
    passage[starts[1:]] = 1
    keys = np.sort(np.cumsum(passage) * BUCKETS + _buckets(w.hashes))
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.diff(np.append(new, len(keys)))
    return doc, np.bincount(keys[new] // BUCKETS, minlength=len(starts)), keys[new] % BUCKETS, times


def _passages(texts: DataFrame) -> DataFrame:
    """(hash, sizes, buckets, times) of every text that has words: its passages' terms, 3 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            texts = [plain(t) for t in as_bytes(batch.column("text"))]
            for a, b in chunks(texts):
                doc, sizes, bucket, times = _terms(texts[a:b])
                passages = np.cumsum(np.bincount(doc, minlength=b - a)).tolist()
                terms = np.cumsum(np.bincount(doc, sizes, minlength=b - a)).astype(np.int64).tolist()
                columns = [(sizes.astype(np.uint8), passages), (bucket.astype(np.uint16), terms), (times.astype(np.uint8), terms)]
                packed = [[c[i:j].tobytes() for i, j in zip([0, *ends], ends)] for c, ends in columns]
                arrays = [batch.column("hash").slice(a, b - a), *(pa.array(c, pa.binary()) for c in packed)]
                yield pa.RecordBatch.from_arrays(arrays, names=["hash", "sizes", "buckets", "times"])

    schema = "hash long, sizes binary, buckets binary, times binary"
    return texts.select("hash", "text").mapInArrow(run, schema).filter("octet_length(sizes) > 0")


def _unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    columns = (("sizes", np.uint8), ("buckets", np.uint16), ("times", np.uint8))
    return [np.frombuffer(b"".join(batch.column(c).to_pylist()), kind) for c, kind in columns]


def document_frequencies(passages: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages, copies counted, each bucket stands, and the number of passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS + 1, np.int64)  # the last one counts passages
        for batch in slices(batches, "buckets", _TERM_BYTES):
            _, bucket, _ = _unpacked(batch)
            copies = np.asarray(batch.column("copies"), np.int64)
            terms = pc.binary_length(batch.column("buckets")).to_numpy(zero_copy_only=False) // 2
            found[:-1] += np.bincount(bucket, np.repeat(copies, terms), minlength=BUCKETS).astype(np.int64)
            found[-1] += int((copies * pc.binary_length(batch.column("sizes")).to_numpy(zero_copy_only=False)).sum())
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["bucket", "n"])

    counted = passages.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in counted.collect():  # one row per bucket at most
        out[bucket] = n
    return out[:-1], int(out[-1])


def _sums(starts: np.ndarray, counts: np.ndarray, weight: np.ndarray, row: np.ndarray, of: np.ndarray) -> Iterator[tuple]:
    """Of stretches of terms the sums of the terms' rows in ``of``, weighed; stretches of one length together."""
    for count in np.unique(counts).tolist():
        alike = np.flatnonzero(counts == count)
        step = max(1, _TERMS_AT_ONCE // count)
        for k in (alike[i : i + step] for i in range(0, len(alike), step)):
            terms = starts[k][:, None] + np.arange(count)
            yield k, (weight[terms][:, None, :] @ np.take(of, row[terms], axis=0))[:, 0]


def _add_products(out: np.ndarray, sizes: np.ndarray, bucket: np.ndarray, weight: np.ndarray, basis: np.ndarray) -> None:
    """Add ``A' A basis`` of some passages, the rows of A, which are brought to unit length."""
    starts = np.cumsum(sizes) - sizes
    norm = np.sqrt(np.add.reduceat(weight * weight, starts))
    weight = weight / np.repeat(np.maximum(norm, 1e-9), sizes)
    rows = np.empty((len(sizes), basis.shape[1]), np.float32)
    for k, sums in _sums(starts, sizes, weight, bucket, basis):
        rows[k] = sums
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order].astype(np.int32), prepend=-1))
    passage = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
    for k, sums in _sums(cuts, np.diff(np.append(cuts, len(order))), weight[order], passage, rows):
        out[bucket[order[cuts[k]]]] += sums


def _products(passages: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``A' A basis`` for all passages A, summed by Spark tasks."""
    width = basis.shape[1]
    shared = passages.sparkSession.sparkContext.broadcast((idf.astype(np.float32), basis.astype(np.float32)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis = shared.value
        out = np.zeros((BUCKETS, width))
        for batch in slices(batches, "buckets", _TERM_BYTES):
            sizes, bucket, times = _unpacked(batch)
            _add_products(out, sizes.astype(np.int64), bucket, times * idf[bucket], basis)
        blocks = [i for i in range(0, BUCKETS, _ROWS_PER_BLOCK) if out[i : i + _ROWS_PER_BLOCK].any()]
        packed = [out[i : i + _ROWS_PER_BLOCK].astype(np.float32).tobytes() for i in blocks]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], names=["at", "part"])

    def add(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_ROWS_PER_BLOCK * width)
        for part in (p for batch in batches for p in batch.column("part")):
            total += np.frombuffer(part.as_buffer(), np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[0].as_py()], pa.int32()), pa.array([total.tobytes()])], names=["at", "part"]
        )

    parts = passages.mapInArrow(multiply, "at int, part binary")
    out = np.zeros((BUCKETS, width))
    for at, part in parts.groupBy("at").applyInArrow(add, "at int, part binary").collect():
        out[at : at + _ROWS_PER_BLOCK] = np.frombuffer(part).reshape(-1, width)
    shared.destroy()
    return out


def _directions(basis: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first eigenvectors and eigenvalues of ``A' A``, by Nystrom's approximation from its product with a basis."""
    values, turn = np.linalg.eigh(basis.T @ product)
    some = values > 1e-9 * max(values.max(), 1e-300)
    vectors, sizes, _ = np.linalg.svd(product @ (turn[:, some] / np.sqrt(values[some])), full_matrices=False)
    return vectors[:, :RANK], sizes[:RANK] ** 2


@dataclass
class Space:
    """Per bucket its inverse document frequency, and its coordinates weighed by that."""

    idf: np.ndarray
    vectors: np.ndarray


def fit(docs: DataFrame, max_documents: int | None = None, seed: int = 11) -> Space:
    """The latent space of the texts in ``docs``, with every direction given equal weight.

    Null and empty texts count for nothing, other columns are not read; of no texts at all
    comes a space in which every vector is zero, and the search goes by words alone.

    Frequencies are counted over all of ``docs``, and the randomised SVD reads every distinct text
    once; its passages' terms are written to the shared folder first. Random columns are
    multiplied by ``A' A``, made orthonormal and multiplied again (two passes), which gives the
    singular directions. What comes to the driver is ``BUCKETS`` by ``RANK + OVERSAMPLE``
    numbers, whatever the input. A caller who sets ``max_documents`` has the SVD, but not the
    frequencies, read at most so many distinct texts, chosen by a hash.
    """
    keyed = docs.filter("text is not null").select(F.xxhash64("text").alias("hash"), "text")
    if max_documents is None:
        once = [F.first(c).alias(c) for c in ("sizes", "buckets", "times")]
        distinct = _passages(keyed).groupBy("hash").agg(*once, F.count(F.lit(1)).alias("copies"))
        passages = stage(distinct, "passages")
        frequency, total = document_frequencies(passages)
        passages = passages.coalesce(max(_FIT_TASKS, total // _PASSAGES_PER_TASK))
    else:
        frequency, total = document_frequencies(_passages(keyed).withColumn("copies", F.lit(1).cast("long")))
        hashes = bounded_sample(keyed.select("hash").distinct(), "hash", max_documents, seed)
        sample = keyed.join(F.broadcast(hashes), "hash", "left_semi").dropDuplicates(["hash"])
        passages = _passages(stage(sample.repartition(_FIT_TASKS), "svd-sample"))
    idf = np.log((1 + total) / (1 + frequency))
    vectors = np.zeros((BUCKETS + 1, RANK))  # the last row is no word's
    if idf.any():
        basis = np.random.default_rng(seed).normal(size=(BUCKETS, RANK + OVERSAMPLE))
        basis = np.linalg.qr(_products(passages, idf, basis))[0]
        found, values = _directions(basis, _products(passages, idf, basis))
        vectors[:-1, : len(values)] = idf[:, None] * found / np.sqrt(np.maximum(values, 1e-9))
    return Space(np.append(idf, 0).astype(np.float32), vectors.astype(np.float32))


@dataclass
class Words64:
    """Which words some items hold: a row per word of theirs, the first for any other, a column per item."""

    row: np.ndarray  # of each bucket
    held: np.ndarray
    weight: np.ndarray  # the same, weighed by rarity


@dataclass
class Level:
    """Items that are searched for by windows of one length."""

    window: int
    stride: int
    min_cosine: float
    min_weight: float
    members: np.ndarray  # the items
    slot: np.ndarray  # of each of the items' windows: whose it is, among the members
    place: np.ndarray
    latent: np.ndarray
    known: np.ndarray  # the buckets of any of the items' words
    needed: np.ndarray  # per member: its words that a window must hold
    least: int  # the fewest of those
    words: list[Words64]  # of so many members each


@dataclass
class Items:
    """A block of benchmark items, ready to be searched for."""

    ids: list[int]
    lengths: list[int]
    masks: list[dict[int, int]]  # per item: a word's hash to the places it stands at, as bits
    times: list[dict[int, int]]  # per item: a word's hash to how often it stands there
    answers: list[dict[int, int]]
    answer_lengths: list[int]
    known: np.ndarray  # the buckets of any item's words
    levels: list[Level]


def _masks(hashes: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, h in enumerate(hashes.tolist()):
        out[h] = out.get(h, 0) | 1 << i
    return out


def answer_of(text: str) -> str:
    """The item's last sentence."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if any(map(str.isalnum, s))]
    return sentences[-1] if sentences else ""


def _words(members: list[np.ndarray], space: Space) -> Words64:
    """The words of some items, given by their buckets."""
    every = np.unique(np.concatenate(members))
    row = np.zeros(BUCKETS + 1, np.int32)
    row[every] = np.arange(1, len(every) + 1)
    held = np.zeros((len(every) + 1, len(members)), np.uint8)
    for n, bucket in enumerate(members):
        held[row[bucket], n] = 1
    return Words64(row, held, held * np.append(0, space.idf[every]).astype(np.float32)[:, None])


def _level(window: int, members: list[int], buckets: list[np.ndarray], space: Space) -> Level:
    """The windows of the items ``members``; items hardly longer than one may lie across two of the text's."""
    long = window == WINDOW
    stride, step = (STRIDE, ITEM_STRIDE) if long else (1, 1)
    slot, place, latent = [], [], []
    known, needed = np.zeros(BUCKETS + 1, bool), np.zeros(len(members), np.int64)
    for m, n in enumerate(members):
        bucket = buckets[n]
        known[bucket] = True
        across = stride // 2 if len(bucket) < window + stride else 0
        needed[m] = math.ceil(MIN_COMMON_WITH_ANSWER * (window - across))
        for start in {*range(0, len(bucket) - window + 1, step), len(bucket) - window}:
            slot.append(m)
            place.append(start)
            latent.append(space.vectors[bucket[start : start + window]].sum(0))
    gates = (MIN_COSINE, MIN_WEIGHT) if long else (MIN_SHORT_COSINE, 0.0)
    vectors = _unit(np.array(latent, np.float32))[0]
    own = [[buckets[n] for n in members[i : i + _ITEMS_AT_ONCE]] for i in range(0, len(members), _ITEMS_AT_ONCE)]
    words = [_words(part, space) for part in own]
    arrays = (np.array(members), np.array(slot), np.array(place), vectors, known, needed)
    return Level(window, stride, *gates, *arrays, int(needed.min()), words)


def prepare(items: list[tuple[int, str]], space: Space) -> Items | None:
    rows = [(i, t, Words([plain(t.encode())]).hashes) for i, t in items]
    rows = [r for r in rows if len(r[2])]
    if not rows:
        return None
    out = Items([], [], [], [], [], [], np.zeros(BUCKETS + 1, bool), [])
    by_window: dict[int, list[int]] = {}
    buckets = [_buckets(hashes) for _, _, hashes in rows]
    for n, (i, text, hashes) in enumerate(rows):
        answer = Words([plain(answer_of(text).encode())]).hashes
        out.ids.append(i)
        out.lengths.append(len(hashes))
        out.masks.append(_masks(hashes))
        out.times.append({word: places.bit_count() for word, places in out.masks[-1].items()})
        out.answers.append(_masks(answer))
        out.answer_lengths.append(len(answer))
        out.known[buckets[n]] = True
        by_window.setdefault(next(w for w in (WINDOW, *SHORT_WINDOWS) if w <= len(hashes)), []).append(n)
    out.levels = [_level(w, members, buckets, space) for w, members in sorted(by_window.items(), reverse=True)]
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.maximum(norm, 1e-9)[:, None], norm


def common_words(words: list[int], masks: dict[int, int], length: int) -> int:
    """Length of the longest common subsequence, all places of the item at once as bits."""
    full = (1 << length) - 1
    rest = full
    for word in words:
        if mask := masks.get(word):
            taken = rest & mask
            rest = ((rest + taken) | (rest - taken)) & full
    return length - rest.bit_count()


def search(texts: list[bytes], items: Items, space: Space) -> list[list[dict]]:
    """Per text the items found in it, each once, with the best common share."""
    out: list[list[dict]] = [[] for _ in texts]
    w = Words(texts)
    if not len(w.hashes):
        return out
    bucket = _buckets(w.hashes)
    ours = items.known[bucket]  # other words are in no item and need no comparing
    found: dict[tuple[int, int], dict] = {}
    for level in items.levels:
        for doc, begin, cosine, n in _candidates(w, bucket, items, level, space):
            _confirm(found, w, ours, doc, begin, cosine, items, n)
    for (d, _), hit in sorted(found.items()):
        if hit["common"] >= MIN_COMMON or (hit["common"] >= MIN_COMMON_WITH_ANSWER and hit["answer"]):
            out[d].append(hit)
    return out


def _candidates(w: Words, bucket: np.ndarray, items: Items, level: Level, space: Space) -> Iterator[tuple]:
    """(document, word, cosine, item): where an item would begin if a window near it were the item's.

    A window's words of an item are among those of all items, so one with too few of
    these, or of too little weight, is left at once; then the same is asked for each item. Only
    windows that hold enough of some item get a vector, and the cosine decides for those items.
    """
    starts, doc = _cut(w.first, level.stride)
    end = w.first[doc + 1]
    ends = np.minimum(starts + level.window, end)
    # what the window before holds already is no window, unless there is none
    fresh = (starts == w.first[doc]) | (starts - level.stride + level.window < end)
    ours = level.known[bucket]
    idf = space.idf[bucket].astype(np.float64)
    count, part, whole = (np.concatenate([[0], np.cumsum(c)]) for c in (ours, idf * ours, idf))
    short = np.minimum(level.least, np.ceil(MIN_COMMON_WITH_ANSWER * np.diff(w.first)[doc])).astype(np.int64)
    least = 0.999 * level.min_weight * (whole[ends] - whole[starts])
    enough = part[ends] - part[starts] >= least
    near = np.flatnonzero(fresh & enough & (count[ends] - count[starts] >= short))
    bucket = np.append(bucket, BUCKETS)  # a bucket without coordinates fills short windows up
    tried: set[tuple[int, int, int]] = set()  # where an item has been compared, to a stride
    items, size = len(level.members), len(level.slot)
    at_once = max(1, min(_WINDOWS_AT_ONCE, _CELLS // items))
    for low in range(0, len(near), at_once):
        part = near[low : low + at_once]
        words = starts[part][:, None] + np.arange(level.window)
        words = bucket[np.where(words < ends[part][:, None], words, len(bucket) - 1)]
        holds = _holds(words, least[part], short[part], level)
        some = np.flatnonzero(holds.any(1))
        for first in range(0, len(some), max(1, _CELLS // size)):
            own = some[first : first + max(1, _CELLS // size)]
            vectors, norm = _unit(space.vectors[words[own]].sum(1))
            cosine = vectors @ level.latent.T
            cosine[norm < 1e-6] = 1  # no common direction: leave it to the words
            x, y = np.nonzero((cosine >= level.min_cosine) & holds[own][:, level.slot])
            at = part[own[x]]
            begin = starts[at] - level.place[y]
            member = level.members[level.slot[y]]
            for d, b, n, c in zip(doc[at].tolist(), begin.tolist(), member.tolist(), cosine[x, y].tolist()):
                if (d, n, b // level.stride) not in tried:
                    tried.add((d, n, b // level.stride))
                    yield d, b, c, n


def _holds(words: np.ndarray, least: np.ndarray, short: np.ndarray, level: Level) -> np.ndarray:
    """Which windows, given by their words, hold enough words of which members, and enough of their weight."""
    parts = []
    for i, some in enumerate(level.words):
        row = some.row[words]
        count = np.zeros((len(words), some.held.shape[1]), np.uint8)
        weight = np.zeros(count.shape, np.float32)
        for place in range(level.window):
            count += some.held[row[:, place]]
            if level.min_weight:
                weight += some.weight[row[:, place]]
        needed = level.needed[i * _ITEMS_AT_ONCE :][: count.shape[1]]
        parts.append((count >= np.minimum(short[:, None], needed)) & (weight >= least[:, None]))
    return np.hstack(parts)


def _confirm(found, w: Words, ours, doc: int, begin: int, cosine: float, items: Items, n: int) -> None:
    """Compare the words about ``begin``, where the item would lie if the windows are the same place."""
    length = items.lengths[n]
    before = found.get((doc, n))
    if before and before["common"] >= 0.95:
        return
    slack = STRIDE + length // 4
    low = max(int(w.first[doc]), begin - slack)
    high = min(int(w.first[doc + 1]), begin + length + slack)
    words = w.hashes[low:high][ours[low:high]].tolist()
    # the item's places whose word is here at all bound those in order from above
    times = items.times[n]
    if sum(map(times.__getitem__, times.keys() & words)) / length < MIN_COMMON_WITH_ANSWER:
        return
    share = common_words(words, items.masks[n], length) / length
    if share < MIN_COMMON_WITH_ANSWER or (before and before["common"] >= share):
        return
    of = items.answer_lengths[n]
    answer = of > 0 and common_words(words, items.answers[n], of) >= MIN_ANSWER * of
    found[doc, n] = {
        "item_id": items.ids[n], "cosine": cosine, "common": share, "answer": answer, "word": low - int(w.first[doc])
    }


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded size, one in the driver at a time."""
    block, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        if item is None or not text:
            continue
        if block and (size + len(text) > BLOCK_BYTES or len(block) == BLOCK_ITEMS):
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


def _each(docs: DataFrame, benchmark: DataFrame, space: Space):
    """For every block of items a function from a record batch to its rows' findings."""
    context = docs.sparkSession.sparkContext
    for block in _blocks(benchmark):
        items = prepare(block, space)
        if items is None:
            continue
        shared = context.broadcast((items, space))

        def look(batch: pa.RecordBatch, shared=shared) -> list[list[dict]]:
            items, space = shared.value
            texts = [plain(t) for t in as_bytes(batch.column("text"))]
            return [hits for a, b in chunks(texts) for hits in search(texts[a:b], items, space)]

        yield look


_FOUND = "doc_id long, item_id long, cosine double, common double, answer boolean, word int"


def find_leaks(docs: DataFrame, benchmark: DataFrame, space: Space) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer, word): a row for each item found in a row of ``docs``.

    ``docs`` holds ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other
    columns are not read. Words are compared without case and ASCII punctuation. An item
    is found where at least ``MIN_COMMON`` of its words stand in order, or
    ``MIN_COMMON_WITH_ANSWER`` with its answer; ``common`` is that share, ``word`` the
    place in the document from which it was compared. Null or empty texts hold nothing,
    items without words are not looked for, a null ``doc_id`` stays null, repeated rows
    give repeated results. Each block of items is one pass; nothing is shuffled.
    """
    found = []
    for look in _each(docs, benchmark, space):

        def run(batches: Iterator[pa.RecordBatch], look=look) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", _SLICE_BYTES):
                ids = batch.column("doc_id").to_pylist()
                hits = [{"doc_id": i, **hit} for i, own in zip(ids, look(batch)) for hit in own]
                schema = pa.schema(
                    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()),
                     ("common", pa.float64()), ("answer", pa.bool_()), ("word", pa.int32())]
                )
                yield pa.RecordBatch.from_pylist(hits, schema=schema)

        found.append(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _FOUND))
    if not found:
        return docs.sparkSession.createDataFrame([], _FOUND)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, space: Space) -> DataFrame:
    """The rows of ``docs``, all columns, in which ``find_leaks`` finds nothing.

    Rows with a null or empty text stay, whatever their ``doc_id``, and repeated rows are
    judged alike. Without items all rows stay.
    """
    out = docs
    for look in _each(docs, benchmark, space):

        def run(batches: Iterator[pa.RecordBatch], look=look) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", _SLICE_BYTES):
                yield batch.filter(pa.array([not hits for hits in look(batch)], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out

"""Long passages that an earlier document also holds, removed word by word.

A window is a run of consecutive words. Every partition sketches its windows into
the same table of counters (count-min: two rows, each window counted at one place
per row). The sketches travel as sorted, gap-coded places, shard by shard, and are
merged into one bit per counter: "counted more than once". A window is estimated
repeated if both its bits are set; the estimate errs to the high side only, so no
repeated window is lost. Only those windows are grouped exactly, by 128 bits of
hash, to learn the smallest document of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from content_signals.llm.common import as_bytes, slices, text_key
from content_signals.llm.hashing import Words, chunks

WINDOW = 50
#: Counters per row and window; fewer raise the share of windows grouped in vain.
COUNTERS_PER_WINDOW = 2
#: Bound of the broadcast: two rows of ``2**30`` bits, 256 MB. Beyond it estimates rise, nothing is lost.
MAX_COUNTERS_LOG2 = 30
_MIN_COUNTERS_LOG2 = 16
_SHARD_LOG2 = 20
#: Windows that a task holds before it passes their sketch, or their candidates, on.
_FLUSH = 4 << 20
_FLUSH_CANDIDATES = 1 << 19
#: Windows that one exact group of buckets should hold.
_BUCKET = 1 << 20
_SLICE_BYTES = 4 << 20
_ROWS = 2


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their high bytes apart, which compress to next to nothing."""
    return numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _pack_gaps(places: np.ndarray) -> bytes:
    """Sorted numbers as variable-length gaps, seven bits a byte."""
    gaps = np.diff(places, prepend=0).astype(np.uint32)
    length = 1 + (gaps >= 1 << 7) + (gaps >= 1 << 14) + (gaps >= 1 << 21)
    ends = np.cumsum(length)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    first = ends - length
    for i in range(4):
        more = length > i
        byte = (gaps[more] >> np.uint32(7 * i)) & np.uint32(127)
        out[first[more] + i] = byte | ((length[more] > i + 1).astype(np.uint8) << 7)
    return out.tobytes()


def _unpack_gaps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    shift = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    return np.cumsum(np.add.reduceat((raw & 127).astype(np.int64) << (7 * shift), first))


def _places(h1: np.ndarray, h2: np.ndarray, log2: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - log2)
    return (h1 >> shift).astype(np.uint32), (h2 >> shift).astype(np.uint32)


def _windows(batch: pa.RecordBatch, window: int) -> Iterator[tuple]:
    """Per chunk of documents: first row, then each window's row in the chunk, place and hashes."""
    texts = as_bytes(batch.column("text"))
    for a, b in chunks(texts):
        yield a, *Words(texts[a:b]).windows(window)


def _sketches(window: int, log2: int):
    shard_log2 = min(_SHARD_LOG2, log2)

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        rows, shards, packed = [], [], []
        for r in range(_ROWS):
            places = np.concatenate([h[r] for h in held])
            places.sort()
            cuts = _starts(places >> np.uint32(shard_log2))
            for start, end in zip(cuts, np.append(cuts[1:], len(places))):
                shard = int(places[start]) >> shard_log2
                rows.append(r)
                shards.append(shard)
                packed.append(_pack_gaps(places[start:end] - np.uint32(shard << shard_log2)))
        arrays = [pa.array(rows, pa.int32()), pa.array(shards, pa.int32()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["r", "shard", "places"])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in slices(batches, "text", _SLICE_BYTES):
            for _, _, _, h1, h2, _ in _windows(batch, window):
                held.append(_places(h1, h2, log2))
                n += len(h1)
                if n >= _FLUSH:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    return sketch


def _merge(size: int):
    """Places counted more than once, as a bit each; the counters are those of one shard."""

    def merge(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = np.zeros(size, bool), np.zeros(size, bool)
        for batch in batches:
            for packed in batch.column("places").to_pylist():
                places = _unpack_gaps(packed)
                again = places[1:][places[1:] == places[:-1]]
                more[again] = True
                more[places[once[places]]] = True
                once[places] = True
        row, shard = (k.as_py() for k in keys)
        arrays = [
            pa.array([row], pa.int32()),
            pa.array([shard], pa.int32()),
            pa.array([np.packbits(more, bitorder="little").tobytes()], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["r", "shard", "bits"])

    return merge


def estimate(rows: DataFrame, window: int) -> tuple[int, np.ndarray]:
    """(log2 of the counters in a row, bits of the counters above one) of the merged sketch."""
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    wanted = COUNTERS_PER_WINDOW * total / 6  # a word and its space take about six bytes
    log2 = min(MAX_COUNTERS_LOG2, max(_MIN_COUNTERS_LOG2, math.ceil(math.log2(wanted + 1))))
    size = 1 << min(_SHARD_LOG2, log2)
    merged = (
        rows.select("text")
        .mapInArrow(_sketches(window, log2), "r int, shard int, places binary")
        .groupBy("r", "shard")
        .applyInArrow(_merge(size), "r int, shard int, bits binary")
    )
    bits = np.zeros((_ROWS, (1 << log2) // 8), np.uint8)
    step = size // 8
    for r, shard, packed in merged.toLocalIterator():
        bits[r, shard * step : (shard + 1) * step] = np.frombuffer(packed, np.uint8)
    return log2, bits


_LISTED = "bucket int, doc binary, key binary, times binary, place binary, h1 binary, h2 binary"


def _candidates(window: int, log2: int, shared, buckets: int):
    """Windows estimated repeated, by bucket of their lead.

    Neighbouring windows mostly share a lead, so a document's stay together.

    Of equal windows in one task only the smallest document's goes on to be
    compared; those of larger documents are settled here and go along without hash.
    So a window meets at most one row per task, however many documents hold it.
    """

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*held)]
        order = np.lexsort((columns[0], columns[4], columns[3]))
        doc, key, place, h1, h2, bucket = (c[order] for c in columns)
        new = _starts(h1, h2)
        settled = doc > np.repeat(doc[new], np.diff(np.append(new, len(doc))))
        for done in (True, False):
            chosen = np.flatnonzero(settled == done)
            chosen = chosen[np.lexsort((place[chosen], key[chosen], doc[chosen], bucket[chosen]))]
            cuts = _starts(bucket[chosen])
            for start, end in zip(cuts, np.append(cuts[1:], len(chosen))):
                own = chosen[start:end]
                first = _starts(doc[own], key[own])
                parts = [
                    doc[own[first]].tobytes(),
                    key[own[first]].tobytes(),
                    _planes(np.diff(np.append(first, len(own)))),
                    _planes(place[own]),
                    b"" if done else h1[own].tobytes(),
                    b"" if done else h2[own].tobytes(),
                ]
                arrays = [pa.array([int(bucket[own[0]])], pa.int32())]
                arrays += [pa.array([p], pa.binary()) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["bucket", "doc", "key", "times", "place", "h1", "h2"]
                )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, n = shared.value, [], 0
        for batch in slices(batches, "text", _SLICE_BYTES):
            docs = np.asarray(batch.column("doc"), np.int64)
            keys = np.asarray(batch.column("key"), np.int64)
            for first, row, place, h1, h2, lead in _windows(batch, window):
                near = np.ones(len(h1), bool)
                for r, at in enumerate(_places(h1, h2, log2)):
                    near &= (bits[r][at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & 1 > 0
                row = first + row[near]
                low = h2[near].astype(np.uint32)  # 96 bits tell windows apart
                bucket = (lead[near] % np.uint64(buckets)).astype(np.int32)
                held.append((docs[row], keys[row], place[near].astype(np.uint32), h1[near], low, bucket))
                n += len(row)
                if n >= _FLUSH_CANDIDATES:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return find


def _decide(batch_keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of a bucket that start in a smaller document, as places per document."""

    def emit(doc, key, row, place) -> pa.RecordBatch:
        cuts = _starts(row)
        places = [_planes(place[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(row)))]
        arrays = [pa.array(doc[row[cuts]]), pa.array(key[row[cuts]]), pa.array(places, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc", "key", "places"])

    held, offset = [], 0
    for batch in batches:
        for _, doc, key, times, place, h1, h2 in zip(
            *(batch.column(i).to_pylist() for i in range(batch.num_columns))
        ):
            doc, key, place = np.frombuffer(doc, np.int64), np.frombuffer(key, np.int64), _from_planes(place)
            row = np.repeat(np.arange(len(doc)), _from_planes(times))
            if h1:
                hashes = np.frombuffer(h1, np.uint64), np.frombuffer(h2, np.uint32)
                held.append((doc, key, row + offset, place, *hashes))
                offset += len(doc)
            else:
                yield emit(doc, key, row, place)
    if held:
        doc, key, row, place, h1, h2 = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((doc[row], h2, h1))
        new = _starts(h1[order], h2[order])
        owner = doc[row[order]]
        least = np.repeat(owner[new], np.diff(np.append(new, len(order))))
        removed = np.sort(order[owner > least])  # back in the order of their documents
        if len(removed):
            yield emit(doc, key, row[removed], place[removed])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts made small for the way to their removed windows."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches, "text", _SLICE_BYTES):
        texts = pa.array(map(packer.compress, as_bytes(batch.column("text"))), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), texts], names=["doc_id", "key", "packed"]
        )


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in slices(batches, "packed", _SLICE_BYTES // 4):
            kept, n_words, n_removed = [], [], []
            for packed, lists in zip(batch.column("packed").to_pylist(), batch.column("places").to_pylist()):
                words = unpacker.decompress(packed).split()  # at space and \t to \r only
                n_words.append(len(words))
                if lists:
                    edge = np.zeros(len(words) + 1, np.int64)
                    starts = np.unique(np.concatenate([_from_planes(p) for p in lists]))
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            arrays = [
                batch.column("doc_id"),
                pa.array(kept, pa.string()),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "kept_text", "n_words", "n_removed"])

    return cut


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, kept_text, n_words, n_removed) for every row of ``docs``.

    ``docs`` holds ``doc_id`` and ``text``; other columns are not read. Words are
    runs of anything but space and ``\\t`` to ``\\r``, unchanged. A word is removed
    if a window of its document covers it whose words also start somewhere in a
    document with a smaller ``doc_id``; windows are judged on the given texts. The
    kept words are joined by one space. A null or empty text has no words. Rows that
    share a ``doc_id`` are one document and don't remove each other's words. A row
    without ``doc_id`` keeps all its words and removes none.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.filter("doc_id is not null").select(
        F.col("doc_id").alias("doc"), text_key(F.col("text")).alias("key"), "text"
    )
    log2, bits = estimate(keyed, window)
    buckets = max(1, (1 << log2) // (COUNTERS_PER_WINDOW * _BUCKET))
    found = keyed.mapInArrow(
        _candidates(window, log2, spark.sparkContext.broadcast(bits), buckets), _LISTED
    )
    removed = (
        found.groupBy("bucket")
        .applyInArrow(_decide, "doc long, key long, places binary")
        .groupBy("doc", "key")
        .agg(F.collect_list("places").alias("places"))
    )
    packed = rows.select("doc_id", text_key(F.col("text")).alias("key"), "text").mapInArrow(
        _packed, "doc_id long, key long, packed binary"
    )
    joined = packed.join(removed.withColumnRenamed("doc", "doc_id"), ["doc_id", "key"], "left")
    return joined.select("doc_id", "packed", "places").mapInArrow(
        _cut(window), "doc_id long, kept_text string, n_words long, n_removed long"
    )

"""Near copies by SimHash: fingerprints within a few bits, joined by walking a binary trie with itself.

Fingerprints are the leaves of a binary trie. Two nodes of equal depth are visited
together; the bits in which their prefixes differ add up, and a pair is left as
soon as they exceed the budget. The trie's top is cut into subtries by the leading
bits; each pair of subtries within budget is one group of rows, walked in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from content_signals.llm.common import as_bytes, slices, stage, text_key

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints that one subtrie should hold, and the deepest cut.
SUBTRIE = 1 << 13
MAX_CUT = 20
_FRONTIER = 1 << 18
_SLICE_BYTES = 4 << 20
_COUNTED = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in more than half the shingles' hashes; shingles count as often as they stand.

    A-Z are lower-cased, words are runs of anything but space and ``\\t`` to ``\\r``.
    Fewer words than a shingle has: all of them are one. No words: zero.
    """
    words = text.lower().split()  # of bytes: A-Z only, and the white space named above
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    runs = zip(*(words[i:] for i in range(shingle)))
    hashes = np.fromiter((digest(b" ".join(r), SEED) for r in runs), np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _COUNTED):
        part = hashes[start : start + _COUNTED]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fingerprint): the text's key, and its fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            prints = [fingerprint(t, shingle) for t in as_bytes(batch.column("text"))]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(signed)],
                names=["doc_id", "key", "fingerprint"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key long, fingerprint long")


def trie_join(a: np.ndarray, b: np.ndarray | None, budget: int, depth: int = 0) -> Iterator[tuple]:
    """Index pairs of sorted fingerprints within ``budget`` bits; ``b`` None joins ``a`` with itself.

    ``depth`` leading bits are known to be shared within ``a`` and within ``b``.
    Frontiers are walked in slices, deepest first, which bounds their memory.
    """
    itself, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return
    first = 0 if itself else int(np.bitwise_count(_top(a[0], depth) ^ _top(b[0], depth)))
    start = np.array([[0], [len(a)], [0], [len(b)], [first]], np.int64)
    stack = [(depth, start)] if first <= budget else []
    while stack:
        level, front = stack.pop()
        if front.shape[1] > _FRONTIER:
            half = front.shape[1] // 2
            stack += [(level, front[:, :half]), (level, front[:, half:])]
            continue
        alone = (front[1] - front[0] == 1) & (front[3] - front[2] == 1)
        if alone.any() or level == 64:
            done = front if level == 64 else front[:, alone]
            i, j = done[0], done[2]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if itself:
                near &= i != j
            if near.any():
                yield i[near], j[near]
            front = front[:, :0] if level == 64 else front[:, ~alone]
        if front.shape[1]:
            stack.append((level + 1, _children(a, b, front, level, budget, itself)))


def _top(value: np.uint64, depth: int) -> np.uint64:
    return value >> np.uint64(64 - depth) if depth else np.uint64(0)


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
    """Where a node's children part: the first value of its range with the next bit set."""
    bit = np.uint64(1 << (63 - level))
    target = (values[low] & ~(bit | (bit - np.uint64(1)))) | bit
    return np.clip(np.searchsorted(values, target), low, high)


def _children(a, b, front, level, budget, itself) -> np.ndarray:
    a0, a2, b0, b2, bits = front
    a1, b1 = _split(a, a0, a2, level), _split(b, b0, b2, level)
    same = itself & (a0 == b0) & (a2 == b2)  # a node with itself: its children meet once
    pairs = [
        np.stack([a0, a1, b0, b1, bits]),
        np.stack([a1, a2, b1, b2, bits]),
        np.stack([a0, a1, b1, b2, bits + 1]),
        np.stack([a1, a2, b0, b1, bits + 1])[:, ~same],
    ]
    out = np.concatenate(pairs, axis=1)
    return out[:, (out[0] < out[1]) & (out[2] < out[3]) & (out[4] <= budget)]


def _forest(n: int, pairs: Iterator[tuple]) -> np.ndarray:
    """Smallest member reachable from each of n nodes."""
    parent = np.arange(n)
    for i, j in pairs:
        while True:
            ri, rj = parent[i], parent[j]
            low, high = np.minimum(ri, rj), np.maximum(ri, rj)
            open_ = low != high
            if not open_.any():
                break
            np.minimum.at(parent, high[open_], low[open_])
            while (parent[parent] != parent).any():
                parent = parent[parent]
            i, j = i[open_], j[open_]
    return parent


def links(prints: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect whatever is within ``max_bits``, for distinct ``fingerprint`` rows.

    Each group of rows is a pair of subtries; it returns a forest over its linked
    fingerprints, at most one link for each, and not all pairs. The cut is as deep as
    the number of fingerprints asks for. A fingerprint goes to the pairs its subtrie
    can be in: for a cut of c bits 1 + c + c(c-1)/2 of them at two bits' budget.
    """
    cut = min(MAX_CUT, max(0, math.ceil(math.log2(max(1, n) / SUBTRIE))))
    masks = [sum(1 << i for i in c) for k in range(max_bits + 1) for c in combinations(range(cut), k)]
    own = F.shiftrightunsigned("fingerprint", 64 - cut) if cut else F.lit(0).cast("long")
    other = F.col("own").bitwiseXOR(F.col("mask"))
    sent = (
        prints.select("fingerprint", own.alias("own"))
        .select("fingerprint", "own", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
        .select(
            "fingerprint",
            F.least("own", other).alias("low"),
            F.greatest("own", other).alias("high"),
            (F.col("own") > other).alias("second"),
        )
    )

    def walk(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, second = [], []
        for batch in batches:
            values.append(np.asarray(batch.column("fingerprint"), np.int64).view(np.uint64))
            second.append(batch.column("second").to_numpy(zero_copy_only=False).astype(bool))
        values, second = np.concatenate(values), np.concatenate(second)
        a, b = np.sort(values[~second]), np.sort(values[second])
        if keys[0].as_py() == keys[1].as_py():
            both, pairs = a, trie_join(a, None, max_bits, cut)
        else:
            both = np.concatenate([a, b])
            pairs = ((i, j + len(a)) for i, j in trie_join(a, b, max_bits, cut))
        root = _forest(len(both), pairs)
        linked = np.flatnonzero(root != np.arange(len(both)))
        arrays = [pa.array(both[root[linked]].view(np.int64)), pa.array(both[linked].view(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return sent.groupBy("low", "high").applyInArrow(walk, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node it is connected with.

    Rounds of large stars and small stars: every node passes its neighbours to the
    smallest one, until nothing but stars is left. Each round is written to the shared
    folder, so that a lost executor costs one round at most. Smallest neighbours are
    taken by a summed ``min``, so a node with many links gathers no list.
    """
    ordered = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = stage(ordered.distinct(), "links")
    for _ in range(most_rounds):
        both = links.select("a", "b").union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("least").alias("a"), "b")
        large = stage(large.distinct(), "large-star")
        down = large.select(F.col("b").alias("node"), F.col("a").alias("low"))
        lowest = down.groupBy("node").agg(F.min("low").alias("least"))
        small = down.join(lowest, "node").select("node", "low", "least")
        moved = small.filter("low <> least").select(F.col("least").alias("a"), F.col("low").alias("b"))
        after = small.select(F.col("least").alias("a"), F.col("node").alias("b")).union(moved)
        after = stage(after.distinct(), "small-star")
        if after.exceptAll(links).isEmpty() and links.exceptAll(after).isEmpty():
            roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
            return roots.union(links.select("a", "a").distinct().toDF("node", "root"))
        links = after
    raise RuntimeError(f"links do not settle within {most_rounds} rounds")


def near_copies(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fingerprint, root, component_id) for every row of ``docs``, fingerprints as signed longs.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links, its own
    included. Fingerprints link at ``max_bits`` or fewer differing bits, equal ones of
    course; documents without words have fingerprint zero, linked like any other. A row
    without ``doc_id`` joins its component but cannot name it; a component of such rows
    alone has none. ``root`` is the component's smallest fingerprint. Repeated rows are linked
    copies. Other columns are not read.

    Copies are folded into one row per fingerprint before anything is joined, and only
    linked fingerprints take part in the rounds of ``components``.
    """
    printed = stage(fingerprints(docs, shingle), "fingerprints")
    distinct = stage(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-prints")
    roots = components(links(distinct.select("fingerprint"), distinct.count(), max_bits))
    roots = stage(roots, "print-roots")
    named = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    named = stage(named, "rooted-prints")
    owner = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.join(owner, "root").select("fingerprint", "root", "component_id")
    return printed.join(by_print, "fingerprint").select("doc_id", "key", "fingerprint", "root", "component_id")


def drop_near_copies(
    docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, per_id: bool = True
) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each group of near copies.

    It is the one with the smallest ``doc_id``; one that stands in several equal rows stays
    once. Rows may share an id but not their text, and so may name several groups. With
    ``per_id`` an id is one document, so of its rows only those with the smallest text key
    stay, and rows without ``doc_id`` stay all. Without it every group keeps a document: of
    rows that share an id those with its smallest text key, and of a group without ids one row.
    """
    copies = near_copies(docs, max_bits, shingle)
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("doc_id"), text_key(F.col("row.text")).alias("key")
    )
    if per_id:
        named = copies.filter(F.col("doc_id") == F.col("component_id"))
        keepers = named.groupBy("doc_id").agg(F.min("key").alias("key"))
        kept = rows.join(keepers, ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
        return kept.union(rows.filter("doc_id is null").select(*kept.columns)).select("row.*")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    keepers = copies.groupBy("root").agg(F.min(first).alias("k")).select("k.doc_id", "k.key").distinct()
    keepers = keepers.toDF("_id", "_key")
    same = rows["doc_id"].eqNullSafe(keepers["_id"]) & (rows["key"] == keepers["_key"])
    return rows.join(keepers, same, "left_semi").dropDuplicates(["doc_id", "key"]).select("row.*")

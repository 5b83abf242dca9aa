"""Byte strings that stand more than once, removed: prefix doubling over sorted pairs of ranks.

Positions are chosen by content: in every run of ``width`` places the one whose next bytes
hash lowest. Equal strings thus hold the same positions, and only these are ranked. A
round ranks the text of twice as many phrases (from one position to the next): Spark
sorts the pairs of a position's rank and the rank as many phrases on by range, equal
pairs get the rank of the first of them, and unique ones leave. Rounds end when what
is left is past the threshold. A string of the threshold's length belongs to the
position chosen first in it. Where all strings of a position stand again together, one more
sort settles them. The others are taken in runs of ``RUN`` strings: none of a run is repeated if what
all of them share is not, all are if the run as a whole is, and a last sort ranks the
strings that are left one by one.

Sorted ranges are cut anywhere, also inside a group of equal pairs, so no task has to
take a hot group; what crosses a cut is settled from the ends of the ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from content_signals.llm.common import as_bytes, slices
from content_signals.llm.hashing import _CODES, _MIXERS, _RUN_BASES, _powers, mix
from content_signals.plans.skew import fits_broadcast, lookup_join
from content_signals.plans.staging import discard, settings, stage

THRESHOLD = 400
#: Phrases that the first ranks cover; any string of the threshold's length holds as many.
FIRST_DEPTH = 2
#: Phrases beyond which nothing is ranked: so many lie in one string only where a text repeats itself
#: at short intervals, and what is left there is settled by the bytes.
LAST_DEPTH = 16
#: Strings with neighbouring starts that are settled together before single ones are looked at.
RUN = 16
_GRAM = 8
#: Bytes worked on at once; longer documents are cut into pieces that overlap.
_PIECE = 1 << 18
_SLICE_BYTES = 4 << 20
_PART_SHIFT = 40
#: Of a position in one number: its strings, how far it lies behind the first one's start, and the phrases that
#: must be repeated for any string it is part of.
_FIELD = 1 << 20
_FAR = 1 << 40
#: For tables that are staged. No later query reads a shuffle of theirs, so its files go when the table is written, not
#: when the driver next collects garbage; and measured parts of a join that are small are hashed instead of sorted.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}
#: Columns of hashes, which hardly repeat within a file.
_HASHES = ("a", "h1", "h2")


def geometry(threshold: int) -> tuple[int, int]:
    """(bytes hashed at a place, places of which one is chosen).

    Two phrases, each of at most ``width`` bytes, lie in what all strings of a position
    share: ``threshold - 2 * width - gram + 2`` bytes, which must be more than ``width``.
    """
    gram = max(1, min(_GRAM, threshold // 8))
    return gram, max(1, (threshold - gram + 1) // 3)


class Hashes:
    """Two hashes of any stretch of some bytes, read off running sums."""

    def __init__(self, data: np.ndarray):
        self.tables = []
        codes = _CODES[data]
        for base in _RUN_BASES:
            powers, inverse = _powers(base, len(data))
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(codes * powers[: len(data)], out=sums[1:])
            self.tables.append((sums, inverse))

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        sums, inverse = self.tables[which]
        return mix((sums[end] - sums[start]) * inverse[start], _MIXERS[which])


def chosen_places(data: np.ndarray, gram: int, width: int) -> np.ndarray:
    """For every place x the one of the ``width`` places from x on that hashes lowest, the last of equals."""
    n = len(data) - gram + 1
    if n < width:
        return np.empty(0, np.int64)
    padded = np.append(data, np.zeros(8, np.uint8))
    grams = np.ndarray((n,), "<u8", padded, strides=(1,)).copy()
    if gram < 8:
        grams &= np.uint64((1 << (8 * gram)) - 1)
    grams = mix(grams, _MIXERS[0])
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(n) - np.arange(n, dtype=np.uint64))
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: n - width + 1], least[width - size : width - size + n - width + 1])
    return n - (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _pieces(texts: list[bytes], threshold: int, piece: int) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
    """Lists of (document, offset of the bytes, first place and end of those owned, bytes).

    A piece goes on behind its own places as far as anything about them reaches, and
    starts a byte early, to tell whether a position was chosen before.
    """
    gram, width = geometry(threshold)
    held, size = [], 0
    for doc, text in enumerate(texts):
        if len(text) < threshold:
            continue
        for start in range(0, len(text), piece):
            early = min(start, 1)
            end = min(start + piece, len(text))
            part = text[start - early : end + threshold + 3 * width + gram]
            if held and size + len(part) > piece:
                yield held
                held, size = [], 0
            held.append((doc, start - early, early, end - start + early, part))
            size += len(part)
    if held:
        yield held


def positions(texts: list[bytes], threshold: int, piece: int = _PIECE) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, number in it, name, first string, shape, hash, second hash) of chosen positions.

    The strings of a position start at ``first`` and the next few places. ``name`` stands for
    the next two phrases, the hashes for all its strings together. A position without strings, near
    a document's end, is there for those before it.
    """
    gram, width = geometry(threshold)
    before: dict[int, int] = {}
    for held in _pieces(texts, threshold, piece):
        data = np.frombuffer(b"".join(p[-1] for p in held), np.uint8)
        lengths = np.array([len(p[-1]) for p in held])
        offset = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(held), dtype=np.int32), lengths)
        place = chosen_places(data, gram, width)
        at = np.flatnonzero(owner[: len(place)] == owner[width + gram - 2 :])
        if not len(at):
            continue
        run = np.flatnonzero(np.diff(place[at], prepend=-1))
        chosen, first = place[at[run]], at[run]
        last = at[np.append(run[1:], len(at)) - 1]
        part = owner[first]
        end = offset[part] + lengths[part]
        of = Hashes(data)
        # names of two phrases; the last two positions of a document have none
        ahead = np.arange(len(run)) + FIRST_DEPTH
        named = ahead < len(run)
        named[named] = part[ahead[named]] == part[named]
        inside = first - offset[part]
        limits = np.array([p[2:4] for p in held])[part]
        owned = np.flatnonzero(named & (inside >= limits[:, 0]) & (inside < limits[:, 1]))
        everyone = (inside >= limits[:, 0]) & (inside < limits[:, 1])
        number = np.cumsum(everyone) - 1
        doc = np.array([p[0] for p in held])[part]
        base = np.array([p[1] for p in held])
        starts = np.searchsorted(part, np.arange(len(held)))
        counts = np.bincount(part[everyone], minlength=len(held))
        carried = np.zeros(len(held), np.int64)
        for i, (d, *_) in enumerate(held):
            carried[i] = before.get(d, 0)
            before[d] = carried[i] + counts[i]
        ranked_before = np.cumsum(np.append(0, everyone))[starts]
        number = number - ranked_before[part] + carried[part]
        f, p = first[owned], part[owned]
        some = f + threshold <= end[owned]
        # the last string that starts here, or in front of here, and how far its phrases go
        latest = np.minimum(f, end[owned] - threshold)
        reach = np.searchsorted(first, latest + threshold - width - gram + 1, "right") - 1
        depth = np.clip(reach - owned, 0, 2 * LAST_DEPTH - 1)
        strings = np.where(some, np.minimum(last[owned], end[owned] - threshold) - f + 1, 0)
        upto = f + np.where(some, strings - 1 + threshold, 0)
        yield (
            doc[owned],
            number[owned],
            of.of(chosen[owned], chosen[ahead[owned]], 0),
            f - offset[p] + base[p],
            (strings * _FIELD + chosen[owned] - f) * _FIELD + depth,
            of.of(f, upto, 0),
            of.of(f, upto, 1).astype(np.uint32),
        )


def _named(threshold: int):
    names = ["row", "i", "a", "first", "shape", "h1", "h2"]
    kinds = [np.int64, np.int32, np.int64, np.int64, np.int64, np.int64, np.int32]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed", _SLICE_BYTES // 4):
            rows = np.asarray(batch.column("row"), np.int64)
            for doc, *columns in positions([unpack(p) for p in batch.column("packed").to_pylist()], threshold):
                unsigned = {np.dtype(np.uint64): np.int64, np.dtype(np.uint32): np.int32}
                signed = [c.view(unsigned[c.dtype]) if c.dtype in unsigned else c for c in (rows[doc], *columns)]
                arrays = [pa.array(c.astype(k)) for c, k in zip(signed, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in slices(batches, "text", _SLICE_BYTES):
        texts = pa.array(map(pack, as_bytes(batch.column("text"))), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), texts], ["doc_id", "row", "packed"])


def _staged(df: DataFrame, name: str) -> DataFrame:
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in _HASHES if c in df.columns}
    with settings(df.sparkSession, _SETTINGS):
        return stage(df, name, plain)


_MORE = [
    T.StructField("part", T.IntegerType()),
    T.StructField("head", T.LongType()),
    T.StructField("leads", T.BooleanType()),
    T.StructField("alone", T.BooleanType()),
]


def _heads(keep_alone: bool):
    """Per row of a sorted range: the range, where its group of equal pairs begins in it, whether it
    is the first of the group, and whether the only one. Rows alone between others may be left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, fresh, head, seen = None, True, 0, 0
        for batch in chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if batch is None and held is None:
                return
            whole = held if batch is None else batch if held is None else pa.concat_batches([held, batch])
            n = whole.num_rows
            a, b = (np.asarray(whole.column(c), np.int64) for c in ("a", "b"))
            new = np.ones(n, bool)
            new[0] = fresh
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            heads = np.maximum.accumulate(np.where(new, seen + np.arange(n), head))
            alone = new & np.append(new[1:], True)
            settled = n if batch is None else n - 1  # the last row's group may go on
            kept = np.arange(settled)
            if not keep_alone:
                ends = (kept + seen == 0) | ((batch is None) & (kept == n - 1))
                kept = np.flatnonzero(~alone[:settled] | ends)
            arrays = [*whole.take(pa.array(kept)).columns]
            arrays += [pa.array(np.full(len(kept), part, np.int32)), pa.array(heads[kept].astype(np.int64))]
            arrays += [pa.array(new[kept]), pa.array(alone[kept])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*whole.schema.names, *(f.name for f in _MORE)])
            held, fresh, head, seen = whole.slice(n - 1), bool(new[-1]), int(heads[-1]), seen + n - 1

    return run


def rank_pairs(pairs: DataFrame, keep_alone: bool = False) -> DataFrame:
    """The rows of ``(a, b, row, i, ...)`` with ``rank``, ``repeated`` and ``leads``, which replace ``a`` and ``b``.

    Pairs are sorted by range; equal ones get one rank, that of the first of them, which
    ``leads``. ``repeated`` tells that a pair stands more than once; unless ``keep_alone``,
    rows whose pair does not may be missing. What is collected is a row per range.
    """
    order = ["a", "b", "row", "i"]
    ranged = pairs.repartitionByRange(*order).sortWithinPartitions(*order)
    heads = ranged.mapInArrow(_heads(keep_alone), T.StructType([*pairs.schema.fields, *_MORE]))
    heads = _staged(heads, "ranked-pairs")
    # rows of one head hold one pair, so those of the first and of the last are a range's least and largest
    ends_of = [f(c, "head") for f in (F.min_by, F.max_by) for c in ("a", "b")]
    ranges = heads.groupBy("part").agg(*ends_of, F.max("head"))
    ends: list[list] = []
    before, rank = None, 0
    for part, *low_high, last_head in sorted(ranges.collect()):
        low, high = low_high[:2], low_high[2:]
        joined = before == low
        first_rank = rank if joined else part << _PART_SHIFT
        if joined:
            ends[-1][4] = True
        ends.append([part, first_rank, last_head, joined, False])
        before, rank = high, (part << _PART_SHIFT | last_head) if last_head else first_rank
    schema = "part int, first_rank long, last_head long, joined boolean, goes_on boolean"
    known = pairs.sparkSession.createDataFrame([tuple(e) for e in ends], schema)
    head = F.col("head")
    earlier = (head == 0) & F.col("joined")
    later = (head == F.col("last_head")) & F.col("goes_on")
    own = F.shiftleft(F.col("part").cast("long"), _PART_SHIFT).bitwiseOR(head)
    ranked = heads.join(F.broadcast(known), "part").select(
        *[c for c in pairs.columns if c not in ("a", "b")],
        F.when(head == 0, F.col("first_rank")).otherwise(own).alias("rank"),
        (~F.col("alone") | earlier | later).alias("repeated"),
        (F.col("leads") & ~earlier).alias("leads"),
    )
    return ranked


def _depth() -> Column:
    return F.col("shape") % _FIELD


def _strings_of() -> Column:
    return F.floor(F.col("shape") / (_FIELD * _FIELD))


def doubled(named: DataFrame) -> DataFrame:
    """Positions with strings whose text is repeated as far as all these reach, to a power of two of phrases.

    Only groups in which some position reaches further are ranked on, with all their members
    and with the positions that many phrases ahead, which reach as far. A position without
    strings takes part, since others are compared across it. ``named`` is staged, and deleted once it is ranked.
    """
    ranked = rank_pairs(named.withColumn("b", F.lit(0).cast("long"))).filter("repeated")
    discard(named)
    live = ranked.withColumn("origin", F.col("rank"))
    depth, settled = FIRST_DEPTH, []
    columns = ["row", "i", "first", "shape", "h1", "h2", "origin"]
    while True:
        past = (_depth() >= depth) & (_depth() < 2 * depth) & (_strings_of() > 0)
        settled.append(live.filter(past).select(*columns))
        active = live.filter(_depth() >= 2 * depth).select("rank").distinct()
        if active.isEmpty():
            break
        going_on = live
        if fits_broadcast(active):
            going_on = live.join(F.broadcast(active), "rank", "left_semi")
        ahead = live.select("row", (F.col("i") - depth).alias("i"), F.col("rank").alias("b"))
        pairs = going_on.select(*columns, F.col("rank").alias("a")).join(ahead, ["row", "i"])
        live = rank_pairs(pairs).filter("repeated")
        depth *= 2
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """The first row's number and the texts of some rows together, about ``_SLICE_BYTES`` of text or one row."""
    unpack = zstandard.ZstdDecompressor().decompress
    held, size, low = [], 0, 0
    for i, packed in enumerate(batch.column("packed").to_pylist()):
        length = zstandard.frame_content_size(packed)
        if held and size + length > _SLICE_BYTES:
            yield low, held
            held, size, low = [], 0, i
        held.append(unpack(packed))
        size += length
    if held:
        yield low, held


def _runs(start: np.ndarray, n: np.ndarray, place: np.ndarray, run: int) -> tuple[np.ndarray, ...]:
    """(item, first string, last string, core) of the runs of each item's strings.

    Those whose start lies less than ``run`` places before ``place`` are together, the next ``run``
    ones and so on, so that equal strings are in runs that share the same, from ``core`` on.
    """
    last = start + n - 1
    low, high = (place - last) // run, (place - start) // run
    counts = high - low + 1
    item = np.repeat(np.arange(len(start)), counts)
    k = np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts - low, counts)
    core = place[item] - k * run
    return item, np.maximum(start[item], core - run + 1), np.minimum(last[item], core), core


def _hashed(threshold: int, run: int):
    """The listed strings in runs of up to ``run``, by two hashes of a run's bytes and two of what its strings share.

    A run is named by its first string. What strings share begins at their core, has the
    length that a whole run's do, and is the string itself for single strings.
    """
    names = ["a", "b", "row", "i", "n", "group", "settled", "h1", "h2"]
    length = threshold - run + 1

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed", _SLICE_BYTES // 4):
            rows = np.asarray(batch.column("row"), np.int64)
            for low, texts in _unpacked(batch):
                listed = batch.column("listed").slice(low, len(texts))
                items = listed.flatten()
                # one behind the other; no string of a text reaches into the next
                offset = np.cumsum([0, *map(len, texts)])
                of_text = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(listed)))
                columns = [np.asarray(items.field(c), np.int64) for c in ("start", "n", "place", "group")]
                columns.append(items.field("settled").to_numpy(zero_copy_only=False).astype(bool))
                order = np.lexsort((columns[0], of_text))
                start, n, place, group, settled = (c[order] for c in columns)
                row, base = rows[low + of_text[order]], offset[of_text[order]]
                begin = start + base
                furthest = np.maximum.accumulate(begin + n - 1 + threshold)
                data = np.frombuffer(b"".join(texts), np.uint8)
                at = 0
                while at < len(start):
                    zero = int(begin[at])
                    upto = max(at + 1, int(np.searchsorted(furthest, zero + _PIECE, "right")))
                    own = slice(at, upto)
                    of = Hashes(data[zero : int(furthest[upto - 1])])
                    item, first, last, core = _runs(begin[own] - zero, n[own], (place + base)[own] - zero, run)
                    a, b = (of.of(core, core + length, j).view(np.int64) for j in (0, 1))
                    h1, h2 = (of.of(first, last + threshold, j).view(np.int64) for j in (0, 1))
                    i = first + zero - base[own][item]
                    arrays = [a, b, row[own][item], i, last - first + 1, group[own][item], settled[own][item], h1, h2]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names=names)
                    at = upto

    return hashed


def _compared(texts: DataFrame, listed: DataFrame, threshold: int, run: int, name: str) -> DataFrame:
    """The strings ``(row, start, n, place, group, settled)`` in runs, staged, with hashes of their bytes."""
    one = F.struct(*[F.col(c).cast("long").alias(c) for c in ("start", "n", "place", "group")], "settled")
    by_row = listed.groupBy("row").agg(F.collect_list(one).alias("listed"))
    schema = "a long, b long, row long, i long, n long, group long, settled boolean, h1 long, h2 long"
    return _staged(texts.join(by_row, "row").mapInArrow(_hashed(threshold, run), schema), name)


def _unsettled(ranked: DataFrame, group: str) -> DataFrame:
    """What stands once and is not settled, and of its group one of each other kind, which it may overlap with."""
    open_ = ranked.filter("not repeated and not settled").select(group).distinct()
    leading = ranked.filter("leads").withColumn("settled", F.col("settled") | F.col("repeated"))
    return lookup_join(leading, open_, [group], "left_semi", spread=F.col("row"))


def _stretches(cuts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the maximal stretches that lists of spans cover."""
    items = cuts.flatten()
    text = np.repeat(np.arange(len(cuts)), np.asarray(pc.fill_null(pc.list_value_length(cuts), 0)))
    start, end = (np.asarray(items.field(c), np.int64) for c in ("start", "end"))
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    # ends of earlier texts are less than any of a later one
    furthest = np.maximum.accumulate(text * _FAR + end)
    new = np.ones(len(text), bool)
    new[1:] = text[1:] * _FAR + start[1:] > furthest[:-1]
    new[1:] |= text[1:] != text[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text)) - 1 if len(first) else first
    return text[first], start[first], furthest[last] - text[last] * _FAR


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches, "packed", _SLICE_BYTES // 4):
        of_text, start, end = _stretches(batch.column("cuts"))
        spans = np.bincount(of_text, minlength=batch.num_rows)
        bounds = np.append(0, np.cumsum(spans)).tolist()
        start, end = start.tolist(), end.tolist()
        kept, sizes = [], []
        for i, packed in enumerate(batch.column("packed").to_pylist()):
            text = unpack(packed)
            sizes.append(len(text))
            own = slice(bounds[i], bounds[i + 1])
            if bounds[i] < bounds[i + 1]:
                text = b"".join(text[a:b] for a, b in zip([0, *end[own]], [*start[own], len(text)]))
            kept.append(text)
        removed = [n - len(k) for n, k in zip(sizes, kept)]
        arrays = [batch.column("doc_id"), pa.array(kept, pa.binary())]
        arrays += [pa.array(c, pa.int64()) for c in (sizes, removed, spans)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])


def drop_repeated_bytes(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) for every row of ``docs``.

    ``docs`` holds ``doc_id`` and ``text``; other columns are not read. A text is its UTF-8
    bytes. Each byte goes that is covered by a string of ``threshold`` bytes which also starts
    anywhere else, in another row or in the same; strings are judged on the given texts
    and never cross rows. ``kept`` is what is left, ``n_spans`` counts the stretches removed.
    A null or empty text has no bytes. Every row is a document of its own: of rows
    that share an id, or are equal, all are judged against all. A null ``doc_id`` stays null.

    Texts are written once, packed and numbered, to the shared folder, as are the
    positions of each round and the runs of strings; these are deleted once what they lead to is ranked,
    and so are the shuffle files of each round.
    """
    numbered = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    packed = _staged(numbered.mapInArrow(_packed, "doc_id long, row long, packed binary"), "packed-texts")
    texts = packed.select("row", "packed")
    named = _staged(
        texts.mapInArrow(_named(threshold), "row long, i int, a long, first long, shape long, h1 long, h2 int"),
        "named-positions",
    )
    together = doubled(named).select(
        F.col("h1").alias("a"), F.col("h2").cast("long").alias("b"), "row", "i", "first", "shape", "origin"
    )
    whole = rank_pairs(together, keep_alone=True).withColumn("settled", F.lit(False))
    discard(together)
    place = F.col("first") + F.floor(F.col("shape") / _FIELD) % _FIELD
    runs = _unsettled(whole, "origin").select(
        "row", F.col("first").alias("start"), _strings_of().alias("n"), place.alias("place"), F.lit(0).alias("group"), "settled"
    )
    runs = _compared(texts, runs, threshold, min(RUN, threshold), "runs-of-strings")
    shared = rank_pairs(runs).filter("repeated")
    discard(runs)
    runs = rank_pairs(
        shared.select(F.col("h1").alias("a"), F.col("h2").alias("b"), "row", "i", "n", "settled", F.col("rank").alias("group")),
        keep_alone=True,
    )
    discard(shared)
    strings = _unsettled(runs, "group").select("row", F.col("i").alias("start"), "n", F.col("i").alias("place"), "group", "settled")
    strings = _compared(texts, strings, threshold, 1, "strings")
    singles = rank_pairs(strings)
    discard(strings)
    cuts = whole.filter("repeated").select(
        "row", F.col("first").alias("start"), (F.col("first") + _strings_of() - 1 + threshold).alias("end")
    )
    for ranked in (runs, singles):
        again = ranked.filter("repeated and not settled")
        cuts = cuts.unionByName(
            again.select("row", F.col("i").alias("start"), (F.col("i") + F.col("n") - 1 + threshold).alias("end"))
        )
    cuts = cuts.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    return packed.join(cuts, "row", "left").select("doc_id", "packed", "cuts").mapInArrow(
        _cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"
    )

"""Text quality from trusted positives and unlabelled text alone.

A small network over a text's statistics minimises the non-negative risk of
positive-unlabelled learning: the risk of unlabelled text as negatives, less what
the positives among it account for, which a class prior says; where a batch drives
that difference below zero, its gradient is turned round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from content_signals.llm.common import as_bytes, bounded_sample, slices, text_key
from content_signals.llm.hashing import Words, chunks
from content_signals.plans.staging import discard, stage_counted

THRESHOLD = 0.7
_SLICE_BYTES = 4 << 20
_HIDDEN = 16
_LEAST = 8
_STEPS, _BATCH, _RATE, _DECAY = 1500, 1024, 3e-3, 1e-4
#: The fit on all rows: rows of a group, trusted rows it needs, rounds after which the groups' networks are averaged,
#: and tasks whose averages the driver gets. A round's steps are enough for all rows of a group.
_GROUP, _GROUP_TRUSTED = 8_192, 512
_ROUNDS, _MAX_TASKS = 5, 512
#: Sums are of whole multiples of one over this, so that they don't depend on the order of groups and tasks.
_UNIT = 1 << 20
#: Steps of a logit, from -30 to 30, in which scores are counted for the prior.
_LOGIT_BINS = 60 * 64

#: Bytes that count as one class; every other byte is of class 0 (control) or the last (not ASCII).
_GROUPS = [
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\v\f", ".", ",", "!",
    "?", "'\"`", "()[]{}", "<>", "|", "#", "$", "%", "&", "*", "@", "+-=_~^", "/\\", ":;",
]
_CLASS = np.zeros(256, np.int64)
for _i, _group in enumerate(_GROUPS):
    _CLASS[[ord(c) for c in _group]] = _i + 1
_CLASS[128:] = len(_GROUPS) + 1
_CLASSES = len(_GROUPS) + 2
_WORD_STATS = 12
WIDTH = _CLASSES * _CLASSES + _WORD_STATS


def _features(texts: list[bytes]) -> np.ndarray:
    w = Words(texts)
    n, counts = len(texts), np.diff(w.first)
    lengths = np.array([len(t) for t in texts])
    # byte pairs within a text: the blank that Words puts between texts closes each text
    kinds = _CLASS[w.data]
    doc_of_byte = np.repeat(np.arange(n), lengths + 1)[: len(kinds)]
    pairs = doc_of_byte[:-1] * _CLASSES**2 + kinds[:-1] * _CLASSES + kinds[1:]
    inside = doc_of_byte[:-1] == doc_of_byte[1:]
    hist = np.bincount(pairs[inside], minlength=n * _CLASSES**2).reshape(n, -1)
    shares = np.sqrt(hist / np.maximum(hist.sum(1, keepdims=True), 1))

    doc = np.repeat(np.arange(n), counts)
    per = np.maximum(counts, 1)
    length = (w.ends - w.starts).astype(float)
    total = lambda x: np.bincount(doc, x, minlength=n)
    mean = total(length) / per
    spread = np.sqrt(np.maximum(total(length**2) / per - mean**2, 0))
    again = []
    for lag in (1, 2, 3):
        same = np.zeros(len(doc))
        if len(doc) > lag:
            same[lag:] = (w.hashes[lag:] == w.hashes[:-lag]) & (doc[lag:] == doc[:-lag])
        again.append(total(same) / per)
    order = np.lexsort((w.hashes, doc))
    new = np.ones(len(doc), bool)
    new[1:] = (w.hashes[order][1:] != w.hashes[order][:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new)
    often = np.zeros(n)
    if len(starts):
        np.maximum.at(often, doc[starts], np.diff(np.append(starts, len(doc))))
    first = _CLASS[w.data[w.starts]] if len(w.starts) else np.empty(0, np.int64)
    last = _CLASS[w.data[w.ends - 1]] if len(w.starts) else np.empty(0, np.int64)
    symbols = (kinds >= 9) & (kinds <= len(_GROUPS))
    stats = [
        np.log1p(counts) / 8,
        np.log1p(mean),
        np.log1p(spread),
        *again,
        total(new.astype(float)) / per,
        often / per,
        total((first == 2).astype(float)) / per,
        total((last > 3).astype(float)) / per,
        np.bincount(doc_of_byte, symbols, minlength=n) / np.maximum(lengths, 1),
        np.bincount(doc_of_byte, kinds == 2, minlength=n) / np.maximum(lengths, 1),
    ]
    return np.hstack([shares, np.stack(stats, 1)]).astype(np.float32)


def features(texts: list[bytes]) -> np.ndarray:
    """A row of ``WIDTH`` statistics of each whole text."""
    parts = [_features(texts[a:b]) for a, b in chunks(texts)]
    return np.concatenate(parts) if parts else np.empty((0, WIDTH), np.float32)


@dataclass
class Model:
    """Network over standardised statistics; ``prior`` is the estimated share of positives."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    prior: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) * self.scale, -6, 6)

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(self.standard(x) @ w1 + b1, 0) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30).astype(float)))


def _network(mean: np.ndarray, deviation: np.ndarray, prior: float, rng: np.random.Generator) -> Model:
    """A network that has learned nothing, over statistics of so much mean and deviation."""
    scale = np.where(deviation > 1e-6, 1 / np.maximum(deviation, 1e-6), 0).astype(np.float32)
    layers = [
        rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), _HIDDEN)).astype(np.float32),
        np.zeros(_HIDDEN, np.float32),
        rng.normal(0, 1 / np.sqrt(_HIDDEN), _HIDDEN).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    return Model(mean, scale, layers, prior)


def _descend(model: Model, p: np.ndarray, u: np.ndarray, pick: Callable[[int], np.ndarray], steps: range, of: int) -> None:
    """Take some steps, out of so many, down prior E_P[l(+)] + max(0, E_U[l(-)] - prior E_P[l(-)]), l the logistic loss.

    ``p`` and ``u`` are standardised; ``pick`` gives the rows of the next batch, out of so many. The model's layers are changed.
    """
    layers, prior = model.layers, model.prior
    m1, m2 = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for moves, step in enumerate(steps, 1):
        xp = p[pick(len(p))]
        xu = u[pick(len(u))]
        x = np.concatenate([xp, xu])
        hidden = x @ layers[0] + layers[1]
        active = np.maximum(hidden, 0)
        z = active @ layers[2] + layers[3][0]
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        zp, zu = z[:_BATCH], z[_BATCH:]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g = np.empty_like(z)
        if negative >= 0:
            g[:_BATCH] = prior * (s[:_BATCH] - 1) - prior * s[:_BATCH]
            g[_BATCH:] = s[_BATCH:]
        else:  # go back up until the risk of negatives is none of the positives' own
            g[:_BATCH] = prior * s[:_BATCH]
            g[_BATCH:] = -s[_BATCH:]
        g /= _BATCH
        gh = np.outer(g, layers[2]) * (hidden > 0)
        grads = [x.T @ gh + _DECAY * layers[0], gh.sum(0), active.T @ g + _DECAY * layers[2], np.array([g.sum()])]
        rate = _RATE * (1 - step / (of + 1))
        for w, grad, a, b in zip(layers, grads, m1, m2):
            a += 0.1 * (grad - a)
            b += 0.01 * (grad * grad - b)
            w -= (rate * (a / (1 - 0.9**moves)) / (np.sqrt(b / (1 - 0.99**moves)) + 1e-8)).astype(np.float32)


def _train(p: np.ndarray, u: np.ndarray, prior: float, seed: int) -> Model:
    """A network fitted to rows that lie in memory."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([p, u])
    model = _network(every.mean(0), every.std(0), prior, rng)
    p, u = model.standard(p), model.standard(u)
    _descend(model, p, u, lambda n: rng.integers(0, n, _BATCH), range(1, _STEPS + 1), _STEPS)
    return model


def estimate_prior(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among ``u`` from scores of unseen positives and unlabelled rows.

    At every threshold the share of ``u`` above it is at least the prior times the share
    of ``p`` above it; the smallest upper confidence bound of that quotient is taken.
    """
    cuts = np.quantile(p, np.linspace(0, 0.95, 96))
    return _prior(*(np.array([(x >= c).mean() for c in cuts]) for x in (p, u)), len(p), len(u), delta)


def _prior(above_p: np.ndarray, above_u: np.ndarray, n_p: float, n_u: float, delta: float = 0.1) -> float:
    """The same from the shares above some cuts and the numbers of rows."""
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(n_p) + 1 / np.sqrt(n_u))
    best = int(np.argmin((above_u + slack) / np.maximum(above_p, 1e-9)))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def fit(positives: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> Model:
    """Estimate the prior on a quarter of the rows by a first network, then fit on all."""
    if min(len(positives), len(unlabelled)) < _LEAST:
        raise ValueError("too few trusted positives or unlabelled texts to learn from")
    p_cut, u_cut = len(positives) // 4, len(unlabelled) // 4
    first = _train(positives[p_cut:], unlabelled[u_cut:], 0.5, seed)
    prior = estimate_prior(first.logits(positives[:p_cut]), first.logits(unlabelled[:u_cut]))
    return _train(positives, unlabelled, prior, seed + 1)


def undecided() -> Model:
    """A model that knows nothing and scores every text 1: without evidence none is rejected."""
    zero = np.zeros(WIDTH, np.float32)
    flat = np.zeros((WIDTH, _HIDDEN), np.float32)
    layers = [flat, np.zeros(_HIDDEN, np.float32), np.zeros(_HIDDEN, np.float32), np.full(1, 30, np.float32)]
    return Model(zero, zero, layers, 1.0)


def _extracted(rows: DataFrame, kind: type = np.float32) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            x = features(as_bytes(batch.column("text"))).astype(kind, copy=False)
            packed = pa.array([r.tobytes() for r in x], pa.binary())
            arrays = [batch.column("doc_id"), batch.column("key"), packed]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "x"])

    keyed = rows.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    return keyed.mapInArrow(run, "doc_id long, key long, x binary")


def _dealt(rows: DataFrame, trusted: DataFrame) -> tuple[DataFrame, int, dict[str, int]]:
    """(part, trusted, learned, later, x): the statistics of every id in groups dealt by a hash, staged; groups; counts.

    Of rows that share an id the one with the smallest text key counts. A trusted id stands
    in several groups where there are few of them, and is ``learned`` as an unlabelled one in the first. A
    quarter of the ids is for ``later``, when the prior is estimated.
    """
    n_rows, n_trusted = rows.count(), trusted.count()
    groups = max(1, -(-n_rows // _GROUP))
    times = min(groups, max(1, -(-_GROUP_TRUSTED * groups // max(1, n_trusted))))
    one = _extracted(rows, np.float16).groupBy("doc_id").agg(F.min(F.struct("key", "x")).alias("least"))
    known = one.join(trusted.withColumn("trusted", F.lit(True)), "doc_id", "left").select(
        "doc_id", F.coalesce("trusted", F.lit(False)).alias("trusted"), F.col("least.x").alias("x")
    )
    again = F.explode(F.sequence(F.lit(0), F.when(F.col("trusted"), times - 1).otherwise(0))).alias("again")
    dealt = known.select("*", again).select(
        F.pmod(F.xxhash64(F.lit(3), "doc_id", "again"), F.lit(groups)).alias("part"),
        "doc_id",
        "again",
        "trusted",
        (F.col("again") == 0).alias("learned"),
        (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4)) == 0).alias("later"),
        "x",
    )
    ordered = dealt.repartition("part").sortWithinPartitions("part", "doc_id", "again").drop("doc_id", "again")
    learned, later = F.col("learned"), F.col("later")
    staged, counts = stage_counted(
        ordered,
        "statistics",
        unlabelled=F.sum(learned.cast("long")),
        positives=F.sum((learned & F.col("trusted")).cast("long")),
        later_unlabelled=F.sum((learned & later).cast("long")),
        later_positives=F.sum((learned & later & F.col("trusted")).cast("long")),
    )
    return staged.coalesce(min(groups, _MAX_TASKS)), groups, counts


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, trusted, learned, later, statistics) of each group; one that is much too large comes in pieces."""
    held: list[pa.RecordBatch] = []
    size = 0

    def whole() -> tuple:
        rows = pa.Table.from_batches(held)
        x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float16).reshape(-1, WIDTH)
        flags = [np.asarray(rows.column(c)) for c in ("trusted", "learned", "later")]
        return rows.column("part")[0].as_py(), *flags, x

    for batch in batches:
        part = np.asarray(batch.column("part"))
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if held and (held[0].column("part")[0].as_py() != part[a] or size + b - a > 4 * _GROUP):
                yield whole()
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size += b - a
    if held:
        yield whole()


def _summed(rows: DataFrame, fn: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum of what ``fn`` makes of each group, none as null; the driver gets a row per task, ``_MAX_TASKS`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for group in _groups(batches):
            found = fn(*group)
            if found is not None:
                whole = np.rint(found * _UNIT).astype(np.int64)
                total = whole if total is None else total + whole
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["out"])

    got = [np.frombuffer(r[0], np.int64) for r in rows.mapInArrow(run, "out binary").collect()]
    return sum(got) / _UNIT


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the statistics of trusted and of unlabelled rows, one after the other."""

    def sums(_, trusted: np.ndarray, learned: np.ndarray, later: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros((3, WIDTH))
        for low in range(0, len(x), 1024):
            part = x[low : low + 1024].astype(float)
            weight = learned[low : low + 1024] * (1.0 + trusted[low : low + 1024])
            out += np.stack([np.full(WIDTH, weight.sum()), weight @ part, weight @ part**2])
        return out.ravel()

    n, total, squares = _summed(rows, sums).reshape(3, WIDTH)
    mean = total / n
    return mean.astype(np.float32), np.sqrt(np.maximum(squares / n - mean**2, 0)).astype(np.float32)


def _continued(rows: DataFrame, model: Model, steps: range, of: int, all_rows: bool, seed: int) -> Model:
    """The average of the networks that every group makes of ``model`` by going on with its own rows, by their number."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    sizes = [w.size for w in model.layers]

    def run(part: int, trusted: np.ndarray, learned: np.ndarray, later: np.ndarray, x: np.ndarray) -> np.ndarray | None:
        given = shared.value
        used = np.ones(len(x), bool) if all_rows else ~later
        p, u = np.flatnonzero(used & trusted), np.flatnonzero(used & learned)
        if not len(p) or not len(u):
            return None
        z = np.empty(x.shape, np.float32)
        for low in range(0, len(x), 1024):
            z[low : low + 1024] = given.standard(x[low : low + 1024].astype(np.float32))
        rng = np.random.default_rng((seed, steps.start, part))
        turns = [np.resize(rng.permutation(rows), len(steps) * _BATCH).reshape(-1, _BATCH) for rows in (p, u)]
        order = (turn[i] for i in range(len(steps)) for turn in turns)
        own = Model(given.mean, given.scale, [w.copy() for w in given.layers], given.prior)
        _descend(own, z, z, lambda _: next(order), steps, of)
        return len(u) * np.concatenate([[1.0], *(w.ravel() for w in own.layers)])

    total = np.atleast_1d(_summed(rows, run))
    shared.destroy()
    if not total[0]:
        return model
    parts = np.split((total[1:] / total[0]).astype(np.float32), np.cumsum(sizes)[:-1])
    return Model(model.mean, model.scale, [w.reshape(o.shape) for w, o in zip(parts, model.layers)], model.prior)


def _counted_prior(rows: DataFrame, model: Model, all_rows: bool) -> float:
    """``estimate_prior`` from the scores of all rows that are for later, counted in steps of a logit."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def count(_, trusted: np.ndarray, learned: np.ndarray, later: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros((2, _LOGIT_BINS))
        for low in range(0, len(x), 1024):
            own = slice(low, low + 1024)
            logit = np.clip(shared.value.logits(x[own].astype(np.float32)), -30, 29.999)
            used = learned[own] & (later[own] | all_rows)
            for row, some in enumerate((used & trusted[own], used)):
                out[row] += np.bincount(((logit[some] + 30) * 64).astype(int), minlength=_LOGIT_BINS)
        return out.ravel()

    p, u = _summed(rows, count).reshape(2, _LOGIT_BINS)
    shared.destroy()
    above_p, above_u = (np.cumsum(c[::-1])[::-1] for c in (p, u))
    # the cuts that hold 5 % to all of the positives
    cuts = np.searchsorted(np.cumsum(p), np.linspace(0, 0.95, 96) * p.sum(), "right")
    return _prior(above_p[cuts] / p.sum(), above_u[cuts] / u.sum(), p.sum(), u.sum())


def _fit_all(rows: DataFrame, trusted: DataFrame, if_too_few: Model | None, seed: int = 7) -> Model:
    """``fit`` on all rows: rounds in which every group of rows continues the network, then their average."""
    dealt, groups, counts = _dealt(rows, trusted)
    if min(counts["positives"], counts["unlabelled"]) < _LEAST:
        if if_too_few is not None:
            return if_too_few
        raise ValueError("too few trusted positives or unlabelled texts to learn from")
    per_round = max(_STEPS // _ROUNDS // groups, _GROUP // _BATCH * 6)
    mean, deviation = _moments(dealt)
    model = _network(mean, deviation, 0.5, np.random.default_rng(seed))

    def rounds(model: Model, all_rows: bool, seed: int) -> Model:
        for n in range(_ROUNDS):
            steps = range(n * per_round + 1, (n + 1) * per_round + 1)
            model = _continued(dealt, model, steps, _ROUNDS * per_round, all_rows, seed)
        return model

    # too few for later: the prior is estimated on what the first network has learned from
    enough = min(counts[c] - counts[f"later_{c}"] for c in ("positives", "unlabelled")) > 0
    enough = enough and min(counts["later_positives"], counts["later_unlabelled"]) > 0
    first = rounds(model, not enough, seed)
    prior = _counted_prior(dealt, first, not enough)
    model = _network(mean, deviation, prior, np.random.default_rng(seed + 1))
    model = rounds(model, True, seed + 1)
    discard(dealt)
    return model


def _fetch(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Statistics of the chosen documents in the order of their ids, one row of each.

    Of rows that share an id the one with the smallest text key counts; it is picked by a
    sum that Spark begins before it shuffles. What comes to the driver is a row per id.
    """
    chosen = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    one = _extracted(chosen).groupBy("doc_id").agg(F.min(F.struct("key", "x")).alias("least"))
    got = sorted((r[0], r[1]) for r in one.select("doc_id", "least.x").collect())
    order = np.random.default_rng(3).permutation(len(got))
    rows = [np.frombuffer(got[i][1], np.float32) for i in order]
    return np.stack(rows) if rows else np.empty((0, WIDTH), np.float32)


def fit_on(
    docs: DataFrame,
    positives: DataFrame,
    max_positives: int | None = None,
    max_unlabelled: int | None = None,
    if_too_few: Model | None = None,
) -> Model:
    """Fit on all documents, as trusted ones those named in ``positives``, and all of them as unlabelled ones.

    ``docs`` holds ``doc_id`` and ``text``, ``positives`` the ``doc_id`` of trusted good
    texts. No negative label is read. Rows without id are not read; null texts are empty ones. With
    too few documents to learn from ``if_too_few`` is returned, if given, and else an error raised.

    Statistics of every id are written to the shared folder in half precision, in groups dealt by a hash. In each round
    every group goes on from the same network with its own rows, all of them, and the networks are averaged.
    A caller may set both bounds instead: then the fit is on so many distinct ids, chosen by a hash.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")
    trusted = positives.select(F.col("doc_id").cast("long")).filter("doc_id is not null").distinct()
    if (max_positives is None) != (max_unlabelled is None):
        raise ValueError("set both bounds or none")
    if max_positives is None:
        return _fit_all(rows, trusted, if_too_few)
    p = _fetch(rows, bounded_sample(trusted, "doc_id", max_positives, 1))
    u = _fetch(rows, bounded_sample(rows.select("doc_id").distinct(), "doc_id", max_unlabelled, 2))
    if if_too_few is not None and min(len(p), len(u)) < _LEAST:
        return if_too_few
    return fit(p, u)


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs``: the likelihood that its whole text is good.

    Reads ``doc_id`` and ``text`` only. A null or empty text has a score like any other;
    a null ``doc_id`` stays null; repeated rows give repeated results. Rows are
    independent: nothing is shuffled. The model is a few kilobytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            x = features(as_bytes(batch.column("text")))
            scores = pa.array(model.score(x), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``.

    Only ``text`` is looked at: a null text scores as an empty one, repeated rows are judged
    alike, other columns and their names don't matter. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            scores = model.score(features(as_bytes(batch.column("text"))))
            yield batch.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(run, docs.schema)

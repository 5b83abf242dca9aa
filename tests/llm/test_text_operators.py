"""Each operator against a plain version of its rules, on rows made to be awkward."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from content_signals.llm import (
    bpe,
    decontaminate,
    line_dedup,
    pii,
    quality,
    simhash_dedup,
    substring_dedup,
    token_counts,
    top_k,
    toxicity,
)
from content_signals.plans.staging import new_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, key string, row int, lang string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
LINE = "This line of boilerplate stands in a lot of the documents."


def _awkward() -> list[tuple]:
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=70))
    texts = [None, "", " ", "\n", "x", "ÄÖ é b", LONG, "a " * 400, passage, f"{passage} end", f"pre {passage}"]
    texts += [f"{LINE}\n{' '.join(rng.choices(words, k=20))}\n  {LINE.upper()}\t" for _ in range(7)]
    texts += [passage] * 3 + [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(20)]
    rows = [(i, t, "clash", 1, "en") for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (8, "another text of eight", "k", 2, None), (None, passage, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_line_dedup(docs):
    strip = " \t\n\x0b\x0c\r"
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = collections.defaultdict(set)
    given = [(r[0], r[1] or "") for r in _awkward()]
    for i, text in given:
        for line in text.split("\n"):
            key = line.strip(strip).translate(fold)
            if i is not None and len(key) >= 40:
                holders[key].add(i)
    want = collections.Counter()
    for i, text in given:
        lines = text.split("\n")
        keys = [line.strip(strip).translate(fold) for line in lines]
        kept = [a for a, k in zip(lines, keys) if i is None or len(holders[k]) < 5 or max(holders[k]) == i]
        want[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    got = line_dedup.drop_common_lines(docs).select("row.doc_id", "kept_text", "n_lines", "n_dropped")
    assert _rows(got, *got.columns) == want
    assert sum(k[3] for k in want) > 0


def test_line_dedup_plan_has_no_python(docs):
    plan = line_dedup.drop_common_lines(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def _passages(rows, window):
    words = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    least = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            h = tuple(w[s : s + window])
            if i is not None:
                least[h] = min(least.get(h, i), i)
    for i, w in words:
        bad = set()
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s : s + window])] < i:
                bad.update(range(s, s + window))
        yield i, b" ".join(x for j, x in enumerate(w) if j not in bad).decode(), len(w), len(bad)


@pytest.mark.parametrize("window", [50, 7])
def test_substring_dedup(docs, window):
    got = substring_dedup.drop_repeated_passages(docs, window)
    want = collections.Counter(_passages(_awkward(), window))
    assert _rows(got, "doc_id", "kept_text", "n_words", "n_removed") == want
    assert sum(k[3] for k in want) > 0


def test_gap_codes_round_trip():
    rng = np.random.default_rng(1)
    for top in (1, 100, 1 << 14, 1 << 28):
        places = np.sort(rng.integers(0, top, 500)).astype(np.uint32)
        assert (substring_dedup._unpack_gaps(substring_dedup._pack_gaps(places)) == places).all()
    assert len(substring_dedup._unpack_gaps(b"")) == 0


def _simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _component_of(prints):
    """Smallest id reachable over links of two bits, by comparing everything."""
    root = {p: {p} for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2 and root[a] is not root[b]:
                root[a] |= root[b]
                for p in root[b]:
                    root[p] = root[a]
    return {p: min((i for q in root[p] for i in prints[q] if i is not None), default=None) for p in prints}


def test_simhash_near_copies(docs):
    prints = collections.defaultdict(list)
    for i, text, *_ in _awkward():
        prints[_simhash(text)].append(i)
    named = _component_of(prints)
    want = collections.Counter((i, p, named[p]) for p, ids in prints.items() for i in ids)
    got = collections.Counter(
        (r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash_dedup.near_copies(docs).collect()
    )
    assert got == want


@pytest.mark.parametrize("subtrie", [1 << 13, 40])
def test_trie_links_equal_all_pairs(spark, monkeypatch, subtrie):
    monkeypatch.setattr(simhash_dedup, "SUBTRIE", subtrie)
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(300)}
    for v in list(values)[:150]:  # chains of near values, in every bit
        for _ in range(rng.randint(1, 4)):
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    named = _component_of({v: [v] for v in values})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash_dedup.links(spark.createDataFrame(signed, "fingerprint long"), len(values))
    roots = {r.node: r.root for r in simhash_dedup.components(links).collect()}
    groups = collections.defaultdict(set)
    for (v,) in signed:
        groups[roots.get(v, v)].add(v % (1 << 64))
    want = collections.defaultdict(set)
    for v, name in named.items():
        want[name].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_one_document_of_each_group_stays(docs):
    kept = simhash_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    named = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    groups = {r.component_id for r in simhash_dedup.near_copies(docs).collect() if r.component_id is not None}
    assert sorted(named) == sorted(groups)


ALPHABET = [
    "a", "th", "e ", " ", "  ", "\n", "'s", "'", "l", "ll", "é", "日本", "1", "23", "!", "<|endoftext|>", "<|endo",
    "\t", "😀", "the", "'re", "\r\n", "x" * 50, " " * 30, " ", "ǅ", "²",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_bpe_equals_the_library_for_any_chunks(library):
    vocabulary, cache = bpe.load(JSON)
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 50))) for _ in range(400)]
    texts += ["ab" * 4000, "日" * 4000, " " * 5000 + "x", "!" * 5000 + "'s", "é" * 3000 + " ", "0" * 7000]
    texts.append("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)))
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        for chunk in (1, 7, 1000, 1 << 16) if len(text) < 3000 else (333, 1 << 16):
            packed = b"".join(bpe.encode(text, vocabulary, cache, chunk))
            assert list(array("I", packed)) == want, (text[:80], chunk)


def test_bpe_holds_a_bounded_tail():
    vocabulary, cache = bpe.load(JSON)
    encoder = bpe.Encoder(vocabulary, cache)
    for _ in range(50):
        encoder.feed("abcdefg" * 500)
        assert len(encoder.tail) <= encoder.limit + 8


def test_decoding_equals_the_library(library):
    vocabulary, _ = bpe.load(JSON)
    rng = random.Random(8)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(40)]  # also bytes that are no UTF-8
        decoder = bpe.Decoder(vocabulary)
        text = "".join(decoder.feed(array("I", [i])) for i in ids) + decoder.finish()
        assert text == library.decode(ids, skip_special_tokens=False)


def test_lookahead_suffices():
    """What follows a text's last ``lookahead`` bytes changes no token before them."""
    pairs = [(b"a", b"b"), (b"b", b"a"), (b"ab", b"a"), (b"a", b"aba"), (b"c", b"aaba"), (b"b", b"b")]
    look = bpe.sufficient_lookahead(pairs)
    ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + i for i, (a, b) in enumerate(pairs)}

    class Small:
        merges = {(ids[a], ids[b]): (r + 1 << bpe._ID_BITS) + ids[a + b] for r, (a, b) in enumerate(pairs)}
        single = list(range(256))

    length = {i: len(raw) for raw, i in ids.items()}

    def ends(text):
        return set(np.cumsum([length[t] for t in bpe.merge(text, Small)]).tolist())

    rng = random.Random(5)
    for _ in range(2000):
        text = bytes(rng.choices(b"abc", k=rng.randint(look + 1, 60)))
        more = text + bytes(rng.choices(b"abc", k=rng.randint(1, 20)))
        safe = len(text) - look
        assert {e for e in ends(text) if e <= safe} == {e for e in ends(more) if e <= safe}


def test_encode_documents(docs, library):
    got = collections.Counter((r.doc_id, bytes(r.ids), r.decoded) for r in bpe.encode_documents(docs, JSON).collect())
    want = collections.Counter()
    for i, text, *_ in _awkward():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i, array("I", ids).tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert got == want


def test_token_counts_and_their_cache(spark, docs, library):
    cache = new_path(spark, "test-cache")
    want = collections.Counter(
        (i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for i, t, *_ in _awkward()
    )
    for _ in range(2):  # the second time all counts come from the cache
        got = token_counts.count_tokens(docs, JSON, cache)
        assert _rows(got, "doc_id", "n_bytes", "n_tokens") == want
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("digest").distinct().count() == len({r[1] or "" for r in _awkward()})


def test_token_counts_of_another_vocabulary(spark, docs):
    cache, piece = new_path(spark, "test-cache"), public_tokenizers.path("piece_bpe_32k.model")
    token_counts.count_tokens(docs, JSON, cache)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, piece, cache).collect()}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece)
    assert got[8] in {len(model.encode(t)) for i, t, *_ in _awkward() if i == 8}
    assert got[5] == len(model.encode("ÄÖ é b"))


CARD = "4111 1111 1111 1111"
IBAN = "DE89 3704 0044 0532 0130 00"


def _base(text):
    """The four patterns as they are written, without any of the operator's shortcuts."""
    digits = lambda t: re.sub(r"[^0-9]", "", t)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 14 <= len(digits(t)) <= 19 and pii.luhn(digits(t))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 10 <= len(digits(t)) <= 15),
    ]
    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern, good) in enumerate(rules)
        for m in re.finditer(pattern, text)
        if good(m[0])
    ]
    return [(kind, s, e) for s, _, e, kind in sorted(found)]


def test_pii_patterns_equal_their_plain_form():
    rng = random.Random(6)
    parts = [
        "a@b.co", "@", "a.b", ".", "é@x.de", "1.2.3.4", "256.1.1.1", "9.9", "+49 (30) 1234-567", "+1", "+", CARD, "-",
        " ", "  ", "5", "12345678901234567890", "x", "\n", "a@b..c", "@c.d@e.f", "%+-", "01.002.3.4", "日",
    ]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        spans = [(s["kind"], s["start"], s["end"]) for s in pii.find(text, pii.BASE_KINDS)]
        assert spans == _base(text), text


def test_pii_checks_and_context(docs):
    near = pii.find(f"my credit card {CARD}, IBAN {IBAN}")
    far = pii.find(CARD)
    assert [s["kind"] for s in near if s["kind"] in ("card", "iban")] == ["card", "iban"]
    assert near[0]["score"] > far[0]["score"]
    assert not pii.find(CARD[:-1] + "2") and not pii.find(IBAN[:-1] + "1", ("iban",))
    assert _rows(pii.find_pii(docs).select("doc_id"), "doc_id") == collections.Counter((r[0],) for r in _awkward())
    long = "1" * 200_000 + "a" * 200_000 + "+1" + " " * 100_000
    assert pii.find(long) == []


def test_top_k_equals_all_products(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 0.2, (6, 24))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.05, 24)).tolist(), 0) for i in range(400)]
    rows += [(400, None, 0), (450, [float("nan")] * 24, 0), (500, [None] * 24, 0), (550, [0.1] * 7, 0)]
    rows += [(600, rows[0][1], 0), (601, rows[1][1], 0), (None, rows[2][1], 0), (650, [], 0), (700, [1e9] * 24, 0)]
    rows.append(rows[50])
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(4)
    whole = [
        (i, [int(np.floor(256 * x)) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all()
    ]
    want = []
    for q, v in {(i, tuple(v)) for i, v in whole if i % 50 == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(v) == len(w)]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:5])]
    got = top_k.top_k(table, table.filter("vec_id % 50 = 0")).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_prunes(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 60, (8, 64))
    vectors = np.floor(centres[np.arange(4000) % 8] + rng.normal(0, 5, (4000, 64)))
    search = top_k._Search(list(range(20)), vectors[:20], 5)
    for start in range(0, 4000, 500):
        search.add(np.arange(start, start + 500), vectors[start : start + 500])
    assert search.survivors < 0.5 * search.seen


def _labelled(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels


SF = "/root/testdata/sf0.01"


def _held(i, by):
    return zlib.crc32(str(i).encode()) % by


def test_quality_on_held_out_rows(spark):
    docs, labels = _labelled(spark, SF)
    train = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = quality.fit_on(docs.filter(train), labels.filter(train & (F.col("quality") == 1)))
    assert 0.7 < model.prior < 0.98
    scored = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    held = [r for r in labels.collect() if _held(r.doc_id, 4) == 2]
    right = [(scored[r.doc_id] >= quality.THRESHOLD) == (r.quality == 1) for r in held]
    assert np.mean(right) >= 0.95
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scored.items() if s >= quality.THRESHOLD}


def test_quality_scores_awkward_rows(spark, docs, nothing):
    rng = np.random.default_rng(0)
    good = quality.features([f"Some plain words of text {i}.".encode() for i in range(40)])
    mixed = quality.features([f"{'JUNK!! ' * 20 if i % 2 else 'Some plain words of text.'}".encode() for i in range(40)])
    model = quality.fit(good[rng.permutation(40)], mixed[rng.permutation(40)])
    scores = [r.score for r in quality.score_quality(docs, model).collect()]
    assert len(scores) == len(_awkward()) and all(0 <= s <= 1 for s in scores)
    with pytest.raises(ValueError):
        quality.fit_on(nothing, nothing)


def test_toxicity_on_held_out_rows_and_sentences(spark):
    docs, labels = _labelled(spark, "/root/testdata/sf0.1")
    learned = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = toxicity.fit_on(docs, learned)
    held = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    scored = toxicity.score_toxicity(docs.join(held, "doc_id"), model).join(held, "doc_id").collect()
    toxic = [r for r in scored if r.toxic == 1]
    assert np.mean([r.score >= 0.5 for r in toxic]) >= 0.8
    assert np.mean([r.score >= 0.5 for r in scored if r.toxic == 0]) <= 0.02
    found, sentences = toxicity.score_text("Fine words. You idiot and moron! More.", model, toxicity._Words(model.weights))
    assert found > 0.5 and [(s["start"], s["end"]) for s in sentences] == [(11, 31)]


def test_toxicity_of_awkward_rows(docs, nothing):
    texts = ["bad scum here. fine", "so scum", "scum", "fine words", "more words", ""]
    model = toxicity.fit(texts * 4, [True, True, True, False, False, False] * 4)
    scored = toxicity.score_toxicity(docs, model).collect()
    assert len(scored) == len(_awkward()) and all(r.score == 0 for r in scored)
    assert toxicity.score_toxicity(nothing, model).count() == 0


def test_decontamination_finds_copies_and_rewordings(spark):
    docs, _ = _labelled(spark, SF)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    space = decontaminate.fit(docs)
    items = {r.item_id: r.text for r in bench.collect()}
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench, space).collect()}
    want = {
        (r.doc_id, i)
        for r in docs.collect()
        for i, t in items.items()
        if " ".join(re.findall(r"\w+", t.lower())) in " ".join(re.findall(r"\w+", r.text.lower()))
    }
    assert want and want <= got
    assert len(got - want) <= 0.05 * len(want)
    rng = random.Random(1)
    others = [w for r in docs.limit(30).collect() for w in r.text.split()]
    reworded = []
    for i, text in items.items():
        words = [rng.choice(others) if rng.random() < 0.12 else w for w in text.split()]
        reworded.append((i, " ".join(rng.choices(others, k=40) + words + rng.choices(others, k=40))))
    table = spark.createDataFrame(reworded, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(table, bench, space).collect()}
    assert np.mean([(i, i) in found for i in items]) >= 0.9
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs, bench, space).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in got}


def test_decontamination_of_awkward_rows(spark, docs, nothing):
    space = decontaminate.fit(docs)
    items = spark.createDataFrame([(1, None), (2, ""), (3, "... !"), (None, "x y")], "item_id long, text string")
    assert decontaminate.find_leaks(docs, items, space).count() == 0
    assert decontaminate.drop_leaks(docs, items, space).count() == docs.count()
    real = spark.createDataFrame([(4, _awkward()[8][1])], "item_id long, text string")
    found = {r.doc_id for r in decontaminate.find_leaks(docs, real, space).collect()}
    assert {8, 9, 10, None} <= found and 5 not in found


def test_common_words_is_the_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (rng.choices(range(6), k=rng.randint(1, 15)) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_words(b, decontaminate._masks(np.array(a)), len(a)) == table[-1][-1]


def test_empty_tables(nothing, spark):
    assert line_dedup.drop_common_lines(nothing).count() == 0
    assert substring_dedup.drop_repeated_passages(nothing).count() == 0
    assert simhash_dedup.near_copies(nothing).count() == 0
    assert simhash_dedup.drop_near_copies(nothing).count() == 0
    assert bpe.encode_documents(nothing, JSON).count() == 0
    assert pii.find_pii(nothing).count() == 0
    assert token_counts.count_tokens(nothing, JSON, new_path(spark, "test-cache")).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert top_k.top_k(none, none).count() == 0
    space = decontaminate.fit(nothing)
    items = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    assert decontaminate.find_leaks(nothing, items, space).count() == 0


def test_digests_of_queries(spark):
    from content_signals.llm.queries import QUERIES

    cut = {r.doc_id: r for r in QUERIES["op6_bpe_round_trip"](spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert cut[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()

"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

A merge changes tokens to its left only through a chain of later merges, each of
which takes in the token just before the last change. So text far enough to the
right cannot change a token any more; how far is worked out from the merge list.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from content_signals.llm.common import as_bytes, slices

#: The split before merging, as the vocabulary's kind defines it; a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Classes of character that a piece repeats.
_RUNS = (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")
CHUNK_CHARS = 1 << 16
#: Pieces remembered with their ids; forgotten all at once when full.
CACHE_PIECES = 1 << 19
_CACHED_CHARS = 64
_SLICE_BYTES = 4 << 20


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """Merges by rank, ids, special strings and the sufficient lookahead of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        model, letters = given["model"], byte_letters()
        unsupported = [given["normalizer"], *(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))]
        split = given["pre_tokenizer"] or {}
        if model["type"] != "BPE" or any(unsupported) or split.get("type") != "ByteLevel" or split["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        byte_of = {letter: b for b, letter in letters.items()}
        as_raw = lambda token: bytes(byte_of[c] for c in token)
        self.specials = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.ids = {as_raw(t): i for t, i in model["vocab"].items() if t not in self.specials}
        self.bytes_of = {i: raw for raw, i in self.ids.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.specials.items()}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        pairs = [(as_raw(a), as_raw(b)) for a, b in merges]
        known = {bytes([b]) for b in range(256)}
        for a, b in pairs:
            if a not in known or b not in known or a + b in known:
                raise ValueError("merges must combine earlier tokens into new ones")
            known.add(a + b)
        self.merges = {
            (self.ids[a], self.ids[b]): (rank + 1 << _ID_BITS) + self.ids[a + b]
            for rank, (a, b) in enumerate(pairs)
        }
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.lookahead = sufficient_lookahead(pairs)


def sufficient_lookahead(pairs: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which no further text can change a token that ends before them.

    Take two texts with a common start, and the last boundary up to which their tokens
    agree while merges are applied by rank. A merge (a, b) moves that boundary to the
    left by the length of a, once per rank, and b starts where the previous such merge's
    a began, so that a is a prefix of b. The longest chain of that kind, weighed by its
    left parts, bounds the whole way.
    """
    reach: dict[bytes, int] = {}
    longest = 0
    for a, b in pairs:
        before = max((reach.get(b[:n], 0) for n in range(1, len(b) + 1)), default=0)
        reach[a] = max(reach.get(a, 0), len(a) + before)
        longest = max(longest, len(a) + before)
    return longest


def merge(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of a piece: the lowest-ranked pair merges first, the leftmost among equals."""
    merges = vocabulary.merges
    ids: list[int] = [vocabulary.single[b] for b in piece]
    n = len(ids)
    if n < 64:
        look = merges.get
        ranks = [look(pair, _NONE) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < _NONE:
            i = ranks.index(best)
            new = ids[i] = best & _ID
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = look((ids[i - 1], new), _NONE)
            if i < len(ranks):
                ranks[i] = look((new, ids[i + 1]), _NONE)
        return ids
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(merges[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
    heapq.heapify(heap)
    while heap:
        ranked, i = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or merges.get((ids[i], ids[j])) != ranked:
            continue
        new = ids[i] = ranked & _ID
        ids[j] = -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            if found := merges.get((new, ids[after[j]])):
                heapq.heappush(heap, (found, i))
        if before[i] >= 0 and (found := merges.get((ids[before[i]], new))):
            heapq.heappush(heap, (found, before[i]))
    return [i for i in ids if i >= 0]


#: A merge is held as one number: its rank above the new token's id.
_ID_BITS = 24
_ID = (1 << _ID_BITS) - 1
_NONE = 1 << 62


class _Cache(dict):
    """Packed ids of short pieces."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        packed = array("I", merge(piece.encode(), self.vocabulary)).tobytes()
        if len(piece) <= _CACHED_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Text in chunks to packed ids; holds a bounded tail, however long the text or a piece.

    ``feed`` returns the ids that no further text can change, ``finish`` the rest.
    """

    def __init__(self, vocabulary: Vocabulary, cache: _Cache | None = None):
        self.vocabulary = vocabulary
        self.cache = _Cache(vocabulary) if cache is None else cache
        self.split = regex.compile(SPLIT)
        self.runs = [regex.compile(r) for r in _RUNS]
        self.longest_special = max(map(len, vocabulary.specials), default=1)
        self.special = None
        if vocabulary.specials:
            longest_first = sorted(vocabulary.specials, key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, longest_first)))
        #: The longest tail: a special string, and a piece with its lookahead.
        self.limit = 4 * (vocabulary.lookahead + 64)
        self.tail = ""
        self.run: regex.Pattern | None = None  # the tail's first characters go on with a cut piece

    def feed(self, chunk: str) -> bytes:
        return self._encode(self.tail + chunk, last=False)

    def finish(self) -> bytes:
        return self._encode(self.tail, last=True)

    def _encode(self, text: str, last: bool) -> bytes:
        out, start = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out.append(self._plain(text[start : m.start()], last=True))
            out.append(array("I", [self.vocabulary.specials[m[0]]]).tobytes())
            start = m.end()
        held = ""
        if not last:  # a special string may have begun in the last characters
            keep = max(start, len(text) - self.longest_special + 1)
            while keep < len(text) and not any(s.startswith(text[keep:]) for s in self.vocabulary.specials):
                keep += 1
            text, held = text[:keep], text[keep:]
        out.append(self._plain(text[start:], last, held != ""))
        self.tail += held
        return b"".join(out)

    def _plain(self, text: str, last: bool, more: bool = False) -> bytes:
        """Ids of text without special strings; what may still change becomes the tail."""
        self.tail, out, start = "", [], 0
        if self.run is not None:
            m = self.run.match(text)
            end = m.end() if m else 0
            if self.run is self.runs[3] and not last and end == len(text):
                pass  # white space to the end: what follows decides about its last character
            elif self.run is self.runs[3] and end < len(text) and end > 0:
                end -= 1  # the last white space before other text stands apart
            if end == len(text) and not last:
                return self._long(text, out)
            if end:
                out.append(self.cache[text[:end]])
            self.run, start = None, end
        pieces = self.split.findall(text, start)
        if last:
            out.extend(map(self.cache.__getitem__, pieces))
            return b"".join(out)
        # more text may change the last piece, and a quote with one letter before it
        settled = pieces[:-2]
        out.extend(map(self.cache.__getitem__, settled))
        rest = text[start + sum(map(len, settled)) :]
        if len(rest) > self.limit and len(pieces[-1]) > self.limit - 8:
            out.extend(map(self.cache.__getitem__, pieces[-2:-1]))
            piece = pieces[-1]
            self.run = next(r for r in self.runs if r.fullmatch(piece[1:]))
            return self._long(piece, out)
        self.tail = rest
        return b"".join(out)

    def _long(self, piece: str, out: list[bytes]) -> bytes:
        """Pass on a long unfinished piece's stable tokens, keep at least its lookahead."""
        vocabulary, step = self.vocabulary, self.limit
        while len(piece) > step:
            window = piece[:step].encode()
            safe = len(window) - vocabulary.lookahead - 8
            ids, length, whole, whole_length = merge(window, vocabulary), 0, 0, 0
            for i, token in enumerate(ids):
                length += len(vocabulary.bytes_of[token])
                if length > safe:
                    break
                if length == len(window) or window[length] & 0xC0 != 0x80:
                    whole, whole_length = i + 1, length  # the tail starts with a whole character
            if not whole:
                step *= 2
                continue
            out.append(array("I", ids[:whole]).tobytes())
            piece = piece[len(window[:whole_length].decode()) :]
            step = self.limit
        self.tail = piece
        return b"".join(out)


class Decoder:
    """Ids to text, byte by byte: state is the started character's bytes, at most three.

    Bytes that are no UTF-8 become one U+FFFD for each maximal part of a character.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = vocabulary.bytes_of
        self.started = b""

    def feed(self, ids: array) -> str:
        data = self.started + b"".join(map(self.bytes_of.__getitem__, ids))
        end = len(data) - _unfinished(data)
        self.started = data[end:]
        return data[:end].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.started = self.started, b""
        return rest.decode("utf-8", "replace")


def _unfinished(data: bytes) -> int:
    """Bytes at the end that begin a character and may yet become one."""
    for n in range(1, min(3, len(data)) + 1):
        byte = data[-n]
        if byte & 0xC0 == 0x80:
            continue
        needed = 2 if 0xC2 <= byte <= 0xDF else 3 if 0xE0 <= byte <= 0xEF else 4 if 0xF0 <= byte <= 0xF4 else 0
        if n >= needed:
            return 0
        try:  # a second byte out of range makes it no beginning of a character
            data[-n:].decode("utf-8")
        except UnicodeDecodeError as e:
            return n if e.reason == "unexpected end of data" else 0
    return 0


_LOADED: dict[str, tuple[Vocabulary, _Cache]] = {}


def load(path: str) -> tuple[Vocabulary, _Cache]:
    """The vocabulary and its piece cache, once per Python worker."""
    if path not in _LOADED:
        vocabulary = Vocabulary(path)
        _LOADED[path] = vocabulary, _Cache(vocabulary)
    return _LOADED[path]


def encode(text: str, vocabulary: Vocabulary, cache: _Cache, chunk: int = CHUNK_CHARS) -> Iterator[bytes]:
    """Packed ids (little-endian, 32 bits each) of a text, part by part."""
    encoder = Encoder(vocabulary, cache)
    for start in range(0, len(text), chunk):
        yield encoder.feed(text[start : start + chunk])
    yield encoder.finish()


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``docs``, which holds ``doc_id`` and ``text``.

    ``ids`` are the text's tokens as little-endian unsigned 32-bit integers, without
    begin, end or other added tokens; a special string inside a text is its own token.
    ``decoded`` is what they decode to. ``vocabulary`` is a byte-level BPE file in the
    format of the tokenizers library that every executor can read. A null or empty text
    has no tokens; a null ``doc_id`` stays null; repeated rows give repeated results;
    other columns are not read. Rows are independent: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, cache = load(vocabulary)
        for batch in slices(batches, "text", _SLICE_BYTES):
            packed, texts = [], []
            for text in as_bytes(batch.column("text")):
                decoder, ids, parts = Decoder(loaded), [], []
                for part in encode(text.decode(), loaded, cache):
                    ids.append(part)
                    parts.append(decoder.feed(array("I", part)))
                parts.append(decoder.finish())
                packed.append(b"".join(ids))
                texts.append("".join(parts))
            arrays = [batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")

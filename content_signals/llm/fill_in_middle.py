"""Documents cut into prefix, middle and suffix at line ends, and put in another order for training.

The ends of a document's lines are kept as a compressed set of code-point offsets: one
container per 2**16 offsets, an array, a bitmap or a list of runs, whichever is smallest,
and the number of ends before each. A cut after so many lines is a search among those
numbers and a select inside one container.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from content_signals.llm.common import as_bytes, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
SEED = 7
#: Of 100 documents so many are rearranged, and of those so many begin with the suffix.
RATE, SUFFIX_FIRST = 100, 50
_LOW = 1 << 16
_BITMAP_BYTES = _LOW // 8
_SLICE_BYTES = 4 << 20


class ArrayContainer:
    """The low halves as sorted 16-bit numbers."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """A bit for each low half, and the bits set before each word of 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_LOW, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1  # clears the lowest bit set
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    """Starts of runs of consecutive numbers, and the numbers before each run."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.starts, self.before = low[first].astype(np.uint16), first

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three for sorted low halves: 2 bytes a number, 8 KB, or 4 bytes a run."""
    runs = 4 * (1 + np.count_nonzero(np.diff(low) != 1))
    if runs < min(2 * len(low), _BITMAP_BYTES):
        return RunContainer(low)
    return ArrayContainer(low) if 2 * len(low) <= _BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """A set of offsets, given in ascending order, that tells the k-th smallest."""

    def __init__(self, offsets: np.ndarray):
        offsets = np.asarray(offsets, np.int64)
        high = offsets // _LOW
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.high = high[first]
        self.before = first
        self.size = len(offsets)
        parts = np.split(offsets % _LOW, first[1:]) if len(first) else []
        self.containers = [container(low) for low in parts]

    def __len__(self) -> int:
        return self.size

    def select(self, k: int) -> int:
        """The k-th smallest offset, from 0."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.high[at]) * _LOW + self.containers[at].select(k - int(self.before[at]))

    def cut(self, lines: int) -> int:
        """Where the first so many lines end."""
        return self.select(lines - 1) if lines else 0


def line_ends(text: bytes) -> BoundarySet:
    """Ends of the lines ``[^\\n]*\\n|[^\\n]+`` of UTF-8, as code points."""
    data = np.frombuffer(text, np.uint8)
    characters = np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)
    ends = characters[data == 10]
    if len(data) and data[-1] != 10:
        ends = np.append(ends, characters[-1])
    return BoundarySet(ends)


@dataclass(frozen=True)
class Arranged:
    """A document as it is trained on; without cuts, ``prefix`` and ``middle`` are None."""

    lines: int
    form: str
    prefix: int | None
    middle: int | None
    output: str


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers that depend on the id alone."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def arrange(
    doc_id: int | None, data: bytes, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> Arranged:
    ends, text = line_ends(data), data.decode()
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= rate:
        return Arranged(len(ends), "plain", None, None, text)
    first, second = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    a, b = ends.cut(first), ends.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return Arranged(len(ends), form, a, b - a, output)


def restore(output: str, form: str) -> str:
    """The text that was arranged; its parts hold no mark, so the first of each is the one set."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output.removeprefix(first).split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


_SCHEMA = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
)


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored) for every row of ``docs``.

    ``docs`` holds ``doc_id`` and ``text``; other columns are not read. ``n`` is the number
    of lines. A text without lines, one that holds a mark, and those of 100 that ``rate``
    leaves out are ``plain``: the output is the text, the lengths are null. Otherwise
    both cuts are drawn from the id: ``psm`` is prefix, suffix, middle and ``spm`` suffix,
    prefix, middle, each after its mark. Lengths are code points; ``restored`` is the text
    rebuilt from output and form alone. A null text is empty. A null ``doc_id`` stays null and
    draws as empty digits; repeated rows give repeated results. Rows are independent: nothing
    is shuffled, and a task holds a few megabytes of text, or one longer document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            ids = batch.column("doc_id").to_pylist()
            made = [arrange(i, t, seed, rate, suffix_first) for i, t in zip(ids, as_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([m.lines for m in made], pa.int64()),
                    pa.array([m.form for m in made], pa.string()),
                    pa.array([m.prefix for m in made], pa.int64()),
                    pa.array([m.middle for m in made], pa.int64()),
                    pa.array([m.output for m in made], pa.string()),
                    pa.array([restore(m.output, m.form) for m in made], pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SCHEMA)

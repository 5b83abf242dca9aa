"""Compressed boundary sets against sorted lists, and arranged texts against a plain version."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from content_signals.llm import fill_in_middle as fim

SCHEMA = "doc_id long, text string, form string, output int"


def _plain(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(part) for part in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < 50:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_arranged_texts(spark):
    rng = random.Random(2)
    texts = [None, "", "\n", "\n\n\n", "x", "x\n", "\nx", "é\n漢字\n🙂\r\n a\x0bb", "a <P> b\nc", "<M>", "<S", "<\n<P\n>S>"]
    texts += ["".join(rng.choices("aé🙂<>PSM\n", k=rng.randint(1, 200))) for _ in range(120)]
    texts += ["line\n" * 70_000, "word " * 50_000, "\n" * 200_000]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(7, texts[7], None, None)] * 2 + [(None, "a\nb\n", None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = collections.Counter(tuple(r) for r in fim.fill_in_middle(df).collect())
    assert got == collections.Counter(_plain(i, t) for i, t, *_ in rows)
    assert {k[2] for k in got} == {"plain", "psm", "spm"}


def test_no_rows(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rates():
    forms = collections.Counter(fim.arrange(i, b"a\nb\nc\n", rate=30, suffix_first=100).form for i in range(500))
    assert set(forms) == {"plain", "spm"} and 100 < forms["spm"] < 200


@pytest.mark.parametrize(
    "offsets, kinds",
    [
        ([], []),
        ([0], ["ArrayContainer"]),
        (list(range(70_000)), ["RunContainer"] * 2),
        (list(range(0, 60_000, 3)), ["BitmapContainer"]),
        (list(range(0, 60_000, 17)) + [1 << 17, (1 << 17) + 5], ["ArrayContainer"] * 2),
        ([*range(5000), *range(65_536, 131_072, 2), 1 << 20], ["RunContainer", "BitmapContainer", "ArrayContainer"]),
    ],
)
def test_boundary_sets(offsets, kinds):
    ends = fim.BoundarySet(np.array(offsets, np.int64))
    assert [type(c).__name__ for c in ends.containers] == kinds
    assert len(ends) == len(offsets)
    places = range(len(offsets)) if len(offsets) < 200 else random.Random(1).sample(range(len(offsets)), 200)
    assert [ends.select(k) for k in places] == [offsets[k] for k in places]
    assert ends.cut(0) == 0
    for outside in (-1, len(offsets)):
        with pytest.raises(IndexError):
            ends.select(outside)

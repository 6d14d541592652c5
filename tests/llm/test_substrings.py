"""Repeated substrings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from estrato.llm import substring_dedup
from estrato.llm.substring_dedup import (
    _numbered, anchor_places, batches_of, dedup, repeated_windows,
)
from estrato.llm.suffix_sort import Hashes, suffix_sort


def _brute(texts: list[bytes], size: int):
    counts = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if counts[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _texts(rng: random.Random) -> list[str | None]:
    def noise(n, letters="abcdefgh é"):
        return "".join(rng.choices(letters, k=n))

    passages = [noise(n) for n in (199, 200, 201, 260, 700)]
    out: list[str | None] = ["", None, "x", noise(150), "ab" * 400, "ab" * 300 + noise(30), noise(40, "a") + "z" * 650, noise(60) + "z" * 300]
    for _ in range(60):
        parts = [noise(rng.randint(0, 120)) for _ in range(3)]
        out.append(parts[0] + rng.choice(passages) + parts[1] + rng.choice(passages)[: rng.randint(100, 400)] + parts[2])
    for t in list(out[-20:]):
        i = rng.randrange(len(t))
        out.append(t[:i] + "#" + t[i + 1 :])  # near copies
    return out + [out[-1], out[-1], noise(5000)]


def test_suffixes_are_sorted():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    start = rng.integers(0, 3000, 600)
    end = np.minimum(start + rng.integers(1, 300, 600), 4000)
    group = np.sort(rng.integers(0, 40, 600))
    order, common = suffix_sort(Hashes(data), start, end, group)
    text = [data[a:b].tobytes() for a, b in zip(start, end, strict=True)]
    for g in range(40):
        at = np.flatnonzero(group == g)
        assert [text[i] for i in order[at]] == sorted(text[i] for i in at)
        for p, q in zip(at, at[1:], strict=False):
            x, y = text[order[p]], text[order[q]]
            want = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert common[q] == want


def test_collisions_are_found(monkeypatch):
    monkeypatch.setattr(Hashes, "of", lambda self, start, end: np.zeros(len(np.atleast_1d(start)), np.uint64))
    data = np.frombuffer(b"banana bandana cabana", np.uint8)
    start = np.arange(len(data))
    order, common = suffix_sort(Hashes(data), start, np.full(len(data), len(data)), np.zeros(len(data), int))
    assert [data[i:].tobytes() for i in order] == sorted(data[i:].tobytes() for i in start)
    assert common[0] == -1 and max(common) == len("ana ")


@pytest.mark.parametrize("paired", [64, 1])
def test_windows_of_many_contexts(monkeypatch, paired):
    monkeypatch.setattr(substring_dedup, "PAIRED", paired)
    rng = random.Random(5)
    contexts, group, offset, windows = [], [], [], []
    for g in range(30):
        anchor = bytes(rng.choices(b"ab", k=5))
        for _ in range(rng.randint(1, 9)):
            left = bytes(rng.choices(b"ab", k=rng.randint(0, 6)))
            c = left + anchor + bytes(rng.choices(b"ab", k=rng.randint(12 - len(left), 14)))
            if len(c) < 12 or (g, c) in set(zip(group, contexts, strict=True)):
                continue
            contexts.append(c)
            group.append(g)
            offset.append(len(left))
            windows.append(min(len(left) + 1, len(c) - 11))
    got = repeated_windows(_numbered(group), contexts, np.array(offset), np.array(windows), 12)
    keys = [(g, o - i, c[i : i + 12]) for g, c, o, w in zip(group, contexts, offset, windows, strict=True) for i in range(w)]
    counts = Counter(keys)
    assert got.tolist() == [counts[k] > 1 for k in keys]


def test_long_texts_are_cut_without_losing_windows(monkeypatch):
    monkeypatch.setattr(substring_dedup, "PIECE", 1 << 10)
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"abc", k=n)) for n in (0, 199, 200, 1023, 1024, 1025, 5000, 300, 250)]
    seen = []
    anchors: dict = {}
    for buffer, rows in batches_of(texts, 200):
        assert len(buffer) <= 1 << 10
        data = np.frombuffer(buffer, np.uint8)
        places, _ = anchor_places(data, Hashes(data))
        for k, start, at, n in rows:
            assert buffer[at : at + n] == texts[k][start : start + n]
            for i in range(n - 199):
                seen.append((k, start + i))
                window = texts[k][start + i : start + i + 200]
                offset = int(places[at + i]) - at - i
                assert 0 <= offset <= 160 and anchors.setdefault(window, offset) == offset
    assert sorted(seen) == [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 199)]


@pytest.mark.parametrize("hot", [4096, 3])
def test_every_repeated_byte_goes(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    texts = _texts(random.Random(11))
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sha string").repartition(3)
    want = _brute([(t or "").encode() for t in texts], 200)
    got = sorted(tuple(-1 if x is None else x for x in r) for r in dedup(docs).collect())
    assert got == sorted((-1 if i is None else i, *w) for (i, _), w in zip(rows, want, strict=True))
    assert dedup(docs.limit(0)).count() == 0

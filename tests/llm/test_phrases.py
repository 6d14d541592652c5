"""Phrases against their SQL, the sort against counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from oracle import duck_rows, duck_types, spark_rows, spark_types

from estrato.llm.multikey import frequent_beginnings
from estrato.llm.phrases import collocations
from estrato.llm.queries import OP11_SQL, op11_phrases

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def _plain(docs, least, longest, top, share=80):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        rows = []
        for p, a in cand.items():
            if 100 * longer[p] >= share * a:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((" ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    where = SF.replace("sf0.001", sf)
    df = op11_phrases(spark, where)
    rows = spark_rows(df)
    assert rows[1] and rows == duck_rows(where, OP11_SQL)
    assert spark_types(df) == duck_types(where, OP11_SQL)


def _texts(n):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)] + ["É", "İx", "a\x00b", "ß", "-"]
    signs = [" "] * 8 + [", ", ". ", "\n", "\t", "  ", " ! ", "\r\n", "\x0b", "\x85", "\x1c"]
    out = []
    for i in range(n):
        picked = rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randrange(60))
        text = "".join(w + rng.choice(signs) for w in picked)
        out.append((rng.choice(["en", "en", None, "und", "1:e"]), text.upper() if i % 5 == 0 else text))
    return out


@pytest.mark.parametrize(("least", "longest", "top", "bucket_rows"), [(30, 4, 2000, 10**6), (3, 4, 50, 100), (2, 3, 2000, 1000), (5, 2, 7, 50)])
def test_matches_counting(spark, least, longest, top, bucket_rows):
    docs = [*_texts(250), ("en", "x y z " * 5000), ("en", None), ("fr", ""), (None, "x y z"), *[("es", "uno dos tres cuatro")] * 40]
    rows = [(i, t, lang, "n") for i, (lang, t) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string").repartition(6)
    got = collocations(df, least=least, longest=longest, top=top, bucket_rows=bucket_rows)
    assert sorted(map(tuple, got.collect())) == _plain(docs, least, longest, top)


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations(empty).collect() == []
    blank = spark.createDataFrame([(None, " ", None), (2, None, "en")], empty.schema)
    assert collocations(blank).collect() == []


@pytest.mark.parametrize("n", [0, 1, 50, 4000])
def test_sort_counts_beginnings(n):
    rng = np.random.default_rng(n)
    keys = np.minimum(rng.zipf(1.3, (n, 4)), 500).astype(np.uint64)
    keys[rng.random((n, 4)) < 0.1] = 0
    for d in range(1, 4):
        keys[keys[:, d - 1] == 0, d] = 0
    weights = rng.integers(1, 4, n)
    for d, (at, total) in enumerate(frequent_beginnings(keys, weights, [20, 20, 20, 20]), 1):
        want = Counter()
        for row, w in zip(keys.tolist(), weights.tolist(), strict=True):
            if row[d - 1]:
                want[tuple(row[:d])] += w
        got = {tuple(keys[i, :d].tolist()): int(x) for i, x in zip(at, total, strict=True)}
        assert len(at) == len(got) and got == {k: v for k, v in want.items() if v >= 20}

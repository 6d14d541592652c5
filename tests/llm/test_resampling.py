"""Importance resampling against its SQL and a plain version of the contract."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from conftest import SF
from oracle import duck_rows, duck_types, spark_rows, spark_types

from estrato.llm.queries import OP12_SQL, op12_resampling
from estrato.llm.resampling import bucket_counts, byte_table, feature_hashes, resample, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def _features(text, order=2):
    w = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)]
    return len(w), [crc32(f.encode()) for f in runs]


def _plain(docs, target, percent=25, least=20, seed=7, buckets=10_000):
    s = Counter(h % buckets for _, t in docs for h in _features(t)[1])
    t = Counter(h % buckets for x in target for h in _features(x)[1])
    ss, tt = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)]
    rows = []
    for d, text in docs:
        n, f = _features(text)
        weight = sum(gain[h % buckets] for h in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    order = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(order[: percent * len(order) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    where = SF.replace("sf0.001", sf)
    df = op12_resampling(spark, where)
    assert spark_rows(df) == duck_rows(where, OP12_SQL)
    assert spark_types(df) == duck_types(where, OP12_SQL)


def test_hashes_of_runs():
    for text in ("", " ", "A b\x00C9/dé Ünï\x7f\u0085x [y] `z` {w} 12", "one", None):
        words = words_of(text, byte_table())
        assert [w.decode() for w in words] == WORD.findall((text or "").translate(LOWER))
        got = [h for hashes in feature_hashes(words, 3) for h in hashes]
        assert got == _features(text, 3)[1]


def test_odd_rows(spark):
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    docs = [
        (1, "a b c"), (2, None), (3, ""), (4, "%% -- \n"), (None, "x y z " * 10), (None, "x y z " * 10),
        (6, long_text), (7, "q r s t " * 6), (7, "q r s t " * 6), (8, "É è " * 12),
        *((100 + i, f"w{i % 5} " * (18 + i % 4)) for i in range(60)),
    ]
    target = ["x y q", None, "", "w1 w2 É"]
    rows = [(d, t, "score", 5, "r") for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string, weight int, rank string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    for percent, least in ((25, 20), (100, 0), (0, 20), (50, 10**6)):
        got = resample(df, bench, percent=percent, least_words=least)
        assert sorted(map(tuple, got.collect()), key=str) == _plain(docs, target, percent, least)
    assert sorted(map(tuple, resample(df, bench.limit(0)).collect()), key=str) == _plain(docs, [])
    assert resample(df.limit(0), bench).collect() == []
    assert bucket_counts(df.limit(0)).collect() == []


def test_target_like_texts_are_drawn(spark):
    docs = [(i, ("sum of two numbers " if i % 4 == 0 else "rain falls on hills ") * 8) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = resample(df, spark.createDataFrame([("what is the sum of two numbers " * 2000,)], "text string"))
    drawn = [r.doc_id for r in got.where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(d % 4 == 0 for d in drawn) > 90

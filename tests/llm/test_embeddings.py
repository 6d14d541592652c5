"""Embedding near-duplicates against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from estrato.llm import embeddings
from estrato.llm.embeddings import multi_sequence, near_duplicates


def _brute(rows, least=0.93):
    fine = {}
    for n, (i, v, label) in enumerate(rows):
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            x = np.zeros(32)
            x[: len(v)] = np.float32(v)
            fine[n] = x / np.linalg.norm(x)
    links = {n: [m for m in fine if m != n and rows[m][2] == rows[n][2] and fine[n] @ fine[m] >= least] for n in fine}
    root = {n: rows[n][0] for n in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for n, near in links.items():
            low = min([root[n], *(root[m] for m in near)])
            if low != root[n]:
                root[n], changed = low, True
    return [(rows[n][0], len(links.get(n, [])), root[n]) for n in range(len(rows))]


def _rows():
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2, None):
        base = rng.normal(size=(60, 32))
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        for x in base:
            rows.append((x, label))
        for x in base[:20]:  # near, at and beyond the threshold
            for cosine in (0.99, 0.96, 0.935, 0.925):
                other = rng.normal(size=32)
                other -= other @ x * x
                rows.append((cosine * x + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other), label))
        crowd = base[30] + 0.01 * rng.normal(size=(40, 32))
        rows += [(x, label) for x in crowd]
        rows += [(base[5] * 7, label), (base[6], label), (base[6], label)]
    order = rng.permutation(len(rows))
    rows = [(int(i) * 3, [float(np.float32(v)) for v in rows[k][0]], rows[k][1]) for i, k in enumerate(order)]
    odd = [
        (5000, None, 1), (5001, [], 1), (5002, [0.0] * 32, 1), (5003, [float("nan")] + [1.0] * 31, 1),
        (5004, [float("inf")] + [1.0] * 31, 1), (5005, [None] + [1.0] * 31, 1), (None, [1.0] * 32, 1),
        (5006, [1.0] * 20, 1), (5007, [2.0] * 20, 1), (5008, [1.0] * 32, 9),
    ]
    return rows + odd


@pytest.mark.parametrize("block", [4096, 16])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "SHARE", 4 * block)
    monkeypatch.setattr(embeddings, "CELL", 8)
    rows = _rows()
    df = spark.createDataFrame([(i, v, label, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, n_links string")
    got = near_duplicates(df.repartition(3)).collect()
    assert len(got) == len(rows)
    want = {i: (n, c) for i, n, c in _brute([r for r in rows if r[0] is not None])}
    mine = {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None}
    assert all(mine[i][0] <= want[i][0] for i in want)  # nothing below the threshold
    found, true = sum(n for n, _ in mine.values()), sum(n for n, _ in want.values())
    assert found >= 0.97 * true
    if found == true:
        assert mine == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, None)]
    assert near_duplicates(df.limit(0)).count() == 0
    assert near_duplicates(df.where("label is null")).agg({"n_links": "sum"}).first()[0] == 0


def test_cells_come_nearest_first():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    got = multi_sequence(a, b, 35)
    want = sorted(((a[i] + b[j]), i, j) for i in range(7) for j in range(5))
    assert [(i, j) for _, i, j in want] == got
    assert multi_sequence(a, b, 3) == got[:3]

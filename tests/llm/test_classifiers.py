"""Quality and toxicity: exact search against brute force, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import SF

from estrato.llm import quality, toxicity
from estrato.llm.common import bounded_sample, is_fold, table, training_labels
from estrato.llm.queries import op1_quality, op3_toxicity

SF2 = SF.replace("sf0.001", "sf0.01")


def test_pairs_order_the_classes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    y = (x[:, 0] - 2 * x[:, 3] > -1).astype(int)
    model = quality.fit(x[:400], y[:400])
    got = quality.score(model, x[400:])
    assert ((got >= quality.ACCEPT) == y[400:]).mean() > 0.95
    assert ((got >= 0) & (got <= 1)).all()
    assert quality.score(quality.fit(x[:5], np.ones(5)), x[:2]).tolist() == [1.0, 1.0]
    assert quality.score(quality.fit(x[:0], np.ones(0)), x[:2]).tolist() == [0.5, 0.5]


def test_the_threshold_is_the_quantile_of_the_bad():
    x = np.zeros((10, len(quality.FEATURES)))
    x[:, 0] = np.arange(10)
    y = np.array([0] * 3 + [1] * 7)
    got = quality.score(quality.fit(x, y), x)
    assert (got >= quality.ACCEPT).sum() == 7 and (np.diff(got) > 0).all()


def test_quality_on_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in table(spark, SF2, "labels").collect()}
    rows = op1_quality(spark, SF2).collect()
    assert len(rows) == table(spark, SF2, "documents").count()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_nearest_are_exact():
    rng = random.Random(4)
    terms = [f"t{i}" for i in range(30)] + ["abcd*"]
    idf = {t: rng.uniform(1, 5) for t in terms}
    examples = [(i, rng.randint(0, 1), {t: rng.randint(1, 4) for t in rng.sample(terms, rng.randint(1, 4))}) for i in range(700)]
    index = toxicity.BlockMaxIndex(idf, set(), examples)
    vectors = [index.vector(e[2]) for e in examples]
    for _ in range(60):
        q = index.vector({t: rng.randint(1, 3) for t in rng.sample(terms, rng.randint(1, 5))})
        brute = [(-round(sum(w * v.get(t, 0.0) for t, w in q.items()), 12), n) for n, v in enumerate(vectors)]
        want = [(n, -c) for c, n in sorted(b for b in brute if b[0] < 0)[: toxicity.NEIGHBOURS]]
        got = index.nearest(q)
        assert [n for n, _ in got] == [n for n, _ in want]
        assert [c for _, c in got] == pytest.approx([c for _, c in want])
    assert index.nearest({}) == []
    assert index.nearest(vectors[5], k=1, without=5)[0][0] != 5


def test_toxicity_on_held_out_documents(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    truth = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = op3_toxicity(spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    clean = [r for r in held if truth[r.doc_id] == 0]
    toxic = [r for r in held if truth[r.doc_id] == 1]
    assert np.mean([r.predicted for r in clean]) < 0.02
    assert np.mean([r.predicted for r in toxic]) > 0.85
    assert np.mean([(r.score - truth[r.doc_id]) ** 2 for r in held]) < 0.03  # calibrated


def _docs(spark):
    rng = random.Random(6)
    plain = ["lorem", *("".join(rng.choices("aeioulmnrst", k=6)) for _ in range(400))]
    rows = []
    for i in range(400):
        words = rng.choices(plain, k=rng.randint(5, 60))
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["Nasty!", "rotten"])
        rows.append((i, " ".join(words), int(bad)))
    docs = rows + [(1000, "", None), (1001, None, None), (None, "nasty lorem", None), (3, "other lorem", None), (1002, "lorem " * 30_000 + "rotten", None)]
    labels = [(i, y) for i, _, y in rows] + [(3, 1 - rows[3][2]), (5, rows[5][2]), (None, 1), (7, None)]
    return (
        spark.createDataFrame([(i, t, 0.5, "x") for i, t, _ in docs], "doc_id long, text string, score double, _text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int").withColumnRenamed("toxic", "toxic"),
    )


def test_odd_rows(spark):
    docs, labels = _docs(spark)
    model = toxicity.learn(docs, labels)
    got = toxicity.toxicity_scores(docs, model).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1000].score == by_id[1001].score < 0.5
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    assert "rott*" in by_id[1002].terms  # the last word of a long text
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert toxicity.toxicity_scores(docs.limit(0), model).count() == 0
    empty = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.toxicity_scores(docs, empty).collect()} == {0.5}
    model = quality.learn(docs, labels.withColumnRenamed("toxic", "quality"))
    got = quality.quality_scores(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert quality.quality_scores(docs.limit(0), model).count() == 0


def test_labels_outside_the_fold_only(spark):
    rows = [(i, i % 2) for i in range(50)] + [(1, 0), (2, 0), (2, 0), (None, 1), (60, None), (61, 5)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = {r.doc_id: r.y for r in training_labels(labels, "quality", 4, 2).collect()}
    held = {r.doc_id for r in labels.where(is_fold("doc_id", 4, 2)).collect()}
    assert not held & set(got) and 1 not in got and None not in got and 60 not in got and 61 not in got
    many = spark.range(20_000).withColumnRenamed("id", "doc_id")
    assert 700 < bounded_sample(many, "doc_id", 1000).count() < 1300


def test_the_fit_is_the_least_loss_over_pairs():
    """Against plain descent on the same pairs, one by one."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 5))
    y = (x[:, 0] + rng.normal(size=40) > 0).astype(int)
    model = quality.fit(x, y, pairs=300)
    good, bad = x[y == 1].tolist(), x[y == 0].tolist()
    draw = np.random.default_rng(0)
    i, j = draw.integers(0, len(good), 300), draw.integers(0, len(bad), 300)
    scale = [float(np.std(x[:, k])) + 1e-6 for k in range(5)]
    pairs = [[(good[a][k] - bad[b][k]) / scale[k] for k in range(5)] for a, b in zip(i, j, strict=True)]
    w = [0.0] * 5
    for _ in range(4000):
        g = [quality.RIDGE * v for v in w]
        for d in pairs:
            miss = 1 / (1 + math.exp(sum(a * b for a, b in zip(w, d, strict=True))))
            for k in range(5):
                g[k] -= miss * d[k] / len(pairs)
        w = [a - 2.0 * b for a, b in zip(w, g, strict=True)]
    assert np.allclose(model["weight"] * scale, w, atol=1e-3)
    z = sorted(sum(w[k] / scale[k] * (r[k] - float(np.mean(x[:, k]))) for k in range(5)) for r in x.tolist())
    at = int((y == 0).sum())
    assert math.isclose(model["threshold"], (z[at - 1] + z[at]) / 2, abs_tol=1e-2)

"""Quality scores learned from preference pairs (Bradley-Terry).

A good and a bad labelled document make a pair; the probability that the good one wins is
the logistic function of the difference of their scores, each a weighted sum of the form of
a text (letters, signs, repetition), never of who wrote it.  The weights minimise the
logistic loss over feature differences.  The threshold is the quantile of the training
scores that leaves the share of bad labels below it, and is put at ``ACCEPT``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import labelled_texts, whole_text

#: Labelled rows that the model is fitted on at most, and pairs drawn from them.
EXAMPLES = 20_000
PAIRS = 200_000
RIDGE = 1e-3
ACCEPT = 0.7
WINDOW = 50
FOLDS, HELD_OUT = 4, 2

FEATURES = (
    "upper", "signs", "bars", "doubled", "same_word", "few_words", "same_line",
    "digits", "brackets", "word_length", "length", "stops", "non_ascii", "empty",
)


def features(text: bytes) -> list[float]:
    """What a text looks like; shares are bent so that a few per cent already count."""
    import operator

    import numpy as np

    if not text:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    w = max(1, len(words))
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    signs = int(n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum())
    stops = int(n[[33, 44, 46, 58, 59, 63]].sum())
    distinct = sum(len(set(words[i : i + WINDOW])) for i in range(0, len(words), WINDOW))
    lines = [x for x in text.split(b"\n") if x]
    same = sum(map(operator.eq, words, words[1:]))
    doubled = sum(text.count(bytes((c, c))) for c in b"!?#$%&*=-_")
    brackets = int(n[[60, 62, 91, 93, 123, 125]].sum())

    def bent(part: float, whole: float, half: float) -> float:
        share = part / max(1.0, whole)
        return share / (share + half)

    return [
        bent(upper, upper + lower, 0.1), bent(signs - stops, len(text), 0.02),
        bent(int(n[124]), w, 0.05), bent(doubled, w, 0.05), bent(same, w, 0.05),
        1 - distinct / w, 1 - len(set(lines)) / max(1, len(lines)),
        bent(int(n[48:58].sum()), len(text), 0.05), bent(brackets, len(text), 0.02),
        min(len(text) / w, 40) / 10, float(np.log1p(len(words))) / 10, bent(stops, w, 0.1),
        bent(int(n[128:].sum()), len(text), 0.1), float(not words),
    ]


def fit(x, y, pairs: int = PAIRS, seed: int = 0) -> dict:
    """Weights, centre and threshold from features ``x`` and labels ``y`` (0 or 1).

    With one class only there are no pairs: every score is the share of label 1 (a half
    without any label).
    """
    import numpy as np

    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return {"constant": float(y.mean()) if len(y) else 0.5}
    centre, scale = x.mean(0), x.std(0) + 1e-6
    rng = np.random.default_rng(seed)
    i, j = rng.integers(0, len(good), pairs), rng.integers(0, len(bad), pairs)
    d = (good[i] - bad[j]) / scale
    weight = np.zeros(d.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ weight, -30, 30)))
        gradient = d.T @ (p - 1) / pairs + RIDGE * weight
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(len(weight))
        step = np.linalg.solve(curve, gradient)
        weight -= step
        if np.abs(step).max() < 1e-6:
            break
    scores = np.sort((x - centre) / scale @ weight)
    at = int((y == 0).sum())
    threshold = (scores[at - 1] + scores[at]) / 2
    return {"weight": weight / scale, "centre": centre, "threshold": float(threshold)}


def score(model: dict, x):
    """Scores from 0 to 1; the threshold's score is ``ACCEPT``."""
    import numpy as np

    if "constant" in model:
        return np.full(len(x), model["constant"])
    z = (x - model["centre"]) @ model["weight"] - model["threshold"]
    return 1 / (1 + np.exp(-np.clip(z + np.log(ACCEPT / (1 - ACCEPT)), -30, 30)))


def _with(docs: DataFrame, keep: list[str], name: str, kind: str, value) -> DataFrame:
    """``keep`` and ``name``, what ``value`` makes of the features of a batch of texts."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text().cast("binary").alias("_text"))
    out = rows.drop("_text").withColumn(name, F.lit(None).cast(kind)).schema

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.array([features(t) for t in batch.column("_text").to_pylist()], float)
            made = value(x.reshape(-1, len(FEATURES)))
            names = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), made], [*names, name])

    return rows.mapInArrow(run, out)


def _as_lists(x):
    import pyarrow as pa

    return pa.array(x.tolist(), pa.list_(pa.float64()))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = EXAMPLES) -> dict:
    """The model of the labelled rows outside the held-out fold; a bounded sample of them
    comes to the driver as features, never as texts."""
    import numpy as np

    rows = labelled_texts(docs, labels, label, FOLDS, HELD_OUT, most)
    got = _with(rows, ["doc_id", "y"], "x", "array<double>", _as_lists).orderBy("doc_id").collect()
    x = np.array([r.x for r in got], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.y for r in got], int))


def quality_scores(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, predicted) of each row.

    Empty and null texts are scored like any other, by features of their own; texts of any
    length are read whole; repeated rows get equal scores; an empty table gives an empty one.
    """

    def value(x):
        import pyarrow as pa

        return pa.array(score(model, x))

    scored = _with(docs, ["doc_id"], "score", "double", value)
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))

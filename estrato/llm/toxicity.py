"""Toxicity by the nearest labelled examples.

Terms are words and the first letters of words; those whose presence tells the labels apart
(G-test over the examples) make the vectors, with steps of how many of a text's words have a
term that leans to the toxic ones.  Weights are (1 + ln tf) * idf, vectors have
length one.  The examples with the highest cosine are found exactly by a block-max inverted
index: the ids of the examples are cut into blocks, each term keeps its highest weight in a
block, the blocks with the highest bounds are looked into first, and then all others whose bound
reaches the k-th best so far.  Votes weigh by nearness, a text without any term gets the rate of such texts,
and a logistic fit over left-one-out votes calibrates the score.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import WORD, checked_broadcast, labelled_texts, text_batches, tidied, whole_text
from estrato.session import written

#: Labelled rows in the index at most; the terms are bounded by what these rows hold.
EXAMPLES = 12_000
#: Likelihood ratio from which a term tells the labels apart, for many thousands of terms.
LEAST_G = 20.0
PREFIX = 4
#: Shares of words with a toxic-leaning term; each that a text reaches is a term of its own.
RATES = (0.002, 0.005, 0.01, 0.015, 0.03)
NEIGHBOURS = 15
BLOCK = 64
#: Weight of the rate of texts without terms among the votes.
PRIOR = 0.25
#: Blocks looked into one after the other before all others that may hold a neighbour.
FIRST = 8
#: Terms that a task counts before it sends them on, and scores that it remembers.
HELD, KNOWN = 100_000, 4_096
FOLDS, HELD_OUT = 5, 0
FLAG = 0.5


def words_of(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W\d_]+", text.lower())


def terms_of(text: str) -> set[str]:
    """Distinct terms: words, and ``abcd*`` for longer words that begin so."""
    words = set(words_of(text))
    return words | {w[:PREFIX] + "*" for w in words if len(w) > PREFIX}


def distinct_examples(rows: DataFrame) -> DataFrame:
    """One of each group of examples with the same label and the same least hash of
    three-word runs: near copies say the same thing once."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(f"({WORD})"), 1)
    last = F.greatest(F.size("w") - 2, F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("w", i, 3)))
    sketched = rows.withColumn("w", words).withColumn("sketch", F.array_min(runs)).drop("w")
    return sketched.groupBy("sketch", "y").agg(
        F.min_by(F.struct("doc_id", "text"), "doc_id").alias("one")
    ).select("one.doc_id", "one.text", "y")


def telling_terms(rows: DataFrame) -> list[tuple[str, int, bool]]:
    """(term, rows that have it, whether it leans to label 1) of the terms that tell labels
    apart, by falling G."""

    def count(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        tally: tuple = (Counter(), Counter())

        def out():
            terms = list(tally[0] | tally[1])
            columns = [terms, [tally[0][t] for t in terms], [tally[1][t] for t in terms]]
            for c in tally:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["term", "n0", "n1"])

        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                tally[y].update(terms_of(text))
                if len(tally[0]) + len(tally[1]) > HELD:
                    yield out()
        yield out()

    base = rows.agg(F.count("*").alias("n"), F.sum("y").alias("n1")).first()
    if not base["n"] or base["n1"] in (0, base["n"]):
        return []
    counts = rows.select("text", "y").mapInArrow(count, "term string, n0 long, n1 long")
    counts = counts.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p1, df = base["n1"] / base["n"], F.col("n0") + F.col("n1")

    def part(n, p):
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (df * p))).otherwise(0.0)

    counts = counts.withColumn("g", 2 * (part("n0", 1 - p1) + part("n1", p1)))
    # bounded by the examples, which are: a few of the terms they hold tell the labels apart
    top = sorted(counts.where(F.col("g") >= LEAST_G).collect(), key=lambda r: (-r.g, r.term))
    found = {r.term: r for r in top}
    # a word says no more than its beginning if that tells the labels apart as well
    stems = {t: r.g for t, r in found.items() if t.endswith("*")}
    rows = [r for t, r in found.items() if stems.get(t[:PREFIX] + "*", -1.0) < r.g or t in stems]
    return [(r.term, r.n0 + r.n1, r.n1 > p1 * (r.n0 + r.n1)) for r in rows]


class BlockMaxIndex:
    """Examples as unit vectors, found by cosine through an inverted index in blocks."""

    def __init__(self, idf: dict[str, float], toxic: set[str], examples: list[tuple[int, int, dict[str, int]]]):
        import numpy as np

        self.idf, self.toxic = idf, toxic
        self.short = {t[:-1] for t in idf if t.endswith("*")}
        examples = sorted(examples, key=lambda e: e[0])
        self.ids = [e[0] for e in examples]
        self.label = np.array([e[1] for e in examples], float)
        self.blocks = -(-len(examples) // BLOCK)
        postings: dict[str, list] = {}
        for n, (_, _, tf) in enumerate(examples):
            for term, weight in self.vector(tf).items():
                postings.setdefault(term, []).append((n, weight))
        self.postings = {}
        for term, rows in postings.items():
            at = np.array([n for n, _ in rows])
            weight = np.array([w for _, w in rows])
            most = np.zeros(self.blocks)
            np.maximum.at(most, at // BLOCK, weight)
            self.postings[term] = (at, weight, most)

    def counts(self, text: str) -> dict[str, int]:
        """How often the known terms occur in the whole text, and the steps it reaches."""
        from collections import Counter

        out: dict[str, int] = {}
        idf, short, hits = self.idf, self.short, 0
        words = Counter(words_of(text))
        for w, n in words.items():
            start = w[:PREFIX]
            if start not in short and w not in idf:
                continue
            found = [t for t in (w, start + "*" if len(w) > PREFIX else "") if t in idf]
            for t in found:
                out[t] = out.get(t, 0) + n
            if any(t in self.toxic for t in found):
                hits += n
        for rate in RATES:
            if hits >= rate * words.total() and hits:
                out[f"~{rate}"] = 1
        return out

    def vector(self, tf: dict[str, int]) -> dict[str, float]:
        import math

        raw = {t: (1 + math.log(n)) * self.idf[t] for t, n in sorted(tf.items())}
        length = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / length for t, w in raw.items()} if length else {}

    def nearest(self, vector: dict[str, float], k: int = NEIGHBOURS, without: int | None = None):
        """(position, cosine) of the ``k`` nearest with a cosine above 0; the first of equals."""
        import numpy as np

        found = [(self.postings[t], w) for t, w in vector.items() if t in self.postings]
        if not found:
            return []
        bound = sum(w * p[2] for p, w in found)
        at = np.concatenate([p[0] for p, _ in found])
        weight = np.concatenate([w * p[1] for p, w in found])
        first = bound >= np.partition(bound, -FIRST)[-FIRST] if len(bound) > FIRST else np.full(len(bound), True)
        best = self._best(at, weight, first & (bound > 0), k, without)
        reach = best[1][-1] - 1e-9 if len(best[0]) >= k else 0.0
        rest = (bound > 0) & (bound >= reach) & ~first
        if rest.any():
            more = self._best(at, weight, rest, k, without)
            n, cosine = (np.concatenate(x) for x in zip(best, more, strict=True))
            order = np.lexsort((n, -cosine))[:k]
            best = n[order], cosine[order]
        return list(zip(best[0].tolist(), best[1].tolist(), strict=True))

    def _best(self, at, weight, blocks, k: int, without: int | None):
        """Positions and cosines of the ``k`` best in some blocks, equals by position."""
        import numpy as np

        here = blocks[at // BLOCK]
        cosine = np.round(np.bincount(at[here], weight[here], minlength=len(self.ids)), 12)
        if without is not None:
            cosine[without] = 0.0
        n = np.flatnonzero(cosine)
        n = n[np.argsort(-cosine[n], kind="stable")[:k]]
        return n, cosine[n]

    def vote(self, near, rate: float) -> float:
        """The share of toxic among the neighbours by squared cosine, drawn to ``rate``."""
        weight = [c * c for _, c in near]
        toxic = sum(w * self.label[n] for w, (n, _) in zip(weight, near, strict=True))
        return (toxic + PRIOR * rate) / (sum(weight) + PRIOR)


def _logit(p):
    import numpy as np

    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def calibration(votes, y, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic fit of labels on the logits of votes."""
    import numpy as np

    x = np.stack([_logit(votes), np.ones(len(votes))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 1e-2 * (w - [1, 0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.05), float(w[1])


class Model:
    """The index, the rate of texts without terms and the calibration."""

    def __init__(self, idf: dict[str, float], toxic: set[str], examples: list[tuple[int, int, dict[str, int]]]):
        import numpy as np

        blank = [y for _, y, tf in examples if not tf]
        total = [y for _, y, _ in examples]
        self.rate = (sum(blank) + 0.5) / (len(blank) + 1) if examples else 0.5
        self.index = BlockMaxIndex(idf, toxic, [e for e in examples if e[2]])
        votes = []
        for n, (_, _, tf) in enumerate(sorted((e for e in examples if e[2]), key=lambda e: e[0])):
            votes.append(self.index.vote(self.index.nearest(self.index.vector(tf), without=n), self.rate))
        votes += [self.rate] * len(blank)
        y = np.array([*self.index.label.tolist(), *blank], float)
        self.slope, self.shift = calibration(np.array(votes), y) if 0 < sum(total) < len(total) else (1.0, 0.0)
        self.known: dict = {}

    def score(self, text: str):
        """(score, nearest): the nearest are (example id, label, cosine)."""
        import math

        tf = self.index.counts(text)
        key = tuple(sorted(tf.items()))
        got = self.known.get(key)
        if got is None:
            near = self.index.nearest(self.index.vector(tf))
            z = self.slope * float(_logit(self.index.vote(near, self.rate))) + self.shift
            ids, label = self.index.ids, self.index.label
            got = (1 / (1 + math.exp(-z)), [(ids[n], int(label[n]), c) for n, c in near[:3]], sorted(tf))
            if len(self.known) < KNOWN and len(key) < 64:
                self.known[key] = got
        return got


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = EXAMPLES) -> Model:
    """The model of about ``most`` labelled rows at most, none of the held-out fold.

    Only the counts of telling terms come to the driver, for each example.
    """
    import math

    rows = written(distinct_examples(labelled_texts(docs, labels, label, FOLDS, HELD_OUT, most)), "examples")
    n = rows.count()
    terms = telling_terms(rows)
    toxic = {t for t, _, leans in terms if leans}
    idf = {t: math.log((1 + n) / (1 + df)) + 1 for t, df, _ in terms}
    empty = BlockMaxIndex(idf, toxic, [])

    def vectors(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            tf = [list(empty.counts(t).items()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(tf, pa.map_(pa.string(), pa.int64()))], ["doc_id", "y", "tf"])

    got = rows.select("doc_id", "y", "text").mapInArrow(vectors, "doc_id long, y int, tf map<string,long>")
    examples = [(r.doc_id, r.y, dict(r.tf)) for r in got.collect()]
    for step in (f"~{rate}" for rate in RATES):
        df = sum(step in tf for _, _, tf in examples)
        idf[step] = math.log((1 + n) / (1 + df)) + 1
    return Model(idf, toxic, examples)


SCORED = (
    "score double, terms array<string>, "
    "nearest array<struct<doc_id:long,label:int,cosine:double>>"
)


def toxicity_scores(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, score, predicted and the evidence: the terms found in the whole text and the
    nearest examples.

    Null and empty texts have no terms and get the score of such texts; texts of any length are
    read whole; repeated rows get equal scores; columns of ``docs`` not in ``keep`` are left out; an empty table gives an
    empty one, and without labels of both kinds every score is the rate of label 1.
    """
    from pyspark.sql import types as T

    text_batches(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c != "text"], whole_text().alias("_text"))
    more = T.StructType.fromDDL(SCORED)
    fields = [f for f in rows.schema.fields if f.name != "_text"]
    held = ["_text"] if "text" in keep else []
    out = T.StructType([*fields, *([T.StructField("_text", T.StringType())] if held else []), *more.fields])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        near = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
        for batch in tidied(batches):
            names = [c for c in batch.schema.names if c != "_text" or held]
            texts = batch.column("_text")
            got = [model.score(texts[i].as_py()) for i in range(len(texts))]
            columns = [
                pa.array([g[0] for g in got], pa.float64()),
                pa.array([g[2] for g in got], pa.list_(pa.string())),
                pa.array([[dict(zip(("doc_id", "label", "cosine"), x, strict=True)) for x in g[1]] for g in got], near),
            ]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *columns], [*names, *more.names])

    scored = rows.mapInArrow(run, out)
    if held:
        scored = scored.withColumnRenamed("_text", "text")
    return scored.withColumn("predicted", (F.col("score") >= FLAG).cast("int"))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns.

    Only ids and texts go to Python.  A row goes with all rows of the same doc_id and text, a
    null id being an id and a null text an empty one; columns may have any names; texts are read
    whole; an empty table stays empty.
    """
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(whole_text()).alias("_hash"), "text")
    bad = toxicity_scores(keyed, model, ("_id", "_hash")).where("predicted = 1").select("_id", "_hash").distinct()
    bad = checked_broadcast(written(bad, "toxic"), 24)
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_hash"])
    return docs.join(bad, same, "left_anti")

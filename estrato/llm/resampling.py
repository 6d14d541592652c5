"""Importance resampling towards a target distribution over hashed n-grams.

A 256-byte table lower-cases A-Z and blanks every separator of the UTF-8 bytes, ``bytes.split``
gives the words, and the crc32 of a run of words goes on from that of the shorter run, so that
an n-gram is hashed without being built.  Counters of the hashes are folded into buckets in each
task and summed by Spark; a bucket's gain is the log ratio of its share in the target and in the
documents.  A document's weight is the mean gain of its features, and the highest weights with
Gumbel noise, seeded by the id, are a draw without replacement in proportion to importance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import checked_broadcast, whole_text
from estrato.session import written

BUCKETS = 10_000
#: Words of the longest run that is a feature.
ORDER = 2
#: Neighbouring scores that are summed up together on the way to ranks.
STEP = 256
#: Different hashes that a task counts before it folds them into buckets.
HELD = 200_000

#: What is part of a word, besides all bytes beyond ASCII.
KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"


def byte_table() -> bytes:
    """Lower-cases A-Z and makes a blank of each ASCII byte that is no letter or digit."""
    lower = bytes(range(256)).lower()
    return bytes(b if b >= 0x80 or b in KEPT else 0x20 for b in lower)


def words_of(text: str | None, table: bytes) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(table).split()


def feature_hashes(words: list[bytes], order: int) -> Iterator[list[int]]:
    """crc32 of all runs of 1, 2, ... ``order`` words joined by a space, a list for each length."""
    from itertools import repeat
    from zlib import crc32

    seeds = list(map(crc32, words))
    for k in range(1, order + 1):
        yield seeds
        seeds = list(map(crc32, words[k:], map(crc32, repeat(b" "), seeds)))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""
    table = byte_table()

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        total, tally = np.zeros(buckets, np.int64), Counter()

        def fold():
            hashes = np.fromiter(tally.keys(), np.int64, len(tally)) % buckets
            np.add.at(total, hashes, np.fromiter(tally.values(), np.int64, len(tally)))
            tally.clear()

        for batch in batches:
            for text in batch.column(0):
                for hashes in feature_hashes(words_of(text.as_py(), table), order):
                    tally.update(hashes)
                if len(tally) > HELD:
                    fold()
        fold()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    counted = docs.select(whole_text()).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> list[int]:
    """The gain of each bucket in thousandths; ``buckets`` numbers come to the driver."""
    s, t = [{r.bucket: r.n for r in bucket_counts(df, buckets, order).collect()} for df in (docs, target)]
    in_docs, in_target = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [
        math.floor(1000 * math.log((t.get(b, 0) + 1.0) * in_docs / ((s.get(b, 0) + 1.0) * in_target)))
        for b in range(buckets)
    ]


def weights(docs: DataFrame, gains: list[int], order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row; without features the weight is 0."""
    table, buckets = byte_table(), len(gains)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("_text"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        gain = np.array(gains, np.int64)
        for batch in batches:
            out = []
            for text in batch.column("_text"):
                words, n, total = words_of(text.as_py(), table), 0, 0
                for hashes in feature_hashes(words, order):
                    n += len(hashes)
                    total += int(gain[np.array(hashes, np.int64) % buckets].sum())
                out.append((len(words), n, total // n if n else 0))
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def drawn(scored: DataFrame, percent: int) -> DataFrame:
    """``scored``, a written table with ``eligible``, ``score`` and ``doc_id``, and the ``rank`` of
    the ``percent`` of its eligible rows with the highest scores, null for the others.

    Scores are whole numbers of a narrow range, so rows are counted by score, and a row's rank is
    the number of rows with a higher score and its place among its equals: no sort of all rows.
    Steps of ``STEP`` scores, a few hundred whatever the input, are summed up in one task.
    """
    eligible = scored.where("eligible")
    by_score = eligible.groupBy("score").agg(F.count("*").alias("n")).withColumn("step", F.floor(F.col("score") / STEP))
    by_score = written(by_score, "levels")
    steps = by_score.groupBy("step").agg(F.sum("n").alias("in_step"))
    steps = steps.withColumn("higher", F.sum("in_step").over(Window.orderBy(F.desc("step"))) - F.col("in_step"))
    in_step = F.sum("n").over(Window.partitionBy("step").orderBy(F.desc("score"))) - F.col("n")
    levels = by_score.join(steps, "step").withColumn("before", F.col("higher") + in_step)
    levels = written(levels.select("score", "n", "before"), "levels-before")
    rows = levels.agg(F.sum("n")).first()[0] or 0
    draw = percent * rows // 100
    levels = written(levels.where(F.col("before") < draw).select(F.col("score").alias("_score"), "before"), "drawn-levels")
    cut = levels.agg(F.min("_score")).first()[0]
    is_high = F.col("eligible") & (F.col("score") >= cut) if cut is not None else F.lit(False)
    high = scored.where(is_high).join(checked_broadcast(levels, 16), F.col("score") == F.col("_score"))
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    rank = (F.col("before") + place).cast("long")
    high = high.withColumn("rank", F.when(rank <= draw, rank)).drop("before", "_score")
    return high.unionByName(scored.where(~is_high).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7,
    buckets: int = BUCKETS, order: int = ORDER,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): a row for each row of ``docs``, drawn to look
    like the texts of ``target``.

    Null and empty texts have no features, the weight 0 and are never drawn, as texts under
    ``least_words`` words; a null id has the noise of the id '' and comes after equal scores;
    repeated rows are scored each and equal rows ranked in any order; columns other than doc_id
    and text are not read, so their names don't matter; an empty table gives an empty one, and
    an empty target draws what is rarest.
    """
    gains = bucket_gains(docs, target, buckets, order)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = weights(docs, gains, order).withColumn("score", F.col("weight") + noise)
    scored = written(rows.withColumn("eligible", F.col("n_words") >= least_words).drop("n_words"), "weights")
    return drawn(scored, percent).select("doc_id", "n_features", "weight", "score", "rank")

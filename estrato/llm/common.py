"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estrato.session import written

#: Most that a checked side of a join may take in each executor.
BROADCAST_BYTES = 8 << 20
#: Rows with whole texts in an Arrow batch.
TEXTS = 2_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Words are runs of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def is_fold(doc_id: str, parts: int, which: int) -> Column:
    return fold(doc_id, parts) == which


def training_labels(labels: DataFrame, label: str, parts: int, held: int) -> DataFrame:
    """(doc_id, y) of the labelled ids outside the held-out fold.

    Null labels, null ids and ids with both labels teach nothing; repeated rows count once.
    """
    rows = labels.where(
        F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~is_fold("doc_id", parts, held)
    )
    one = rows.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_most"))
    return one.where(F.col("y") == F.col("_most")).select("doc_id", F.col("y").cast("int"))


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, drawn by a seeded hash of ``key``: the same rows on
    each run, whatever the partitions.  A smaller table is kept whole."""
    rows = df.count()
    if rows <= most:
        return df
    share = int(most / rows * 2**31)
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(2**31)) < share)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, most: int
) -> DataFrame:
    """(doc_id, y, text): about ``most`` training rows at most, in a scratch table.

    The ids are a bounded sample, so their broadcast is bounded too.  An id with several
    texts teaches with one of them, the one with the least hash.
    """
    ids = written(bounded_sample(training_labels(labels, label, parts, held), "doc_id", most), "labels")
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), "doc_id")
    one = rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return written(one, "labelled")


def checked_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """A hint to broadcast ``df``, a written table, if its counted rows stay below
    ``BROADCAST_BYTES``; beyond it joins shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def text_batches(spark: SparkSession) -> None:
    """Send at most ``TEXTS`` rows to Python at a time in this session, which stays so: whole texts
    are long, and a batch takes its size several times on both sides."""
    if int(spark.conf.get(ARROW_ROWS)) > TEXTS:
        spark.conf.set(ARROW_ROWS, str(TEXTS))


def tidied(batches: Iterator) -> Iterator:
    """Arrow batches of a task; what a batch has needed goes back to the system before the next
    one, so that a worker that waits holds little."""
    import ctypes

    import pyarrow as pa

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim is not None:
            trim(0)

"""Insert-or-ignore into a table whose folders go by a hash of the key.

Each load has its folder ``batch=<id>`` with a folder for each bucket in it.  An insert reads the
keys of the buckets that its rows fall into, no others, and a batch of checked size is sent to
them, so that the table itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.operators.aggregates import latest_per_key
from estrato.operators.audit import counted
from estrato.operators.incremental import not_in
from estrato.session import written
from estrato.sources.compaction import read_loads, written_again
from estrato.sources.paths import any_match

BUCKET = "key_bucket"
BUCKETS = 16
#: Bytes of the keys of a batch up to which they are sent to all tasks.
SENT_BYTES = 8 << 20


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """``<bucket>-<buckets>`` of a key, NULL parts included: other numbers of buckets don't mix."""
    h = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets))
    return F.concat(h.cast("string"), F.lit(f"-{buckets}"))


def read_keys(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
    touched: Sequence[str] | None = None, without_batch: str | None = None,
    batches: Sequence[str] | None = None,
) -> DataFrame:
    """The keys of an inserted table, of the ``touched`` buckets and ``batches`` alone if given.

    Folders made with another number of buckets are always read.
    """
    if not any_match(spark, f"{path}/batch=*/_SUCCESS"):
        return spark.createDataFrame([], T.StructType([schema[k] for k in keys]))
    fields = [*[schema[k] for k in keys], T.StructField(BUCKET, T.StringType())]
    rows = read_loads(spark, path, fields, batches)
    if touched is not None:
        ours = F.lit(False)
        for number in {t.rsplit("-", 1)[1] for t in touched}:
            ours = ours | F.col(BUCKET).endswith(f"-{number}")
        rows = rows.where(F.col(BUCKET).isin(list(touched)) | ~F.coalesce(ours, F.lit(False)))
    if without_batch is not None:
        rows = rows.where(F.col("batch") != without_batch)
    return rows.select(*keys)


def missing_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], row_bytes: int = 64) -> DataFrame:
    """Rows of ``source``, a written table, whose key the target lacks.

    A source of checked size is sent to the target, which then only gives back the keys it
    has; of a larger one only the keys are shuffled to meet the target, and its rows take the
    new ones, whose size as written decides how.  An empty target is met by nothing.
    """
    same = [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys]
    if source.count() * row_bytes > SENT_BYTES:
        if target.isEmpty():
            return source
        new = written(not_in(source.select(*keys).distinct(), target, keys), "new-keys")
        return source.alias("t").join(new.alias("s"), same, "left_semi")
    asked = F.broadcast(source.select(*keys).distinct())
    known = target.alias("t").join(asked.alias("s"), same, "left_semi")
    return not_in(source, written(known.distinct(), "known-keys"), keys)


def insert_bucketed(
    source: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[Column] | None, batch: str,
    buckets: int = BUCKETS, batches: Sequence[str] | None = None,
) -> int:
    """Insert-or-ignore: of each new key the first row in the given order; returns their number.

    Without an order all rows of a new key go in.  A batch that runs again replaces its own
    rows; ``batches`` names the loads that count, all if it is None.
    """
    spark, schema = source.sparkSession, source.schema
    first = source if order_by is None else latest_per_key(source, keys, order_by)
    first = written(first.withColumn(BUCKET, bucket_of(keys, buckets)), "insert")
    touched = [r[0] for r in first.select(BUCKET).distinct().collect()]  # ``buckets`` at most
    target = read_keys(spark, path, schema, keys, touched, batch, batches)
    new, seen = counted(missing_keys(first, target, keys).hint("rebalance", BUCKET))
    new.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/batch={batch}")
    written_again(spark, path, batch)
    return seen.get["rows"]

"""The incremental load as a stream: new files in, idempotent insert out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from estrato.sources.buckets import insert_bucketed


def new_files(
    spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Stream of the Parquet files of a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def insert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[Column],
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    batch_prefix: str = "stream",
) -> StreamingQuery:
    """Insert the rows with new keys, batch by batch, until all files are read.

    A batch meets the keys of the buckets that its rows fall into, not the whole table.

    The checkpoint remembers the files that are done, in place of a watermark row.  A
    batch that is run again writes the same folder again, so a lost driver or executor
    leaves no double rows.  ``batch_prefix`` names the stream in those folders: a stream
    that starts over with a new checkpoint takes a new one.
    """

    def load(rows: DataFrame, batch: int) -> None:
        insert_bucketed(transform(rows), path, keys, order_by, f"{batch_prefix}-{batch:010d}")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

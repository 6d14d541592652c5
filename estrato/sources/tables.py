"""Layer tables: Parquet folders with plain Spark writes.

An appended table has one ``batch=<id>`` folder per load, written in overwrite mode:
a load that is run again replaces its own rows.  A table that is upserted is written
as a whole to a new ``version=<n>`` folder; readers take the newest one that carries
the commit marker, so they never see half a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.operators.audit import counted
from estrato.operators.incremental import merge_upsert
from estrato.operators.shape import align_to_schema
from estrato.session import written
from estrato.sources.compaction import read_loads, written_again
from estrato.sources.paths import any_match, matching, plain_name, removed
from estrato.sources.schema_log import keep_schema, kept_schemas, same_types, widened


def read_appended(
    spark: SparkSession, path: str, schema: T.StructType | None = None, without_batch: str | None = None
) -> DataFrame:
    """All loads of an appended table (no row if there is none yet).

    Loads whose schema is not ``schema`` are read with their own, which is kept beside them,
    and widened to it; no footer is read.  Without a schema the columns are those of all
    loads, each of the type that holds all of its types (``widened``).
    """
    if not any_match(spark, f"{path}/batch=*/_SUCCESS"):
        return spark.createDataFrame([], schema or T.StructType())
    kept = kept_schemas(spark, path)
    if schema is None:
        schema = widened(list(kept))
    odd = {s: batches for s, batches in kept.items() if not same_types(s, schema)}

    def rows(of: T.StructType, only: Column) -> DataFrame:
        some = read_loads(spark, path, of.fields).where(only)
        return align_to_schema(some if without_batch is None else some.where(F.col("batch") != without_batch), schema)

    others = [b for batches in odd.values() for b in batches]
    out = rows(schema, ~F.col("batch").isin(others) if others else F.lit(True))
    for of, batches in odd.items():
        out = out.unionByName(rows(of, F.col("batch").isin(batches)))
    return out


def append_batch(df: DataFrame, path: str, batch: str) -> int:
    """Write the rows of one load and return their number, from the write itself.

    The schema is kept beside the rows, before them: a load with rows has one.
    """
    keep_schema(df, path, batch)
    rows, seen = counted(df)
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    written_again(df.sparkSession, path, batch)
    return seen.get["rows"]


def versions(spark: SparkSession, path: str) -> list[str]:
    """Committed versions, oldest first."""
    return [p.rsplit("/", 1)[0] for p in matching(spark, f"{path}/version=*/_SUCCESS")]


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest committed version (no row if there is none yet)."""
    done = versions(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(done[-1])


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write the next version of a table; returns its number of rows."""
    done = versions(df.sparkSession, path)
    last = int(done[-1].rsplit("=", 1)[1]) if done else 0
    rows, seen = counted(df)
    writer = rows.write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(f"{path}/version={last + 1:010d}")
    return seen.get["rows"]


def upsert(source: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Upsert the source into a versioned table; returns the rows it has then."""
    target = read_current(source.sparkSession, path, source.schema)
    return write_version(merge_upsert(target, source, keys), path)


MANIFEST = T.StructType([T.StructField("value", T.StringType()), T.StructField("folder", T.StringType())])


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, by: str) -> DataFrame:
    """A table with a current folder for each value of ``by`` (no row if there is none yet).

    The manifest names the folders; others below ``path`` are of writes that were replaced
    or never ended, and aren't read.
    """
    current = read_current(spark, f"{path}/_manifest", MANIFEST).collect()  # a name for each folder
    if not current:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{r.folder}" for r in current])
    return rows.select(*schema.names)


def upsert_keyed(source: DataFrame, path: str, keys: Sequence[str], by: str) -> int:
    """Upsert into a table with a folder for each value of ``by``, one of the keys.

    Only folders of values that the source has are read and replaced: the range of the
    values is a partition filter, the values themselves are joined.  The new folders are
    written beside the old ones and come to count together, by the manifest that is written
    last: a reader sees all of a batch or nothing of it, and a write that fails in between
    leaves the table as it was.  Returns the rows that were written.
    """
    spark = source.sparkSession
    source = written(source, "upsert")
    ends = source.agg(F.min(by).alias("low"), F.max(by).alias("high")).first()
    if ends["low"] is None:
        return 0
    old = read_keyed(spark, path, source.schema, by)
    old = old.where(F.col(by).between(F.lit(ends["low"]), F.lit(ends["high"])))
    old = old.join(source.select(by).distinct(), by, "left_semi").select(*source.columns)
    rows, seen = counted(merge_upsert(old, source, keys).hint("rebalance", by))
    new = f"write={uuid.uuid4().hex}"
    rows.write.partitionBy(by).parquet(f"{path}/{new}")
    made = [p.rsplit("/", 1)[1] for p in matching(spark, f"{path}/{new}/{by}=*")]
    added = spark.createDataFrame([(m, f"{new}/{m}") for m in made], MANIFEST)
    before = read_current(spark, f"{path}/_manifest", MANIFEST)
    write_version(merge_upsert(before, added, ["value"]).coalesce(1), f"{path}/_manifest")
    return seen.get["rows"]


def write_reports(
    df: DataFrame, path: str, mode: str = "append", by: str = "src_table"
) -> None:
    """Write report rows by dataset.

    ``overwrite`` replaces the datasets that are in ``df`` and leaves the others alone;
    ``append`` adds to them.  Rows are rebalanced by dataset: small datasets become one
    file, and one that holds a third of all rows is split over many tasks.
    """
    writer = df.hint("rebalance", by).write.mode(mode).partitionBy(by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def empty_datasets(
    read: DataFrame, rejected: DataFrame, path: str, schema: T.StructType, by: str
) -> None:
    """Empty the datasets that were read and rejected, if the table has rows of them: their
    folders go, whose names come from one listing."""
    spark = read.sparkSession
    if not any_match(spark, f"{path}/{by}=*"):
        return
    folder = plain_name(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))
    there = spark.read.schema(schema).parquet(path).select(by, folder.alias("_folder")).distinct()
    gone = rejected.toDF(by).join(read, by, "left_semi").distinct()
    for row in there.join(gone, by, "left_semi").toLocalIterator():  # a name for each dataset
        removed(spark, row["_folder"])


def datasets_with_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Rows of the datasets whose name ends in ``_<suffix>``: a partition filter."""
    return df.where(F.col("src_table").endswith(f"_{suffix}"))


def truncate(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Empty a versioned table by a version without rows."""
    return write_version(spark.createDataFrame([], schema), path)

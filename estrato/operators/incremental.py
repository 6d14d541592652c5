"""Idempotent loads: insert-or-ignore, upsert, watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.operators.aggregates import latest_per_key


def _same_key(keys: Sequence[str]) -> Column:
    """Key equality in which NULL equals NULL."""
    parts = [F.col(f"s.`{k}`").eqNullSafe(F.col(f"t.`{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, parts)


def not_in(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the source whose key the target lacks (NULL is a key like any other)."""
    known = target.select(*keys)
    return source.alias("s").join(known.alias("t"), _same_key(keys), "left_anti")


def insert_new(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """The rows an insert-or-ignore adds: per new key the first row in the given order."""
    return not_in(latest_per_key(source, keys, order_by), target, keys)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after an upsert: source rows, and target rows with other keys.

    The source has one row per key; keys compare null-safe, so a key with a NULL part
    replaces its old row instead of adding one.
    """
    return source.unionByName(not_in(target, source, keys).select(*source.columns))


WATERMARK_KEYS = ["source_system", "entity", "watermark_key"]


def watermark_row(
    batch: DataFrame, source_system: str, entity: str, key: str, value: Column, run_ts: datetime
) -> DataFrame:
    """The new watermark of a batch: its largest value.  An empty batch has no row, so
    the value before it stays."""
    return (
        batch.agg(F.max(value).cast("string").alias("watermark_value"))
        .where(F.col("watermark_value").isNotNull())
        .select(
            F.lit(source_system).alias("source_system"),
            F.lit(entity).alias("entity"),
            F.lit(key).alias("watermark_key"),
            "watermark_value",
            F.lit(run_ts).alias("updated_at"),
        )
    )


def set_watermark(store: DataFrame, row: DataFrame) -> DataFrame:
    return merge_upsert(store, row, WATERMARK_KEYS)


def get_watermark(store: DataFrame, source_system: str, entity: str, key: str) -> DataFrame:
    """One row with ``watermark_value``, ``'0'`` where none is stored."""
    match = (
        (F.col("source_system") == source_system)
        & (F.col("entity") == entity)
        & (F.col("watermark_key") == key)
    )
    found = F.max(F.when(match, F.col("watermark_value")))
    return store.agg(F.coalesce(found, F.lit("0")).alias("watermark_value"))

"""Counts for validation, and table profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def audit_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``(check, rows)`` for every condition, from one scan."""
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    return counts.unpivot([], list(checks), "check", "rows")


def profile_table(df: DataFrame, table: str) -> DataFrame:
    """One row per column: position, type, rows and NULLs of it, from one scan."""
    fields = df.schema.fields
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("filled"),
        )
        for i, f in enumerate(fields)
    ]
    columns = totals.select("n", F.inline(F.array(*rows)))
    return columns.select(
        F.lit(table).alias("table_name"),
        "position",
        F.col("column").alias("column_name"),
        F.col("type").alias("data_type"),
        F.col("n").alias("row_count"),
        (F.col("n") - F.col("filled")).alias("null_count"),
    )


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The same rows, with a counter that the action on them fills: no second scan."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def preview(df: DataFrame, order_by: list[Column], rows: int = 10) -> DataFrame:
    """The first rows in a stated order (a top-k plan, not a full sort)."""
    return df.orderBy(*order_by).limit(rows)

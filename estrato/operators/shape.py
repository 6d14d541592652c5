"""Row shape: fixed schemas, empty rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.functions.numbers import is_empty_or_zero


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, in its order and types: missing ones NULL, others dropped."""
    have = set(df.columns)

    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`") if field.name in have else F.lit(None)
        return c.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def _one_cell(rule: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda cell: rule(cell)  # a rule may have more parameters, which a loop would fill


def read_cells(df: DataFrame, read: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Put what ``read`` makes of them in the place of the columns it names.

    Columns with one rule are read by one loop over them: the rule written out for each column
    of a wide report makes a method that Java doesn't compile.
    """
    by_rule: dict[Callable[[Column], Column], list[str]] = {}
    for name, rule in read.items():
        by_rule.setdefault(rule, []).append(name)
    loops, cells = [], {}
    for i, (rule, names) in enumerate(by_rule.items()):
        loops.append(F.transform(F.array(*names), _one_cell(rule)).alias(f"_cells{i}"))
        cells |= {n: F.col(f"_cells{i}")[k].alias(n) for k, n in enumerate(names)}
    return df.select("*", *loops).select(*[cells.get(n, F.col(n)) for n in df.columns])


def drop_empty_rows(df: DataFrame, business_columns: Sequence[str]) -> DataFrame:
    """Drop rows in which all business columns are NULL (metadata does not count).

    For a handful of columns: the optimizer derives a variant of this predicate for
    every renamed column above it.  Wide report rows are tested before they are spread
    into columns (:func:`estrato.operators.reports.drop_empty_records`).
    """
    return df.na.drop("all", subset=list(business_columns))


def drop_empty_or_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop a row when any of the columns is empty, an NA token or zero."""
    return df.where(~reduce(lambda a, b: a | b, [is_empty_or_zero(F.col(c)) for c in columns]))


def drop_blank_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys filled, and the rows set aside because a key is blank."""
    filled = reduce(
        lambda a, b: a & b,
        [F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) != "" for k in keys],
    )
    return df.where(filled), df.where(~filled)

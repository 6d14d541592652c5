"""Ordered work inside a group of any size.

A group (a report file, a user) may hold a third of all rows, so no window runs
over a whole group.  Rows are cut into chunks of a fixed span of the order column;
a window sees one chunk, and what a chunk hands to the next one travels through a
summary of one row per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.operators.shape import read_cells

CHUNK = "_chunk"
CHUNK_SPAN = 1 << 17
#: Summary rows that one window sees: the chunks of a group are summed up in turn.
SUPER = "_super"
SUMMARY_SPAN = 1 << 12


def with_chunk(df: DataFrame, order: str, span: int = CHUNK_SPAN) -> DataFrame:
    """Number the chunk of each row; ``order`` is an integer, unique within a group."""
    return df.withColumn(CHUNK, F.expr(f"`{order}` div {span}"))


def within_chunk(group: Sequence[str], order: str) -> Window:
    """Rows of the chunk up to and with the current one."""
    w = Window.partitionBy(*group, CHUNK).orderBy(order)
    return w.rowsBetween(Window.unboundedPreceding, 0)


def earlier_chunks(group: Sequence[str]) -> Window:
    """Summary rows of all chunks before the current one."""
    w = Window.partitionBy(*group).orderBy(CHUNK)
    return w.rowsBetween(Window.unboundedPreceding, -1)


def forward_fill(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    columns: Sequence[str],
    span: int = CHUNK_SPAN,
    read: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Replace NULLs by the last value above them in the group, in ``order``.

    Group columns must not be NULL.  The rows are shuffled once, by group and chunk;
    the join with the summary keeps that partitioning and sort order.

    ``read`` is applied to the filled columns it names, as it would be after the fill, but
    once where a value stands and not in every row that takes it over.
    """
    held = {c: _held(f) for c, f in (read or {}).items()}
    chunked = with_chunk(df, order, span)
    window = within_chunk(group, order)
    kept = [F.col(c) for c in chunked.columns if c not in columns]
    values = read_cells(chunked, held)
    inside = values.select(*kept, *[F.last(c, True).over(window).alias(c) for c in columns])
    carry = _carried(_last_per_chunk(chunked, group, order, columns), group, columns)
    carry = read_cells(carry, {f"_carry_{c}": f for c, f in held.items()})
    filled = {c: F.coalesce(F.col(c), F.col(f"_carry_{c}")) for c in columns}
    filled = {c: (v["v"] if c in held else v).alias(c) for c, v in filled.items()}
    return inside.join(carry, [*group, CHUNK], "left").select(
        *[filled.get(c, F.col(c)) for c in df.columns]
    )


@cache
def _held(f: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """``f`` of a value as a row of one: a value that is read as NULL is one still."""
    return lambda c: F.when(c.isNotNull(), F.struct(f(c).alias("v")))


def _carried(last: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """What each chunk takes over from the ones before it, in two steps: from those of its
    own run of chunks, else from the runs before, of which there is one row each."""
    runs = last.withColumn(SUPER, F.expr(f"`{CHUNK}` div {SUMMARY_SPAN}"))
    inside = Window.partitionBy(*group, SUPER).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*group).orderBy(SUPER).rowsBetween(Window.unboundedPreceding, -1)
    of_run = runs.groupBy(*group, SUPER).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(CHUNK))).alias(c) for c in columns]
    ).select(*group, SUPER, *[F.last(c, True).over(above).alias(f"_run_{c}") for c in columns])
    near = runs.select(*group, SUPER, CHUNK, *[F.last(c, True).over(inside).alias(f"_near_{c}") for c in columns])
    return near.join(of_run, [*group, SUPER], "left").select(
        *group, CHUNK,
        *[F.coalesce(f"_near_{c}", f"_run_{c}").alias(f"_carry_{c}") for c in columns],
    )


def _last_per_chunk(
    chunked: DataFrame, group: Sequence[str], order: str, columns: Sequence[str]
) -> DataFrame:
    """Last value that is not NULL per chunk: a partial aggregate, no sort."""

    def latest(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)

    return chunked.groupBy(*group, CHUNK).agg(*[latest(c) for c in columns])

"""Latest row per key, text lists, source pivots.  All but the text lists reduce a
hot key on the map side, before any row of it is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(*columns: str) -> list[Column]:
    """Descending order with NULL on top, as a descending sort in PostgreSQL has it."""
    return [F.col(c).desc_nulls_first() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; NULL keys form a group.

    Spark keeps only the best row per key of each map task (a partial window group
    limit), so a hot key arrives in the last task as one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def text_lists(
    df: DataFrame,
    keys: Sequence[str],
    kind: str,
    value: str,
    kinds: Mapping[str, str],
    sep: str = " / ",
) -> DataFrame:
    """One column per kind with the joined values of that kind, in value order.

    ``kinds`` maps the output column to the kind.  One pass instead of one grouped copy
    per kind; a key without values of a kind has NULL there.
    """

    def joined(name: str, wanted: str) -> Column:
        parts = F.expr(
            f"listagg(case when `{kind}` = '{wanted}' then `{value}` end, '{sep}') "
            f"within group (order by case when `{kind}` = '{wanted}' then `{value}` end)"
        )
        return parts.alias(name)

    return df.groupBy(*keys).agg(*[joined(n, k) for n, k in kinds.items()])


def pivot_sources(
    df: DataFrame,
    keys: Sequence[str],
    source: str,
    sources: Mapping[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """Maximum of each column per key and source, as columns ``<prefix>_<column>``.

    ``sources`` maps the prefix to the source.  Keys with rows of other sources only
    stay, with NULL columns.
    """
    cells = [
        F.max(F.when(F.col(source) == name, F.col(c))).alias(f"{prefix}_{c}")
        for prefix, name in sources.items()
        for c in columns
    ]
    return df.groupBy(*keys).agg(*cells)


def prefer_source(
    prefixes: Sequence[str], column: str, blanks: Sequence[str] = ()
) -> Column:
    """First value of the column over the sources in order, blank tokens skipped."""

    def usable(prefix: str) -> Column:
        c = F.col(f"{prefix}_{column}")
        return F.when(~c.isin(*blanks), c) if blanks else c

    return F.coalesce(*[usable(p) for p in prefixes])

"""Star joins, lookups with a default, unions with an origin.

No join carries a broadcast hint: Spark broadcasts a side only when its size, known
from file statistics or measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``; above it the join sorts both sides, and
adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dim:
    """One arm of a star: ``on`` pairs a column of the star with one of the table.

    ``where`` is the constant part of the ON clause; it filters the table before the
    join, which for a left join is not the same as a filter after it.
    """

    table: DataFrame
    alias: str
    on: Sequence[tuple[str, str]]
    how: str = "inner"
    where: Column | None = None


def star_join(fact: DataFrame, alias: str, dims: Sequence[Dim]) -> DataFrame:
    """Join the arms in order; columns are addressed as ``alias.column``."""
    out = fact.alias(alias)
    for d in dims:
        table = d.table if d.where is None else d.table.where(d.where)
        keys = [F.col(left) == F.col(f"{d.alias}.{right}") for left, right in d.on]
        out = out.join(table.alias(d.alias), reduce(lambda a, b: a & b, keys), d.how)
    return out


def lookup_default(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    default: str,
    active: str | None = None,
) -> DataFrame:
    """Add ``value`` from the lookup row with the same key, or the default.

    Only active lookup rows take part.  A lookup that lists a key twice repeats the
    row, as a left join does.
    """
    rows = lookup if active is None else lookup.where(F.col(active))
    rows = rows.select(key, value)
    joined = df.join(rows, key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default))).select(
        *df.columns, value
    )


def exclude_category(df: DataFrame, column: str, category: str) -> DataFrame:
    """SQL's ``column <> category``: rows with a NULL there go too."""
    return df.where(F.col(column) != category)


def union_origin(facts: Mapping[str, DataFrame], origin: str = "origem") -> DataFrame:
    """UNION ALL of facts by column name, each row marked with where it came from."""
    marked = [df.select(F.lit(name).alias(origin), "*") for name, df in facts.items()]
    return reduce(DataFrame.unionByName, marked)

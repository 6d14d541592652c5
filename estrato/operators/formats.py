"""One date format for each column of a dataset, chosen by what its cells say."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.functions.dates import DATE_FORMATS
from estrato.functions.text import strip
from estrato.session import written

Formats = Mapping[str, Callable[[Column], Column]]


def format_counts(df: DataFrame, by: str, columns: Sequence[str], formats: Formats = DATE_FORMATS) -> DataFrame:
    """``(by, column, filled, counts)``: the filled cells of each column and how many of them each
    format reads, as an array in the order of ``formats``; from one aggregate over the rows."""
    sums = []
    for i, c in enumerate(columns):
        cell = F.col(f"`{c}`")
        sums.append(F.count_if(F.coalesce(strip(cell), F.lit("")) != "").alias(f"_{i}"))
        sums += [F.count_if(read(cell).isNotNull()).alias(f"_{i}_{j}") for j, read in enumerate(formats.values())]
    wide = df.groupBy(by).agg(*sums)
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"_{i}").alias("filled"),
            F.array(*[F.col(f"_{i}_{j}") for j in range(len(formats))]).alias("counts"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(by, F.explode(F.array(*cells)).alias("_c")).select(by, "_c.*")


def chosen_formats(counts: DataFrame, by: str, formats: Formats = DATE_FORMATS) -> DataFrame:
    """``(by, column, format, filled, unread)``: the format that reads the most cells of a column,
    of equals the first, NULL if none reads any; and the filled cells that it doesn't read."""
    most = F.array_max("counts")
    named = F.element_at(F.array(*map(F.lit, formats)), F.array_position("counts", most).cast("int"))
    return counts.select(
        by, "column", F.when(most > 0, named).alias("format"), "filled", (F.col("filled") - most).alias("unread")
    )


def with_formats(
    df: DataFrame, by: str, columns: Sequence[str], chosen: DataFrame, formats: Formats = DATE_FORMATS
) -> DataFrame:
    """``df`` with the cells of the columns read by the chosen format of their dataset, NULL where
    it doesn't read them.  The choices are one row for each dataset, written so that their size is
    known to the join."""
    entries = F.map_from_entries(F.collect_list(F.struct("column", "format")))
    maps = written(chosen.where("format is not null").groupBy(by).agg(entries.alias("_formats")), "formats")

    def read(c: str) -> Column:
        named = F.col("_formats")[c]
        return F.coalesce(*[F.when(named == name, f(F.col(f"`{c}`"))) for name, f in formats.items()])

    joined = df.join(maps, by, "left")
    return joined.select(*[read(c).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])

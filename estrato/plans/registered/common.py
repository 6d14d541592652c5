"""Helpers of the registered queries."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_TS = datetime(2025, 1, 1, tzinfo=UTC)
RUN_MICROS = 1735689600000000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Dates, wall clocks and decimals as text, instants as microseconds: the same in
    every engine and time zone."""

    def column(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            return F.unix_micros(c).alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.DecimalType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[column(f) for f in df.schema.fields])


def cents(c: Column | str) -> Column:
    """A price with two decimals as whole cents."""
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("long")


def cents_sql(c: str) -> str:
    return f"cast(round({c} * 100) as bigint)"


def money(c: Column | str) -> Column:
    return (cents(c).cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def br_text(c: Column) -> Column:
    """Cents as Brazilian text, ``1.234,56``."""
    whole = F.replace(F.format_number((c - c % 100) / 100, 0), F.lit(","), F.lit("."))
    return F.concat(whole, F.lit(","), F.lpad((c % 100).cast("string"), 2, "0"))


def money_sql(c: str) -> str:
    """Cents as plain decimal text, ``1234.56``."""
    return f"concat(cast({c} // 100 as varchar), '.', lpad(cast({c} % 100 as varchar), 2, '0'))"


def pick(by: Column, *cases: Column) -> Column:
    """The case numbered by ``by`` modulo the number of cases: varied input text."""
    out = F.lit(None)
    for i, value in reversed(list(enumerate(cases))):
        out = F.when(F.pmod(by, F.lit(len(cases))) == i, value).otherwise(out)
    return out


def pick_sql(by: str, *cases: str) -> str:
    arms = " ".join(f"when {i} then {value}" for i, value in enumerate(cases))
    return f"case {by} % {len(cases)} {arms} end"

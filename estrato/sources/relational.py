"""Tables of a relational source, read in parallel through JDBC.

The driver jar and the connection come from the caller.  Filters on the returned
DataFrame (date ranges, ``id > watermark``, IN lists) are pushed to the source, and
so are column selections; the joins of the extracts are DataFrame joins and run on
any source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    connection: Mapping[str, str],
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a split column the table is read in ranges of it."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    if split_column:
        if bounds is None:
            raise ValueError("a split column needs its lower and upper bound")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def terminal_ids(text: str) -> list[int]:
    """Numbers of a comma list; blanks between commas are skipped, none is an error."""
    ids = [int(part) for part in text.split(",") if part.strip()]
    if not ids:
        raise ValueError("no terminal id given")
    return ids

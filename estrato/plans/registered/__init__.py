"""The queries a driver runs by name, each with the same question in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, tuple[Query, str | None]]:
    from estrato.plans.registered import (
        access, files, loads, relational, reports, scalars, weather,
    )

    out: dict[str, tuple[Query, str | None]] = {}
    for module in (scalars, relational, loads, reports, files, access, weather):
        for name, entry in module.QUERIES.items():
            if name in out:
                raise ValueError(f"two queries are named {name}")
            out[name] = entry
    return out

"""Schemas of the loads of an appended table, kept beside them.

``<table>/_schemas/<hash>.json`` holds a schema, the empty file ``<table>/_schemas/<hash>/batch=<id>``
says which load has it.  A listing and one small file for each different schema tell what a
table of any number of loads holds, without a look into the data files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from estrato.sources.paths import matching, read_text, removed, write_text

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def plain_schema(schema: T.StructType) -> T.StructType:
    """Names and types alone."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def same_types(a: T.StructType, b: T.StructType) -> bool:
    """Whether two schemas have the same columns, in any order."""
    return {f.name: f.dataType for f in a.fields} == {f.name: f.dataType for f in b.fields}


def keep_schema(df: DataFrame, path: str, batch: str) -> None:
    spark, text = df.sparkSession, plain_schema(df.schema).json()
    name = hashlib.sha256(text.encode()).hexdigest()[:16]
    mark = f"{path}/_schemas/{name}/batch={batch}"
    there = matching(spark, f"{path}/_schemas/*/batch={batch}")
    if not any(p.endswith(mark.rsplit("/_schemas/", 1)[1]) for p in there):
        write_text(spark, f"{path}/_schemas/{name}.json", text)
        write_text(spark, mark, "")
    for old in there:  # the load had another schema before
        if not old.endswith(mark.rsplit("/_schemas/", 1)[1]):
            removed(spark, old)


def kept_schemas(spark: SparkSession, path: str) -> dict[T.StructType, list[str]]:
    """The different schemas of the loads, first seen first, and the loads that have each."""
    loads: dict[str, list[str]] = {}
    for mark in matching(spark, f"{path}/_schemas/*/batch=*"):
        name, batch = mark.rsplit("/", 2)[1:]
        loads.setdefault(name, []).append(batch.split("=", 1)[1])
    texts = {name: read_text(spark, f"{path}/_schemas/{name}.json") for name in loads}
    order = sorted(loads, key=lambda name: (min(loads[name]), name))
    return {T.StructType.fromJson(_json(texts[name])): sorted(loads[name]) for name in order}


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def wider(a: T.DataType, b: T.DataType, column: str) -> T.DataType:
    """The least type that holds all values of both; an error where there is none.

    byte < short < int < long < decimal; a decimal takes the larger number of digits on either
    side of its point, at most 38 in all; float < double, and whole numbers up to int go into a
    double; date < timestamp without time zone; NULL goes into any type.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE[type(t)])
    if all(isinstance(t, T.DecimalType) or type(t) in _WHOLE for t in (a, b)):
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _WHOLE[type(t)] for t in (a, b))
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    elif kinds <= {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    elif T.DoubleType in kinds and kinds <= {T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    elif kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    raise TypeError(f"{column}: no type holds both {a.simpleString()} and {b.simpleString()}")


def widened(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas in the order in which they first appear, each as wide as needed."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            types[f.name] = wider(types[f.name], f.dataType, f.name) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])

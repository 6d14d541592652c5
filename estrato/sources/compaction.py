"""Few files instead of the many small ones of an appended table's loads.

Loads below a target size are packed together, first fit by falling size, each bin one file
that holds the load as a column; the files lie in a folder of their own below ``_compacted``,
and a small text names the folders and the loads that are read from them.  That text is put in
place last and at once, and the old files stay: a reader takes either the loads or the files
that replace them, never both.  A load that is written again counts as it is then.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.sources.paths import any_match, folder_bytes, matching, read_text, removed, write_text

TARGET_BYTES = 128 << 20
BATCH = T.StructField("batch", T.StringType())


def _state(spark: SparkSession, path: str) -> dict:
    """``folders``: the loads in each folder of packed files; ``again``: those written after it."""
    if not any_match(spark, f"{path}/_compacted/current"):
        return {"folders": {}, "again": []}
    return json.loads(read_text(spark, f"{path}/_compacted/current"))


def packed_loads(spark: SparkSession, path: str) -> list[str]:
    """The loads that are read from packed files."""
    state = _state(spark, path)
    return sorted({b for loads in state["folders"].values() for b in loads} - set(state["again"]))


def read_loads(spark: SparkSession, path: str, fields: Sequence[T.StructField], batches: Sequence[str] | None = None) -> DataFrame:
    """``fields`` and ``batch`` of an appended table, of some loads if they are given: a partition
    filter for loads in folders of their own, a filter by statistics for packed ones."""
    read = T.StructType([*[f for f in fields if f.name != "batch"], BATCH])
    state = _state(spark, path)
    rows = spark.read.schema(read).parquet(path).select(*read.names)
    if batches is not None:
        rows = rows.where(F.col("batch").isin(list(batches)))
    packed = packed_loads(spark, path)
    if not packed:
        return rows
    rows = rows.where(~F.col("batch").isin(packed))
    wanted = set(packed) & (set(packed) if batches is None else set(batches))
    for folder, loads in state["folders"].items():  # one for each compaction
        mine = sorted(wanted & set(loads))
        if mine:
            files = spark.read.schema(read).parquet(f"{path}/{folder}").select(*read.names)
            rows = rows.unionByName(files.where(F.col("batch").isin(mine)))
    return rows


def bins_of(sizes: dict[str, int], target: int) -> dict[str, int]:
    """The bin of each load: first fit by falling size, at most ``target`` bytes in a bin."""
    room: list[int] = []
    out: dict[str, int] = {}
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        fits = next((i for i, r in enumerate(room) if r >= sizes[name]), len(room))
        if fits == len(room):
            room.append(target)
        room[fits] -= sizes[name]
        out[name] = fits
    return out


def compact(spark: SparkSession, path: str, fields: Sequence[T.StructField], target_bytes: int = TARGET_BYTES) -> int:
    """Pack the loads below ``target_bytes`` that aren't packed yet; returns the files they become.

    ``fields`` are all columns, those of inner folders too.  Sizes come from a listing.
    """
    done = set(packed_loads(spark, path))
    loads = [p.rsplit("/", 2)[1].split("=", 1)[1] for p in matching(spark, f"{path}/batch=*/_SUCCESS")]
    sizes = {b: folder_bytes(spark, f"{path}/batch={b}") for b in loads if b not in done}
    bins = bins_of({b: n for b, n in sizes.items() if n < target_bytes}, target_bytes)
    if len(bins) < 2:
        return 0
    named = spark.createDataFrame(list(bins.items()), "batch string, _bin int")  # a row for each load
    count = max(bins.values()) + 1
    rows = read_loads(spark, path, fields, list(bins)).join(F.broadcast(named), "batch")
    folder = f"_compacted/{uuid.uuid4().hex}"
    dealt = rows.repartitionById(count, "_bin").sortWithinPartitions("batch").drop("_bin")
    dealt.write.parquet(f"{path}/{folder}")
    state = _state(spark, path)
    state["folders"][folder] = sorted(bins)
    state["again"] = sorted(set(state["again"]) - set(bins))
    # a load that was packed before and written again is taken from its newest files alone
    for other in state["folders"]:
        if other != folder:
            state["folders"][other] = sorted(set(state["folders"][other]) - set(bins))
    write_text(spark, f"{path}/_compacted/current", json.dumps(state))
    return count


def written_again(spark: SparkSession, path: str, batch: str) -> None:
    """Note that a load has new files of its own."""
    state = _state(spark, path)
    if any(batch in loads for loads in state["folders"].values()) and batch not in state["again"]:
        state["again"] = sorted([*state["again"], batch])
        write_text(spark, f"{path}/_compacted/current", json.dumps(state))


def remove_replaced(spark: SparkSession, path: str) -> None:
    """Remove the files of packed loads, when no reader needs them any more; their markers stay."""
    for batch in packed_loads(spark, path):
        for pattern in ("*.parquet", "*=*"):
            for file in matching(spark, f"{path}/batch={batch}/{pattern}"):
                removed(spark, file)

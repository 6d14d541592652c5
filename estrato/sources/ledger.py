"""The ledger of a layered load: which folder of a layer was made from which folders below it.

A row links a folder of a layer to one folder it was made from, each in the version in which it
was written.  A folder counts as long as all it was made from is still there in that version; a
run joins the ledger before it looks at any data, and reads only folders that the layer lacks.
So work goes with the new batch, not with the history; a folder that is deleted, or whose
source was written again, is made anew by the next run, and so is what was made from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato.session import written
from estrato.sources.compaction import read_loads
from estrato.sources.paths import matching
from estrato.sources.tables import read_current, write_version

ROWS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("layer", "folder", "version")]
    + [T.StructField("rows", T.LongType()), T.StructField("done", T.TimestampType())]
    + [T.StructField(n, T.StringType()) for n in ("source_layer", "source_folder", "source_version")]
)


SOURCE = ["source_layer", "source_folder", "source_version"]


@dataclass(frozen=True)
class Todo:
    """What a layer lacks: (folder, version) of each source layer; and the rows that count."""

    layer: str
    folder: str
    lacking: dict[str, list[tuple[str, str]]]
    kept: DataFrame

    def folders(self, source: str) -> list[str]:
        return [folder for folder, _ in self.lacking[source]]


class Ledger:
    """The ledger below ``path`` of layers whose tables are at ``tables[layer]``.

    Layers are done from the lowest up.  Rows of folders that no longer count leave the
    ledger when their layer is recorded, so that the layer above sees it.
    """

    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, str]):
        self.spark, self.path, self.tables = spark, path, tables

    def rows(self, *layers: str) -> DataFrame:
        """The rows of some layers whose folders are there."""
        found = [
            (layer, marker.split("/batch=")[1].split("/")[0])
            for layer in layers
            for marker in matching(self.spark, f"{self.tables[layer]}/batch=*/_SUCCESS")
        ]
        there = self.spark.createDataFrame(found, "layer string, folder string")
        return read_current(self.spark, self.path, ROWS).join(there, ["layer", "folder"], "left_semi").select(*ROWS.names)

    def todo(self, layer: str, folder: str, sources: Sequence[str] = ()) -> Todo:
        """What a run that writes ``folder`` of ``layer`` has to read.

        What the folder was made from before counts as lacking, since the run replaces it.
        """
        rows = self.rows(layer, *sources)
        below = rows.where(F.col("layer").isin(list(sources))).select(
            F.col("layer").alias("source_layer"), F.col("folder").alias("source_folder"), F.col("version").alias("source_version")
        )
        below = below.distinct()
        mine = rows.where((F.col("layer") == layer) & (F.col("folder") != folder))
        stale = mine.where("source_layer is not null").join(below, SOURCE, "left_anti")
        kept = written(mine.join(stale.select("folder").distinct(), "folder", "left_anti").select(*ROWS.names), "ledger")
        out: dict[str, list[tuple[str, str]]] = {s: [] for s in sources}
        for r in below.join(kept.select(*SOURCE), SOURCE, "left_anti").collect():  # a name for each new folder
            out[r.source_layer].append((r.source_folder, r.source_version))
        return Todo(layer, folder, {s: sorted(found) for s, found in out.items()}, kept)

    def record(self, todo: Todo, rows: int, done: datetime) -> None:
        """Note that the folder is written.

        The note comes after the rows: a run that fails in between is not noted, and the
        next one writes the folder again.
        """
        version = uuid.uuid4().hex
        links = [(s, f, v) for s, found in todo.lacking.items() for f, v in found] or [(None, None, None)]
        new = [(todo.layer, todo.folder, version, rows, done, *link) for link in links]
        others = read_current(self.spark, self.path, ROWS).where(F.col("layer") != todo.layer)
        write_version(others.unionByName(todo.kept).unionByName(self.spark.createDataFrame(new, ROWS)), self.path)

    def folders(self, layer: str) -> list[str]:
        """The folders of a recorded layer that count: as many names as Spark's own listing has."""
        return sorted(r.folder for r in self.rows(layer).select("folder").distinct().collect())


def read_folders(spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
    """The rows of some folders of an appended table: a partition filter on ``batch``."""
    if not folders:
        return spark.createDataFrame([], schema)
    return read_loads(spark, path, schema.fields, folders).select(*schema.names)

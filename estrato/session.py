"""Sessions for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
INPUT_PARTITIONS = "spark.estrato.inputPartitions"
#: Tasks for each core that a table is dealt to where the session doesn't say.
DEALT = 4


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("estrato")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config(INPUT_PARTITIONS, "8" if cores == "*" else str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster names for checkpoints.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not base:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="estrato-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/estrato/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` by a Parquet table in the shared folder.

    Unlike a row checkpoint, the table keeps column pruning and filter pushdown
    for the plans that read it more than once, and it outlives lost executors.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a table out before costly work per row.

    A table of one file, or of files with few row groups, is read by few tasks however many
    cores there are; its rows are dealt to several tasks for each core.  The local sessions of
    tests and the bench say how many.
    """
    spark = df.sparkSession
    parts = spark.conf.get(INPUT_PARTITIONS, None) or DEALT * spark.sparkContext.defaultParallelism
    return df.repartition(int(parts))

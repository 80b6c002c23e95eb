"""Session, table access and the shared folder for intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("manualmill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); one of our own only where none is set and all tasks run in this very process, as in tests."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="manualmill-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a step to the shared folder and read it back: cuts the lineage and survives the loss of an executor.

    The folder is that of the application's checkpoints; whoever owns ``spark.checkpoint.dir`` clears it.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unpacked(df: DataFrame) -> DataFrame:
    """A table that is one single file of few row groups, over all cores before work in Python; tables of several files stay as they are, whatever their size.

    One row group is read by one task, which no setting changes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores and len(df.inputFiles()) == 1 else df

"""Incremental ingestion and windows over file streams.

Extensions: the batch operators are what the flow needs; these let a corpus grow without
rebuilding it. Every run takes what has arrived since the last one (``availableNow``) and
keeps its place in the shared folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.session import shared_dir


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream over a parquet table that is a folder of files or one file."""
    batch = spark.read.parquet(path)
    files = batch.inputFiles()
    name = os.path.basename(path)
    reader = spark.readStream.schema(batch.schema)
    if len(files) == 1 and files[0].rstrip("/").endswith("/" + name):
        return reader.option("pathGlobFilter", name).parquet(os.path.dirname(path))
    return reader.parquet(path)


def run_available(stream: DataFrame, mode: str, name: str, place: str | None = None) -> DataFrame:
    """Process what is there and return the sink's rows. ``place``: folder of sink and checkpoint; given again, it goes on from there."""
    spark = stream.sparkSession
    place = place or os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    out = os.path.join(place, "rows")
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", out).outputMode("append")
    else:
        writer = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out))
    query = writer.option("checkpointLocation", os.path.join(place, "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def new_items(stream: DataFrame, key: str, at: str, late: str = "3650 days") -> DataFrame:
    """Each key once, however often it is delivered within the watermark."""
    return stream.filter(F.col(key).isNotNull()).withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def tumbling_counts(events: DataFrame, at: str, kind: str, value: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and summed values per window and kind; with the watermark, windows close and their state is dropped."""
    e = events.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", late)
    g = e.groupBy(F.window("__at", width), kind).agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total"))
    return g.select(F.col("window.start").alias("start"), kind, "events", "total")

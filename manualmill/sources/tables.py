"""Writing stage tables: parquet, JSON lines, and resumable appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_stage(df: DataFrame, path: str, *, cluster_by: str | None = None, files: int | None = None) -> None:
    """Overwrite a stage. ``cluster_by`` sorts rows into ranges of a key, so that a lookup by it skips most row groups."""
    out = df if cluster_by is None else (df.repartitionByRange(files, cluster_by) if files else df.repartitionByRange(cluster_by)).sortWithinPartitions(cluster_by)
    out.write.mode("overwrite").parquet(path)


def append_new(df: DataFrame, done: DataFrame | None, path: str, key: str) -> None:
    """Append the rows whose key is not there yet; running it again adds nothing."""
    (df if done is None else df.join(done.select(key), key, "left_anti")).write.mode("append").parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def upsert(old: DataFrame | None, new: DataFrame, path: str, key: str, *, order: tuple[str, ...] = (), ties: tuple[str, ...] = (), buckets: int = 256) -> None:
    """Write the rows of ``old`` whose key is not in ``new``, and the last row of each key of ``new``, to ``path``, which must not be where ``old`` lies.

    Rows lie in hash ranges of their key, so the next upsert and lookups by key touch few files. Rows with a null key are left out.
    """
    last = new.filter(F.col(key).isNotNull())
    w = Window.partitionBy(key).orderBy(*(F.desc_nulls_last(c) for c in order), F.desc(F.xxhash64(*(ties or new.columns))))
    last = last.withColumn("__place", F.row_number().over(w)).filter("__place = 1").drop("__place")
    whole = last if old is None else old.filter(F.col(key).isNotNull()).join(last.select(key), key, "left_anti").unionByName(last)
    whole.withColumn("key_range", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).repartition("key_range").sortWithinPartitions("key_range", key).write.mode("overwrite").partitionBy("key_range").parquet(path)


def lookup(spark: SparkSession, path: str, key: str, values: list, buckets: int = 256) -> DataFrame:
    """The rows of an upserted table with one of a few keys, from their ranges only."""
    if not values:
        return spark.read.parquet(path).limit(0).drop("key_range")
    ranges = spark.createDataFrame([(v,) for v in values], f"k {dict(spark.read.parquet(path).dtypes)[key]}").select(F.pmod(F.xxhash64("k"), F.lit(buckets)).cast("int").alias("r")).distinct().collect()  # a few keys
    return spark.read.parquet(path).filter(F.col("key_range").isin([r.r for r in ranges]) & F.col(key).isin(values)).drop("key_range")


def progress(done: DataFrame, total: DataFrame, key: str) -> DataFrame:
    """A single row: items, finished ones, their share."""
    n = total.select(key).distinct().join(done.select(key).distinct().withColumn("finished", F.lit(1)), key, "left")
    return n.agg(F.count(F.lit(1)).alias("items"), F.count("finished").alias("finished")).withColumn("share", F.round(F.coalesce(F.try_divide("finished", "items"), F.lit(1.0)), 6))

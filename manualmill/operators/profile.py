"""Profiles of a corpus: counts, histograms, order statistics, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES_BUCKETS = [(1, "1"), (3, "2-3"), (5, "4-5"), (10, "6-10"), (50, "11-50")]


def bucket(n: Column) -> Column:
    out = None
    for top, name in SERIES_BUCKETS:
        out = F.when(n <= top, name) if out is None else out.when(n <= top, name)
    return out.otherwise("51+")


def order_statistics(df: DataFrame, group: str, value: str) -> DataFrame:
    """min, upper median, mean rounded down, 95th percentile by position, max; null values do not count.

    Positions are looked up among the counted distinct values, so a group of any size is
    one row per distinct value: partial counts first, then a window over those.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(group).alias("grp"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("grp").orderBy("v")
    every = Window.partitionBy("grp")
    at = counts.select("grp", "v", "c", F.sum("c").over(upto).alias("upto"), F.sum("c").over(every).alias("n"))
    pick = lambda pos: F.min(F.when(F.col("upto") > pos, F.col("v")))
    return at.groupBy("grp").agg(
        F.first("n").alias("n"), F.min("v").alias("min"), pick(F.floor(F.col("n") / 2)).alias("median"),
        F.floor(F.sum(F.col("v") * F.col("c")) / F.sum("c")).cast("long").alias("mean"), pick(F.floor(F.col("n") * 0.95)).alias("p95"), F.max("v").alias("max"),
    ).withColumnRenamed("grp", group)


def coverage(df: DataFrame, lists: list[str], flags: list[str]) -> DataFrame:
    """(field, filled, share) for list fields that are not empty and flags that are true."""
    filled = {**{c: F.count_if(F.size(c) > 0) for c in lists}, **{c: F.count_if(F.col(c)) for c in flags}}
    one = df.agg(F.count(F.lit(1)).alias("n"), *(v.alias(k) for k, v in filled.items()))
    pairs = ", ".join(f"'{k}', `{k}`" for k in filled)
    return one.selectExpr("n", f"stack({len(filled)}, {pairs}) AS (field, filled)").select("field", "filled", F.round(F.try_divide(F.col("filled").cast("double"), F.col("n")), 4).alias("share"))

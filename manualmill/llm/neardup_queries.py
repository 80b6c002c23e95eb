"""Queries of problem 3 with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.llm.neardup import NearDuplicates, Similarity, item_groups, item_pairs, near_duplicates
from manualmill.session import table

SIMILARITY = Similarity()


def _found(spark: SparkSession, d: str) -> NearDuplicates:
    return near_duplicates(table(spark, d, "canonical_ius_enriched"), "canonical_id", "content_md", SIMILARITY)


def found(spark: SparkSession, d: str) -> DataFrame:
    return item_pairs(_found(spark, d)).select(F.col("item_a").alias("canonical_id_a"), F.col("item_b").alias("canonical_id_b"))


def groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per unit; the group is named by its smallest canonical_id."""
    g = item_groups(_found(spark, d))
    name = g.groupBy("group_id").agg(F.min("item_id").alias("group_name"), F.count(F.lit(1)).alias("units"))
    return g.join(name, "group_id").select(F.col("item_id").alias("canonical_id"), "group_name", "units", "links")


QUERIES = {"p3_found": found, "p3_groups": groups}
SQL = {
    "p3_found": r"""
    WITH t AS (SELECT DISTINCT canonical_id, unnest(string_split_regex(content_md, '[\s\p{Z}\x0b\x1c-\x1f\x85]+')) AS w FROM canonical_ius_enriched WHERE content_md IS NOT NULL),
    s AS (SELECT canonical_id, w FROM t WHERE w <> ''),
    n AS (SELECT canonical_id, count(*) AS n FROM s GROUP BY 1 HAVING count(*) >= 30),
    u AS (SELECT canonical_id, w, n FROM s JOIN n USING (canonical_id))
    SELECT a.canonical_id AS canonical_id_a, b.canonical_id AS canonical_id_b FROM u a JOIN u b ON a.w = b.w AND a.canonical_id < b.canonical_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
    GROUP BY 1, 2, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))"""
}

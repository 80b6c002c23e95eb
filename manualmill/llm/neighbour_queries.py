"""Queries of problem 2 with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.llm.neighbours import Search, neighbours
from manualmill.session import table

SEARCH = Search(dim=64, k=5, min_cosine=0.90)
NEAREST = Search(dim=64, k=5, whole=True)


def nearest(spark: SparkSession, d: str) -> DataFrame:
    out = neighbours(table(spark, d, "chunk_embeddings"), "chunk_id", "embedding", "embedded_at", NEAREST)
    return out.select(F.col("item_id").alias("chunk_id"), "rank", F.col("neighbour_id").alias("neighbour"), F.round("cosine", 6).alias("cosine"))


def found(spark: SparkSession, d: str) -> DataFrame:
    near = neighbours(table(spark, d, "chunk_embeddings"), "chunk_id", "embedding", "embedded_at", SEARCH)
    return near.select(F.least("item_id", "neighbour_id").alias("chunk_id_a"), F.greatest("item_id", "neighbour_id").alias("chunk_id_b")).distinct()


QUERIES = {"p2_found": found, "p2_neighbours": nearest}
SQL = {
    "p2_found": """
    WITH v AS (SELECT chunk_id, arg_max(embedding, embedded_at)::DOUBLE[] AS e FROM chunk_embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 GROUP BY chunk_id),
    p AS (SELECT a.chunk_id AS a, b.chunk_id AS b, list_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.chunk_id <> b.chunk_id),
    r AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS r FROM p WHERE c >= 0.90)
    SELECT DISTINCT least(a, b) AS chunk_id_a, greatest(a, b) AS chunk_id_b FROM r WHERE r <= 5"""
}

"""Queries of problem 4 with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.llm.splitting import Limits, oversized, split, split_oversized
from manualmill.session import table, unpacked

LIMITS = Limits(max_tokens=2000, overlap_chars=200)


def _items(spark: SparkSession, d: str):
    yield "canonical_ius_enriched", table(spark, d, "canonical_ius_enriched"), "canonical_id", "content_md"
    yield "chunks", table(spark, d, "chunks"), "chunk_id", "text"


def found(spark: SparkSession, d: str) -> DataFrame:
    """Rows delivered twice are cut twice here, which is cheaper than a shuffle of all long texts; the ids are distinct."""
    out = None
    for name, df, item, text in _items(spark, d):
        src = df.select(F.col(item).alias("item_id"), F.col(text).alias("whole"), F.floor(F.length(text) / 4).cast("int").alias("size"))
        one = oversized(split_oversized(unpacked(src), LIMITS)).select(F.lit(name).alias("table_name"), "item_id")
        out = one if out is None else out.unionByName(one)
    return out


def pieces(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, df, item, text in _items(spark, d):
        one = split(df, F.col(item), F.col(text), LIMITS).select(F.lit(name).alias("table_name"), "item_id", "piece", "pieces", "start", "core_start", "end", "cut_at", "text")
        out = one if out is None else out.unionByName(one)
    return out


def report(spark: SparkSession, d: str) -> DataFrame:
    return pieces(spark, d).groupBy("table_name", "cut_at").agg(F.count(F.lit(1)).alias("n_pieces"), F.max(F.length("text")).alias("longest"), F.sum(F.col("core_start") - F.col("start")).alias("overlap_chars"))


def whole(spark: SparkSession, d: str) -> DataFrame:
    """Per item with one text: digest of its pieces put together again without their overlap, whether all are within the limit, the overlap is as wanted, and it was cut at all."""
    p = pieces(spark, d).filter("item_id IS NOT NULL")
    core = F.expr("substring(text, core_start - start + 1, end - core_start)")
    g = p.groupBy("table_name", "item_id", "pieces").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", core.alias("core")))), lambda x: x["core"]), "").cast("binary")).alias("digest"),
        F.bool_and(F.length("text") <= LIMITS.max_chars).alias("fits"),
        F.bool_and((F.col("core_start") - F.col("start")).between(0, LIMITS.overlap_chars) & ((F.col("piece") == 0) == (F.col("core_start") == 0))).alias("overlaps"),
        F.max("end").alias("chars"),
    )
    return g.select("table_name", "item_id", "digest", "fits", "overlaps", (F.col("pieces") > 1).alias("cut"), F.col("chars").cast("long").alias("chars"))


QUERIES = {"p4_found": found, "p4_pieces": pieces, "p4_report": report, "p4_whole": whole}
SQL = {
    "p4_whole": """SELECT DISTINCT 'canonical_ius_enriched' AS table_name, canonical_id AS item_id, md5(content_md) AS digest, true AS fits, true AS overlaps, length(content_md) // 4 > 2000 AS cut, length(content_md) AS chars FROM canonical_ius_enriched WHERE content_md IS NOT NULL
      UNION ALL SELECT DISTINCT 'chunks', chunk_id, md5(text), true, true, length(text) // 4 > 2000, length(text) FROM chunks WHERE text IS NOT NULL AND chunk_id IS NOT NULL""",
    "p4_found": """SELECT DISTINCT 'canonical_ius_enriched' AS table_name, canonical_id AS item_id FROM canonical_ius_enriched WHERE length(content_md) // 4 > 2000
      UNION ALL SELECT DISTINCT 'chunks', chunk_id FROM chunks WHERE length(text) // 4 > 2000""",
}

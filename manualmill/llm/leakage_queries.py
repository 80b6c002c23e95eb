"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.llm.leakage import Retrieval, leaks
from manualmill.session import table

RETRIEVAL = Retrieval()


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "passage", RETRIEVAL)


def found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).filter("kind = 'copied'").select("doc_id", "item_id")


def report(spark: SparkSession, d: str) -> DataFrame:
    """Every affected document with its items, copied or paraphrased."""
    return _leaks(spark, d).select("doc_id", "item_id", "kind", "run", F.round("lcs", 4).alias("lcs"), F.round("answer", 4).alias("answer"))


QUERIES = {"p7_found": found, "p7_leaks": report}
SQL: dict[str, str] = {
    "p7_found": r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(lower(regexp_replace(text, '[\x{00AD}\x{180E}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}]', '', 'g')), '[\p{L}\p{N}]+') AS w FROM documents),
    i AS (SELECT item_id, regexp_extract_all(lower(regexp_replace(passage, '[\x{00AD}\x{180E}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}]', '', 'g')), '[\p{L}\p{N}]+') AS w FROM eval_items),
    dg AS (SELECT doc_id, list_aggregate(w[p : p + 12], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS p FROM d)),
    ig AS (SELECT item_id, list_aggregate(w[p : p + 12], 'string_agg', ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 12)) AS p FROM i))
    SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)"""
}

"""Queries of problem 5 with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.operators import orphans as O
from manualmill.session import table


def _references(spark: SparkSession, d: str) -> list[DataFrame]:
    units = table(spark, d, "canonical_ius_enriched").select("loaded_at", F.explode("iu_cross_references.ifsid").alias("ifsid"))
    return [
        O.reference_deltas("iu_tt_applicability", table(spark, d, "iu_tt_applicability"), F.col("iu_miuid"), F.col("loaded_at")),
        O.reference_deltas("chunks", table(spark, d, "chunks"), F.col("canonical_iu_id"), F.col("loaded_at")),
        O.reference_deltas("canonical_ius_enriched", units, F.col("ifsid"), F.col("loaded_at")),
    ]


def _records(spark: SparkSession, d: str) -> DataFrame:
    return O.record_deltas(table(spark, d, "canonical_ius_enriched"), "canonical_id", "loaded_at", "deleted_at")


def report(spark: SparkSession, d: str) -> DataFrame:
    return O.orphan_report(_references(spark, d), _records(spark, d))


def found(spark: SparkSession, d: str) -> DataFrame:
    return report(spark, d).select("table_name", "period", "ref_key", "reason")


def per_period(spark: SparkSession, d: str) -> DataFrame:
    return report(spark, d).groupBy("table_name", "period", "reason").agg(F.count(F.lit(1)).alias("ref_keys"), F.sum("refs").alias("refs"))


def current(spark: SparkSession, d: str) -> DataFrame:
    """The state after two batches of deltas: those of the first half year, then the rest."""
    refs = _references(spark, d)
    deltas = refs[0].unionByName(refs[1]).unionByName(refs[2]).unionByName(_records(spark, d))
    cut = 1_751_328_000_000_000
    return O.current_orphans(O.apply_deltas(O.apply_deltas(None, deltas.filter(F.col("at") < cut)), deltas.filter(F.col("at") >= cut)))


_BARE = r"upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(k, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '(?s)^.*[/\\]', ''), '(?i)\.xml$', ''), '[^\p{L}\p{N}]', '', 'g'))"
_REFS = rf"""
WITH raw AS (
  SELECT 'iu_tt_applicability' AS table_name, iu_miuid AS k, loaded_at AS t FROM iu_tt_applicability
  UNION ALL SELECT 'chunks', canonical_iu_id, loaded_at FROM chunks
  UNION ALL SELECT 'canonical_ius_enriched', x.ifsid, loaded_at FROM (SELECT loaded_at, unnest(iu_cross_references) AS x FROM canonical_ius_enriched)
), refs AS (
  SELECT table_name, t, CASE WHEN regexp_matches(b, '^IU[0-9]+V[0-9]+$') THEN regexp_replace(b, 'V([0-9]+)$', '_v\1') ELSE b END AS key
  FROM (SELECT table_name, t, {_BARE} AS b FROM raw) WHERE b <> ''
), recs AS (
  SELECT canonical_id AS key, loaded_at, deleted_at FROM canonical_ius_enriched
  UNION ALL SELECT regexp_replace(canonical_id, '_v[0-9]+$', ''), loaded_at, deleted_at FROM canonical_ius_enriched WHERE regexp_matches(canonical_id, '_v[0-9]+$')
), judged AS (
  SELECT r.table_name, r.t, r.key, count(e.key) AS ever, count(*) FILTER (WHERE e.loaded_at <= r.t) AS loads,
         count(*) FILTER (WHERE e.loaded_at <= r.t AND (e.deleted_at IS NULL OR e.deleted_at > r.t)) AS live, any_value(r.n) AS n
  FROM (SELECT table_name, t, key, count(*) AS n FROM refs GROUP BY ALL) r LEFT JOIN recs e ON e.key = r.key GROUP BY r.table_name, r.t, r.key
), report AS (
  SELECT table_name, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS period, key AS ref_key,
         CASE WHEN ever = 0 THEN 'missing' WHEN loads = 0 THEN 'late' ELSE 'deleted' END AS reason, CAST(sum(n) AS BIGINT) AS refs
  FROM judged WHERE live = 0 GROUP BY ALL
)"""

QUERIES = {"p5_found": found, "p5_per_period": per_period, "p5_current": current}
SQL = {
    "p5_found": _REFS + " SELECT table_name, period, ref_key, reason FROM report",
    "p5_per_period": _REFS + " SELECT table_name, period, reason, count(*) AS ref_keys, CAST(sum(refs) AS BIGINT) AS refs FROM report GROUP BY ALL",
    "p5_current": _REFS
    + """, now AS (SELECT key, count(*) AS loads, count(*) FILTER (WHERE deleted_at IS NULL) AS live FROM recs GROUP BY key)
    SELECT r.table_name, r.key AS ref_key, count(*) AS refs, CASE WHEN coalesce(max(n.loads), 0) > 0 THEN 'deleted' ELSE 'missing' END AS reason
    FROM refs r LEFT JOIN now n ON n.key = r.key WHERE coalesce(n.live, 0) <= 0 GROUP BY r.table_name, r.key""",
}

"""Queries of problem 1 with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.functions.ids import trim_white, unit_key
from manualmill.llm.representatives import FieldRule, groups, suppliers, survivors
from manualmill.session import table

SERIES = r"^[A-Za-z]\.[A-Za-z]\.[0-9]{2}\.[0-9]{3}$"


def _key():
    return unit_key(F.col("canonical_id"))


def _pairs():
    """Distinct (series, filepath) of the appearances, both trimmed and not blank."""
    clean = F.transform(F.coalesce(F.col("appearances"), F.array()), lambda a: F.struct(trim_white(a["series"]).alias("series"), trim_white(a["filepath"]).alias("filepath")))
    return F.array_distinct(F.filter(clean, lambda a: (a["series"] != "") & (a["filepath"] != "")))


def rules() -> list[FieldRule]:
    series = trim_white(F.col("source_series"))
    return [
        FieldRule("variant_count", F.col("variant_count"), F.col("variant_count").between(1, 99)),
        FieldRule("source_series", F.upper(series), series.rlike(SERIES)),
        FieldRule("appearances", F.array_sort(_pairs()), F.size(_pairs()) > 0, F.size(_pairs())),
    ]


def found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "canonical_iu_mapping")
    won = suppliers(rows, _key(), "mapping_id", "loaded_at", rules()).select("key", "field", F.col("row_id").alias("mapping_id"))
    return groups(rows, _key(), "mapping_id", 2).join(won, "key").select("group_id", "field", "mapping_id")


def survivor_records(spark: SparkSession, d: str) -> DataFrame:
    s = survivors(table(spark, d, "canonical_iu_mapping"), _key(), "mapping_id", "loaded_at", rules())
    return s.select("group_id", "key", "rows", "variant_count", "source_series", F.size("appearances").alias("n_appearances"), "variant_count_from", "source_series_from", "appearances_from")


_SQL = r"""
WITH m AS (
  SELECT mapping_id, loaded_at, variant_count, regexp_replace(source_series, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS series,
    upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(canonical_id, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '(?s)^.*[/\\]', ''), '(?i)\.xml$', ''), '[^\p{L}\p{N}]', '', 'g')) AS key,
    len(list_distinct(list_filter(list_transform(appearances, lambda a: {'s': regexp_replace(a.series, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), 'f': regexp_replace(a.filepath, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')}),
      lambda a: coalesce(a.s, '') <> '' AND coalesce(a.f, '') <> ''))) AS pairs
  FROM canonical_iu_mapping
), g AS (SELECT key, min(mapping_id) AS group_id, count(*) AS rows FROM m WHERE key <> '' GROUP BY key),
v AS (SELECT key, mapping_id, variant_count, row_number() OVER (PARTITION BY key ORDER BY loaded_at DESC NULLS LAST, mapping_id DESC) AS r FROM m WHERE variant_count BETWEEN 1 AND 99),
s AS (SELECT key, mapping_id, upper(series) AS series, row_number() OVER (PARTITION BY key ORDER BY loaded_at DESC NULLS LAST, mapping_id DESC) AS r FROM m WHERE regexp_matches(series, '^[A-Za-z]\.[A-Za-z]\.[0-9]{2}\.[0-9]{3}$')),
a AS (SELECT key, mapping_id, pairs, row_number() OVER (PARTITION BY key ORDER BY pairs DESC, loaded_at DESC NULLS LAST, mapping_id DESC) AS r FROM m WHERE pairs > 0)
"""
QUERIES = {"p1_found": found, "p1_survivors": survivor_records}
SQL = {
    "p1_found": _SQL
    + """SELECT group_id, field, mapping_id FROM g JOIN (
      SELECT key, 'variant_count' AS field, mapping_id FROM v WHERE r = 1 UNION ALL SELECT key, 'source_series', mapping_id FROM s WHERE r = 1
      UNION ALL SELECT key, 'appearances', mapping_id FROM a WHERE r = 1) USING (key) WHERE rows >= 2""",
    "p1_survivors": _SQL
    + """SELECT g.group_id, g.key, g.rows, v.variant_count, s.series AS source_series, CAST(a.pairs AS INTEGER) AS n_appearances,
      v.mapping_id AS variant_count_from, s.mapping_id AS source_series_from, a.mapping_id AS appearances_from
      FROM g LEFT JOIN (SELECT * FROM v WHERE r = 1) v USING (key) LEFT JOIN (SELECT * FROM s WHERE r = 1) s USING (key) LEFT JOIN (SELECT * FROM a WHERE r = 1) a USING (key)""",
}

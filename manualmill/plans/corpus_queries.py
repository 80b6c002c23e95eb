"""Deduplication, canonicalisation, enrichment and profile queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.functions import text as X
from manualmill.functions.ids import base_id
from manualmill.operators import canonical as C
from manualmill.operators import profile as P
from manualmill.session import table

LISTS = ["fault_codes", "part_numbers", "tool_references", "consumable_references", "warranty_codes", "iu_cross_references", "configuration", "fcr_chains"]
W = r"[\s\p{Z}\x0b\x85]+"


def _units(spark: SparkSession, d: str) -> DataFrame:
    """Each unit once: rows delivered twice are the same but for loaded_at."""
    return C.first_per_key(table(spark, d, "canonical_ius_enriched"), "canonical_id", "loaded_at")


UNITS = "(SELECT * FROM canonical_ius_enriched QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY loaded_at) = 1)"


def _duplicates(spark, d):
    return C.exact_duplicates(table(spark, d, "documents"), "text", "doc_id", "content_type", "series", "source")


def exact_dedup(spark, d):
    return _duplicates(spark, d).select("hash", "unit", "kind", F.size("appearances").alias("n_appearances"), F.size("units").alias("n_units"))


_DUP = """WITH a AS (SELECT sha256(text) AS hash, doc_id, content_type, series, source FROM documents WHERE text IS NOT NULL),
 f AS (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY series NULLS FIRST, source NULLS FIRST, doc_id) AS r FROM a),
 g AS (SELECT hash, count(*) AS n, count(DISTINCT doc_id) AS u, count(DISTINCT series) AS s FROM a GROUP BY hash)"""


def id_hash_census(spark, d):
    ids = table(spark, d, "canonical_iu_mapping").filter("canonical_id IS NOT NULL").groupBy("canonical_id").agg(F.countDistinct("raw_hash").alias("hashes"))
    one = ids.agg(F.count(F.lit(1)).alias("ids"), F.count_if(F.col("hashes") > 1).alias("multi"))
    rate = F.round(F.try_divide(F.col("multi").cast("double"), F.col("ids")), 4)
    return one.select("ids", "multi", rate.alias("rate"), (rate < 0.1).alias("reliable"))


def appearance_histogram(spark, d):
    n = table(spark, d, "canonical_iu_mapping").select("raw_hash", F.explode("appearances.series").alias("s")).filter("s IS NOT NULL").groupBy("raw_hash").agg(F.countDistinct("s").alias("n"))
    return n.groupBy(P.bucket(F.col("n")).alias("bucket")).agg(F.count(F.lit(1)).alias("hashes"))


def dedup_by_type(spark, d):
    return _duplicates(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("unique_texts"), F.sum(F.size("appearances")).alias("total_texts"))


def top_duplicated(spark, d):
    dup = _duplicates(spark, d).select("hash", "unit", F.size("appearances").alias("n_appearances"))
    return dup.orderBy(F.desc("n_appearances"), "hash").limit(20)


def profile_totals(spark, d):
    m = table(spark, d, "canonical_iu_mapping")
    one = m.agg(F.count(F.lit(1)).alias("files"), F.count_distinct("raw_hash").alias("hashes"), F.count_distinct("canonical_id").alias("ids"))
    return one.select("files", "hashes", "ids", F.round(1 - F.try_divide(F.col("hashes").cast("double"), F.col("files")), 4).alias("dedup_ratio"), (F.col("hashes") * 50).alias("estimated_ms"), (F.col("hashes") * 10).alias("estimated_kb"))


def normalized_hash(spark, d):
    n = X.normalised_xml(F.col("content_html"))
    return _units(spark, d).filter("content_html IS NOT NULL").select("canonical_id", F.length(n).alias("length"), X.sha256(n).alias("hash"))


def _variants(spark, d):
    u = _units(spark, d)
    return C.variants(u.withColumn("unit", base_id(F.col("canonical_id"))), "unit", "content_md", F.size(F.coalesce("appearances", F.array())))


_VARIANTS = f"""v AS (SELECT unit, hash, any_value(content) AS content, sum(n) AS n FROM (
  SELECT regexp_replace(canonical_id, '_v[0-9]+$', '') AS unit, sha256(content_md) AS hash, content_md AS content, len(coalesce(appearances, [])) AS n FROM {UNITS}) GROUP BY unit, hash)"""
_PAIRS = f"""s AS (SELECT unit, hash, list_distinct(list_filter(string_split_regex(content, '{W}'), lambda t: t <> '')) AS t FROM v WHERE content IS NOT NULL),
 p AS (SELECT a.unit, a.hash AS hash_a, b.hash AS hash_b, coalesce(len(list_intersect(a.t, b.t)) / nullif(len(list_distinct(list_concat(a.t, b.t))), 0), 0) AS jaccard FROM s a JOIN s b ON a.unit = b.unit AND a.hash < b.hash)"""


def variant_jaccard(spark, d):
    return C.variant_pairs(_variants(spark, d)).select("unit", "hash_a", "hash_b", F.round("jaccard", 6).alias("jaccard"))


def canonical_resolution(spark, d):
    return C.resolve(_variants(spark, d))


_NORM = f"sha256(trim(regexp_replace(regexp_replace(regexp_replace(content, '(?s)<!--.*?-->', '', 'g'), '(?s)<\\?.*?\\?>', '', 'g'), '{W}', ' ', 'g')))"
_RESOLVE = f"""WITH {_VARIANTS}, w AS (SELECT *, {_NORM} AS norm, count(*) OVER (PARTITION BY unit) AS vc, sum(n) OVER (PARTITION BY unit) AS all_n FROM v),
 n AS (SELECT unit, norm, first(hash ORDER BY n DESC, hash DESC NULLS LAST) AS hash, first(content ORDER BY n DESC, hash DESC NULLS LAST) AS content, sum(n) AS n, any_value(vc) AS vc, any_value(all_n) AS all_n FROM w GROUP BY unit, norm),
 s AS (SELECT unit, hash, list_distinct(list_filter(string_split_regex(content, '{W}'), lambda t: t <> '')) AS t FROM n WHERE norm IS NOT NULL),
 p AS (SELECT a.unit, min(len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t)))) AS least FROM s a JOIN s b ON a.unit = b.unit AND a.hash < b.hash GROUP BY a.unit),
 k AS (SELECT n.*, p.least, count(norm) OVER (PARTITION BY n.unit) AS groups FROM n LEFT JOIN p USING (unit)),
 r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY length(content) DESC, n DESC, hash) AS rank,
   CASE WHEN groups = 0 THEN 'unfetchable' WHEN vc = 1 THEN 'single' WHEN groups = 1 THEN 'trivial' WHEN least >= 0.8 THEN 'version_merge' ELSE 'major_split' END AS resolution FROM k WHERE norm IS NOT NULL OR groups = 0)
 SELECT CASE WHEN resolution = 'major_split' THEN unit || '_v' || rank ELSE unit END AS canonical_id, hash AS raw_hash, resolution, CAST(vc AS INTEGER) AS variant_count,
   CAST(CASE WHEN resolution = 'major_split' THEN n ELSE all_n END AS BIGINT) AS n_appearances FROM r WHERE resolution = 'major_split' OR rank = 1"""


def enrich_fields(spark, d):
    md, h = F.col("content_md"), F.col("content_html")
    return _units(spark, d).select(
        "canonical_id", base_id(F.col("canonical_id")).alias("unit"), X.title(md).alias("title"), X.estimated_tokens(md).alias("estimated_tokens"),
        X.has_element(h, "table").alias("has_tables"), X.has_element(h, "img").alias("has_images"), X.snippet(md).alias("snippet"), F.length(X.cut_with_mark(md)).alias("shown_chars"),
        F.to_json("part_numbers").alias("part_numbers"),
    )


def md_order_statistics(spark, d):
    return P.order_statistics(_units(spark, d).withColumn("length", F.length("content_md")), "content_type", "length")


def field_coverage(spark, d):
    return P.coverage(_units(spark, d), LISTS, ["has_tables", "has_images"])


def xref_stats(spark, d):
    n = F.size(F.coalesce("iu_cross_references", F.array()))
    one = _units(spark, d).agg(F.count_if(n > 0).alias("units_with_refs"), F.sum(n).alias("refs"), F.count(F.lit(1)).alias("units"))
    return one.withColumn("per_unit", F.round(F.try_divide(F.col("refs").cast("double"), F.col("units")), 4))


def link_edges(spark, d):
    e = _units(spark, d).select("canonical_id", F.posexplode("iu_cross_references").alias("pos", "r")).filter("r.ifsid IS NOT NULL")
    return e.groupBy("canonical_id", "r.icecode", "r.ifsid").agg(F.min("pos").alias("first_at"), F.count(F.lit(1)).alias("times"))


def large_units(spark, d):
    return _units(spark, d).select("canonical_id", "content_type", F.length("content_md").alias("chars")).filter("chars > 10000").orderBy(F.desc("chars"), "canonical_id").limit(20)


def conversion_errors(spark, d):
    e = _units(spark, d).select(F.split_part("conversion_error", F.lit(":"), F.lit(1)).alias("error"))
    return e.groupBy("error").agg(F.count(F.lit(1)).alias("units")).orderBy(F.desc("units"), "error").limit(10)


def value_counts(spark, d):
    v = F.col("variant_count")
    kind = F.when(v.isNull() | (v < 1), "unknown").when(v == 1, "1").when(v <= 5, "2-5").otherwise("6+")
    return table(spark, d, "canonical_iu_mapping").groupBy("resolution", kind.alias("variants")).agg(F.count(F.lit(1)).alias("rows"))


def chunk_report(spark, d):
    c = C.first_per_key(table(spark, d, "chunks"), "chunk_id", "loaded_at").withColumn("est", X.estimated_tokens(F.col("text")))
    one = c.agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("canonical_iu_id").alias("units"), F.count_if(F.col("est") > 2000).alias("over_2000"), F.count_if(F.col("est") > 2500).alias("over_2500"), F.max("est").alias("longest"))
    return one.withColumn("per_unit", F.round(F.try_divide(F.col("chunks").cast("double"), F.col("units")), 4))


def document_dedup(spark, d):
    out = C.documents(table(spark, d, "document_structure"))
    return out.select("document_id", "series", "doc_name", "num_ius", F.array_join("iu_ids", ",").alias("iu_ids"), F.array_join("appearances", ",").alias("appearances"))


def document_statistics(spark, d):
    return P.order_statistics(C.documents(table(spark, d, "document_structure")), "doc_name", "num_ius")


def document_units(spark, d):
    """Document to unit edges in order; repeats kept."""
    doc = C.documents(table(spark, d, "document_structure")).select("document_id", F.posexplode("iu_ids").alias("pos", "unit"))
    return doc.join(_units(spark, d).select(F.col("canonical_id").alias("unit"), "title"), "unit", "left").select("document_id", "pos", "unit", F.coalesce("title", F.lit("")).alias("title"))


def _stats_sql(source: str, group: str, value: str) -> str:
    return f"""WITH x AS (SELECT {group}, {value} AS v, row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS i, count(*) OVER (PARTITION BY {group}) AS n FROM {source} WHERE {value} IS NOT NULL)
    SELECT {group}, any_value(n) AS n, min(v) AS min, max(v) FILTER (WHERE i = n // 2) AS median, CAST(floor(avg(v)) AS BIGINT) AS mean, max(v) FILTER (WHERE i = CAST(floor(n * 0.95) AS BIGINT)) AS p95, max(v) AS max FROM x GROUP BY {group}"""


_DOC = """(SELECT document_id, series, doc_name, iu_ids, len(iu_ids) AS num_ius FROM document_structure QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY loaded_at, series, doc_name) = 1)"""
_TITLE = r"trim(regexp_extract(coalesce(content_md, ''), '^#+\s+(.+)', 1))"

QUERIES = {
    f.__name__: f
    for f in (exact_dedup, id_hash_census, appearance_histogram, dedup_by_type, top_duplicated, profile_totals, normalized_hash, variant_jaccard, canonical_resolution, enrich_fields, md_order_statistics,
              field_coverage, xref_stats, link_edges, large_units, conversion_errors, value_counts, chunk_report, document_dedup, document_statistics, document_units)
}
SQL = {
    "exact_dedup": f"{_DUP} SELECT hash, f.doc_id AS unit, f.content_type AS kind, CAST(g.n AS INTEGER) AS n_appearances, CAST(g.u AS INTEGER) AS n_units FROM f JOIN g USING (hash) WHERE r = 1",
    "id_hash_census": "WITH i AS (SELECT canonical_id, count(DISTINCT raw_hash) AS h FROM canonical_iu_mapping WHERE canonical_id IS NOT NULL GROUP BY 1) SELECT count(*) AS ids, count(*) FILTER (WHERE h > 1) AS multi, round(count(*) FILTER (WHERE h > 1) / count(*), 4) AS rate, round(count(*) FILTER (WHERE h > 1) / count(*), 4) < 0.1 AS reliable FROM i",
    "appearance_histogram": """WITH n AS (SELECT raw_hash, count(DISTINCT s) AS n FROM (SELECT raw_hash, unnest(appearances).series AS s FROM canonical_iu_mapping) WHERE s IS NOT NULL GROUP BY 1)
      SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 5 THEN '4-5' WHEN n <= 10 THEN '6-10' WHEN n <= 50 THEN '11-50' ELSE '51+' END AS bucket, count(*) AS hashes FROM n GROUP BY 1""",
    "dedup_by_type": f"{_DUP} SELECT f.content_type AS kind, count(*) AS unique_texts, CAST(sum(g.n) AS BIGINT) AS total_texts FROM f JOIN g USING (hash) WHERE r = 1 GROUP BY 1",
    "top_duplicated": f"{_DUP} SELECT hash, f.doc_id AS unit, CAST(g.n AS INTEGER) AS n_appearances FROM f JOIN g USING (hash) WHERE r = 1 ORDER BY n_appearances DESC, hash LIMIT 20",
    "profile_totals": "SELECT count(*) AS files, count(DISTINCT raw_hash) AS hashes, count(DISTINCT canonical_id) AS ids, round(1 - count(DISTINCT raw_hash) / count(*), 4) AS dedup_ratio, count(DISTINCT raw_hash) * 50 AS estimated_ms, count(DISTINCT raw_hash) * 10 AS estimated_kb FROM canonical_iu_mapping",
    "normalized_hash": f"SELECT canonical_id, CAST(length(n) AS INTEGER) AS length, sha256(n) AS hash FROM (SELECT canonical_id, trim(regexp_replace(regexp_replace(regexp_replace(content_html, '(?s)<!--.*?-->', '', 'g'), '(?s)<\\?.*?\\?>', '', 'g'), '{W}', ' ', 'g')) AS n FROM {UNITS} WHERE content_html IS NOT NULL)",
    "variant_jaccard": f"WITH {_VARIANTS}, {_PAIRS} SELECT unit, hash_a, hash_b, round(jaccard, 6) AS jaccard FROM p",
    "canonical_resolution": _RESOLVE,
    "enrich_fields": f"""SELECT canonical_id, regexp_replace(canonical_id, '_v[0-9]+$', '') AS unit, {_TITLE} AS title, CAST(length(coalesce(content_md, '')) // 4 AS INTEGER) AS estimated_tokens,
      contains(lower(coalesce(content_html, '')), '<table') AS has_tables, contains(lower(coalesce(content_html, '')), '<img') AS has_images, replace(substr(content_md, 1, 200), chr(10), ' ') AS snippet,
      CAST(CASE WHEN length(content_md) > 800 THEN 806 ELSE length(content_md) END AS INTEGER) AS shown_chars, CAST(to_json(part_numbers) AS VARCHAR) AS part_numbers FROM {UNITS}""",
    "md_order_statistics": _stats_sql(f"(SELECT content_type, CAST(length(content_md) AS INTEGER) AS length FROM {UNITS})", "content_type", "length"),
    "field_coverage": " UNION ALL ".join(
        [f"SELECT '{c}' AS field, count(*) FILTER (WHERE len({c}) > 0) AS filled, round(count(*) FILTER (WHERE len({c}) > 0) / count(*), 4) AS share FROM {UNITS}" for c in LISTS]
        + [f"SELECT '{c}', count(*) FILTER (WHERE {c}), round(count(*) FILTER (WHERE {c}) / count(*), 4) FROM {UNITS}" for c in ("has_tables", "has_images")]
    ),
    "xref_stats": f"SELECT count(*) FILTER (WHERE len(iu_cross_references) > 0) AS units_with_refs, CAST(sum(len(coalesce(iu_cross_references, []))) AS BIGINT) AS refs, count(*) AS units, round(sum(len(coalesce(iu_cross_references, []))) / count(*), 4) AS per_unit FROM {UNITS}",
    "link_edges": f"SELECT canonical_id, r.icecode AS icecode, r.ifsid AS ifsid, CAST(min(pos) - 1 AS INTEGER) AS first_at, count(*) AS times FROM (SELECT canonical_id, unnest(iu_cross_references) AS r, generate_subscripts(iu_cross_references, 1) AS pos FROM {UNITS}) WHERE r.ifsid IS NOT NULL GROUP BY 1, 2, 3",
    "large_units": f"SELECT canonical_id, content_type, CAST(length(content_md) AS INTEGER) AS chars FROM {UNITS} WHERE length(content_md) > 10000 ORDER BY chars DESC, canonical_id LIMIT 20",
    "conversion_errors": f"SELECT CASE WHEN conversion_error IS NULL THEN NULL ELSE split_part(conversion_error, ':', 1) END AS error, count(*) AS units FROM {UNITS} GROUP BY 1 ORDER BY units DESC, error LIMIT 10",
    "value_counts": "SELECT resolution, CASE WHEN variant_count IS NULL OR variant_count < 1 THEN 'unknown' WHEN variant_count = 1 THEN '1' WHEN variant_count <= 5 THEN '2-5' ELSE '6+' END AS variants, count(*) AS rows FROM canonical_iu_mapping GROUP BY 1, 2",
    "chunk_report": "WITH c AS (SELECT canonical_iu_id, length(text) // 4 AS est FROM chunks QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY loaded_at) = 1) SELECT count(*) AS chunks, count(DISTINCT canonical_iu_id) AS units, count(*) FILTER (WHERE est > 2000) AS over_2000, count(*) FILTER (WHERE est > 2500) AS over_2500, CAST(max(est) AS INTEGER) AS longest, round(count(*) / count(DISTINCT canonical_iu_id), 4) AS per_unit FROM c",
    "document_dedup": f"""WITH s AS (SELECT document_id, string_agg(DISTINCT s, ',' ORDER BY s) AS appearances FROM (SELECT document_id, unnest(list_concat(coalesce(appearances, []), [series])) AS s FROM document_structure) GROUP BY 1)
      SELECT document_id, series, doc_name, CAST(num_ius AS INTEGER) AS num_ius, coalesce(array_to_string(iu_ids, ','), '') AS iu_ids, appearances FROM {_DOC} JOIN s USING (document_id)""",
    "document_statistics": _stats_sql(f"(SELECT doc_name, CAST(num_ius AS INTEGER) AS num_ius FROM {_DOC})", "doc_name", "num_ius"),
    "document_units": f"SELECT document_id, CAST(pos - 1 AS INTEGER) AS pos, unit, coalesce(title, '') AS title FROM (SELECT document_id, unnest(iu_ids) AS unit, generate_subscripts(iu_ids, 1) AS pos FROM {_DOC}) LEFT JOIN {UNITS} u ON u.canonical_id = unit",
}

"""Applicability, machine, cost and evaluation queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manualmill.functions.ids import canonical_form
from manualmill.operators import applicability as A
from manualmill.operators import evaluate as E
from manualmill.operators import fleet as N
from manualmill.operators.canonical import first_per_key
from manualmill.plans.retrieval_queries import _KEY
from manualmill.session import table


def _products(spark, d):
    """Types with an upper serial bound count as active; the model's brand serves as its code."""
    t = table(spark, d, "technical_types").withColumn("status", F.when(F.col("sn_max") != "NULL", "1").otherwise("0"))
    return A.active(t, "status").select(F.col("series_icecode").alias("series"), "tt_id", F.col("model_name").alias("model_code"), "tt_code")


def _rules(spark, d):
    """Each unit in each of its series; the last digits of its id choose codes, some null."""
    u = table(spark, d, "canonical_ius_enriched").select("canonical_id", F.explode("appearances.series").alias("series")).distinct()
    n = F.regexp_extract("canonical_id", r"IU([0-9]+)", 1).cast("int")
    mod = F.when(n % 3 != 0, F.element_at(F.array(*map(F.lit, ("KV 210", "HM 5", "HM 7 Vario", "KV 260"))), F.pmod(n, F.lit(4)) + 1))
    tt = F.when(n % 5 == 1, F.concat(F.lit("TT"), (F.lit(40000) + F.pmod(n, F.lit(2000))).cast("string")))
    return u.select(F.col("canonical_id").alias("unit"), "series", mod.alias("app_mod"), tt.alias("app_tt"))


def applicability_pairs(spark, d):
    return A.applicable_pairs(_rules(spark, d), _products(spark, d))


def active_products(spark, d):
    return _products(spark, d).select("series", "tt_id", "model_code", "tt_code")


def product_sets(spark, d):
    s = A.product_sets(_products(spark, d))
    return s.groupBy("series").agg(F.count(F.lit(1)).alias("types"), F.sum(F.size("model_codes")).alias("models"))


def type_enrichment(spark, d):
    """Applicability rows with the type's names; unknown types keep nulls. Counted before the join, so the hottest type is one row."""
    a = table(spark, d, "iu_tt_applicability").groupBy("tt_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(canonical_form(F.col("iu_miuid"))).alias("units"))
    return a.join(table(spark, d, "technical_types").select("tt_id", "tt_name", "series_icecode"), "tt_id", "left")


def first_types(spark, d):
    """The first type per series."""
    return first_per_key(table(spark, d, "technical_types"), "series_icecode", "tt_id").select("series_icecode", "tt_id", "tt_name")


def serial_ranges(spark, d):
    """A serial in the middle of each range, one below it and one of the wrong length, against the masked bounds."""
    t = table(spark, d, "technical_types").select("tt_id", "sn_min", "sn_max")
    base = F.replace(F.col("sn_min"), F.lit("*"), F.lit("7"))
    cases = F.explode(F.array(F.struct(F.lit("at").alias("case"), base.alias("vin")), F.struct(F.lit("low").alias("case"), F.concat(F.substring(base, 1, 2), F.lit("00000")).alias("vin")), F.struct(F.lit("short").alias("case"), F.substring(base, 1, 4).alias("vin"))))
    x = t.select("tt_id", "sn_min", "sn_max", cases.alias("c"))
    return x.select("tt_id", "c.case", "c.vin", N.serial_match(F.col("c.vin"), F.col("sn_min"), F.col("sn_max")).alias("match"))


def operation_inclusion(spark, d):
    """Orders include the parts of their open lines; the time is the quantity."""
    parents = table(spark, d, "orders").select(F.col("o_orderkey").alias("parent"), F.col("o_orderkey").alias("link"))
    kids = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("link"), F.col("l_partkey").alias("child"), F.when(F.col("l_linestatus") == "O", "I").otherwise("E").alias("status"), F.col("l_quantity").alias("time"))
    out = N.included_operations(parents, kids)
    return out.select("parent", F.array_join(F.transform("includes", lambda x: x.cast("string")), ",").alias("includes"), F.round("time", 2).alias("time"))


def first_label(spark, d):
    return first_per_key(table(spark, d, "part"), "p_brand", "p_partkey").select("p_brand", "p_partkey", "p_name")


def series_levels(spark, d):
    r, n, c = (table(spark, d, t) for t in ("region", "nation", "customer"))
    x = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return x.select(N.series_code(F.col("r_name"), F.col("n_name"), F.col("c_mktsegment")).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("customers"))


def taxonomy_levels(spark, d):
    t = N.taxonomy(F.concat("series_icecode", F.lit("-"), F.regexp_replace("tt_code", "([0-9]{2})([0-9]{3})", "$1.$2")))
    x = table(spark, d, "technical_types").select("tt_id", t["left"].alias("l"), t["right"].alias("r"))
    return x.select("tt_id", F.size("l").alias("left_levels"), F.size("r").alias("right_levels"), F.try_element_at("l", F.lit(1)).alias("top"), F.try_element_at("r", F.lit(-1)).alias("leaf"))


def hash_shards(spark, d):
    return table(spark, d, "customer").select("c_custkey", N.shard(F.col("c_name")).alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("customers"), F.min("c_custkey").alias("first"))


def profile_documents(spark, d):
    """One nested record per customer: totals and the orders in order, as JSON."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("o"))
    g = o.groupBy("c_custkey").agg(F.sort_array(F.collect_list("o")).alias("operations"))
    c = table(spark, d, "customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("specs"))
    return c.join(g, "c_custkey").select("c_custkey", F.size("operations").alias("n"), F.to_json(F.struct("specs", "operations")).alias("document"))


def precision_at_k(spark, d):
    """Labelled documents stand for rated results: quality 3 is HIGH; the source is the query."""
    docs = table(spark, d, "documents").filter("source IS NOT NULL").select(F.col("source").alias("query_id"), F.col("doc_id").alias("pos"))
    best = table(spark, d, "doc_labels").filter("quality IS NOT NULL").groupBy(F.col("doc_id").alias("pos")).agg(F.max("quality").alias("q"))
    rated = docs.join(best, "pos").select("query_id", "pos", F.when(F.col("q") == 3, "HIGH").when(F.col("q") == 2, "MEDIUM").otherwise("LOW").alias("rating"))
    return E.precision(E.merge_ratings(docs.join(best, "pos", "left_semi"), rated))


def cost_rollup(spark, d):
    calls = table(spark, d, "events").select(F.col("event_type").alias("name"), F.element_at(F.array(F.lit("small"), F.lit("large"), F.lit("unknown")), (F.col("user_id") % 3 + 1).cast("int")).alias("model"), F.floor("value").alias("tokens_in"), (F.col("event_id") % 50).alias("tokens_out"))
    prices = spark.createDataFrame([("small", 0.25, 2.0), ("large", 3.0, 15.0)], "model string, price_in double, price_out double")
    return E.cost_rollup(calls, prices)


def sliding_token_budget(spark, d):
    x = table(spark, d, "events").select("event_id", "event_type", "ts", F.floor("value").alias("tokens"))
    return E.sliding_tokens(x, "ts", "tokens", 60 * 60, "event_type").select("event_id", "event_type", "tokens", "in_window")


def request_packing(spark, d):
    x = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.floor(F.length("text") / 4).alias("tokens"))
    return E.request_packing(x, "doc_id", "tokens", F.pmod("doc_id", F.lit(64)), 20, 3000).select("shard", F.col("item").alias("doc_id"), "tokens", "request")


def unlabelled_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return E.pending(docs, table(spark, d, "doc_labels"), "doc_id")


_ACTIVE = "(SELECT series_icecode AS series, tt_id, model_name AS model_code, tt_code FROM technical_types WHERE sn_max <> 'NULL')"
_RULES = """(SELECT unit, series, CASE WHEN n % 3 <> 0 THEN ['KV 210', 'HM 5', 'HM 7 Vario', 'KV 260'][n % 4 + 1] END AS app_mod, CASE WHEN n % 5 = 1 THEN 'TT' || (40000 + n % 2000) END AS app_tt
  FROM (SELECT DISTINCT canonical_id AS unit, series, CAST(regexp_extract(canonical_id, 'IU([0-9]+)', 1) AS INTEGER) AS n FROM (SELECT canonical_id, unnest(appearances).series AS series FROM canonical_ius_enriched)) WHERE series IS NOT NULL)"""
_KEEP = "array_to_string(list_filter(list_transform(range(1, length(m) + 1), lambda i: CASE WHEN m[i] <> '*' THEN {}[i] END), lambda x: x IS NOT NULL), '')"

QUERIES = {
    f.__name__: f
    for f in (applicability_pairs, active_products, product_sets, type_enrichment, first_types, serial_ranges, operation_inclusion, first_label, series_levels, taxonomy_levels, hash_shards,
              profile_documents, precision_at_k, cost_rollup, sliding_token_budget, request_packing, unlabelled_documents)
}
SQL = {
    "request_packing": """WITH RECURSIVE x AS (SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens, doc_id % 64 AS shard, row_number() OVER (PARTITION BY doc_id % 64 ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL),
      s AS (SELECT shard, doc_id, tokens, r, 0 AS request, 1 AS inputs, tokens AS used FROM x WHERE r = 1
        UNION ALL SELECT x.shard, x.doc_id, x.tokens, x.r, CASE WHEN s.inputs >= 20 OR s.used + x.tokens > 3000 THEN s.request + 1 ELSE s.request END, CASE WHEN s.inputs >= 20 OR s.used + x.tokens > 3000 THEN 1 ELSE s.inputs + 1 END, CASE WHEN s.inputs >= 20 OR s.used + x.tokens > 3000 THEN x.tokens ELSE s.used + x.tokens END
        FROM s JOIN x ON x.shard = s.shard AND x.r = s.r + 1)
      SELECT shard, doc_id, tokens, request FROM s""",
    "applicability_pairs": f"SELECT DISTINCT r.unit, t.tt_id FROM {_RULES} r JOIN (SELECT series, tt_id, list(DISTINCT model_code) AS m, list(DISTINCT tt_code) AS c FROM {_ACTIVE} GROUP BY 1, 2) t ON r.series = t.series AND (r.app_mod IS NULL OR list_contains(t.m, r.app_mod)) AND (r.app_tt IS NULL OR list_contains(t.c, r.app_tt))",
    "active_products": f"SELECT * FROM {_ACTIVE}",
    "product_sets": f"SELECT series, count(DISTINCT tt_id) AS types, count(DISTINCT (tt_id, model_code)) AS models FROM {_ACTIVE} GROUP BY 1",
    "type_enrichment": f"SELECT tt_id, rows, units, tt_name, series_icecode FROM (SELECT tt_id, count(*) AS rows, count(DISTINCT CASE WHEN regexp_matches({_KEY}, '^IU[0-9]+V[0-9]+$') THEN {_KEY} ELSE nullif({_KEY}, '') END) AS units FROM iu_tt_applicability GROUP BY 1) LEFT JOIN technical_types USING (tt_id)",
    "first_types": "SELECT series_icecode, tt_id, tt_name FROM technical_types QUALIFY row_number() OVER (PARTITION BY series_icecode ORDER BY tt_id) = 1",
    "serial_ranges": f"""WITH x AS (SELECT tt_id, sn_min AS m, sn_max AS h, replace(sn_min, '*', '7') AS b FROM technical_types),
      c AS (SELECT tt_id, m, h, 'at' AS "case", b AS vin FROM x UNION ALL SELECT tt_id, m, h, 'low', substr(b, 1, 2) || '00000' FROM x UNION ALL SELECT tt_id, m, h, 'short', substr(b, 1, 4) FROM x)
      SELECT tt_id, "case", vin, CASE WHEN h IS NOT NULL AND h <> 'NULL' AND m <> 'NULL' AND length(vin) = length(m) AND length(m) = length(h) THEN {_KEEP.format('vin')} >= {_KEEP.format('m')} AND {_KEEP.format('vin')} <= {_KEEP.format('h')} END AS match
      FROM (SELECT tt_id, regexp_replace(trim(m), '\\s*-$', '') AS m, h, "case", vin FROM c)""",
    "operation_inclusion": "SELECT l_orderkey AS parent, array_to_string(list_sort(list(DISTINCT l_partkey)), ',') AS includes, round(sum(l_quantity), 2) AS time FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'O' GROUP BY 1",
    "first_label": "SELECT p_brand, p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1",
    "series_levels": "SELECT r_name || '.' || n_name || '.' || c_mktsegment AS code, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    "taxonomy_levels": "SELECT tt_id, CAST(len(string_split(series_icecode, '.')) AS INTEGER) AS left_levels, 2 AS right_levels, string_split(series_icecode, '.')[1] AS top, substr(tt_code, 5, 3) AS leaf FROM technical_types",
    "hash_shards": "SELECT substr(sha256(right(c_name, 8)), 1, 2) AS shard, count(*) AS customers, min(c_custkey) AS first FROM customer GROUP BY 1",
    "precision_at_k": """WITH b AS (SELECT doc_id, max(quality) AS q FROM doc_labels WHERE quality IS NOT NULL GROUP BY 1)
      SELECT source AS query_id, count(*) FILTER (WHERE q = 3) AS high, count(*) AS total, round(count(*) FILTER (WHERE q = 3) / count(*), 6) AS precision FROM documents JOIN b USING (doc_id) WHERE source IS NOT NULL GROUP BY ROLLUP (source)""",
    "cost_rollup": """SELECT name, c.model, count(*) AS calls, CAST(sum(ti) AS BIGINT) AS tokens_in, CAST(sum(t_o) AS BIGINT) AS tokens_out, round(sum(coalesce((ti * pi + t_o * po) / 1e6, 0)), 6) AS cost
      FROM (SELECT event_type AS name, ['small', 'large', 'unknown'][user_id % 3 + 1] AS model, CAST(floor(value) AS BIGINT) AS ti, event_id % 50 AS t_o FROM events) c LEFT JOIN (VALUES ('small', 0.25, 2.0), ('large', 3.0, 15.0)) p(model, pi, po) ON p.model = c.model GROUP BY 1, 2""",
    "sliding_token_budget": "SELECT event_id, event_type, CAST(floor(value) AS BIGINT) AS tokens, CAST(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW) AS BIGINT) AS in_window FROM events",
    "unlabelled_documents": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM doc_labels WHERE doc_id IS NOT NULL)",
}

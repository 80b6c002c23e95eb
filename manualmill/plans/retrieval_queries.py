"""Retrieval queries with their SQL: the questions of eval_items over chunks.

Stand-ins: the expansion of a question is its first five tokens; its vector is that of the
item_id-th usable chunk; its series and type are those of the item_id-th technical type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from manualmill.functions.ids import base_id, canonical_form
from manualmill.functions.text import chunk_owner, estimated_tokens, tokens
from manualmill.operators import bm25, context, fusion, vector
from manualmill.operators.canonical import first_per_key
from manualmill.session import materialise, table

DIM = 64
_WARM: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, d: str, name: str, make):
    """What all retrieval queries over one set of tables share (index, clean type and series lists), written once per application, as a server does at its start."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _WARM:
        _WARM[key] = make()
    return _WARM[key]


def _index(spark: SparkSession, d: str) -> bm25.Index:
    return _once(spark, d, "index", lambda: bm25.Index.build(_docs(spark, d)))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return first_per_key(table(spark, d, "chunks"), "chunk_id", "loaded_at", ties=("text", "chunk_index", "content_type"))


def _docs(spark, d):
    return _chunks(spark, d).select(F.col("chunk_id").alias("doc"), "text")


def _questions(spark, d):
    return table(spark, d, "eval_items").select(F.col("item_id").alias("query_id"), F.col("query").alias("text"))


def _short(spark, d):
    return _questions(spark, d).select("query_id", F.array_join(F.slice(tokens(F.col("text")), 1, 5), " ").alias("text"))


def bm25_topk(spark, d):
    return bm25.top(_index(spark, d).scores(_questions(spark, d)), 20)


def bm25_masked_topk(spark, d):
    """Scores use the statistics of all chunks; those outside the mask are dropped before the top k."""
    keep = _chunks(spark, d).filter("content_type = 'Diagnostic_IU'").select(F.col("chunk_id").alias("doc"))
    return bm25.top(_index(spark, d).scores(_questions(spark, d)).join(keep, "doc", "left_semi"), 20)


def bm25_terms(spark, d):
    return _index(spark, d).terms.select("term", "df", F.round("idf", 6).alias("idf"))


def vector_topk(spark, d):
    """Every vector whose id is divisible by 100 against all."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc"), F.col("embedding").alias("v"))
    return vector.nearest(rows.filter("doc % 100 = 0").withColumnRenamed("doc", "query_id"), rows, 20, DIM)


def _vectors(spark, d):
    v = vector.usable(table(spark, d, "chunk_embeddings"), "embedding", DIM)
    return first_per_key(v, "chunk_id", "embedded_at").select(F.col("chunk_id").alias("doc"), F.col("embedding").alias("v"))


def _question_vectors(spark, d):
    """The first 150 by chunk_id: a top-n, so only that many rows meet in one task."""
    n = table(spark, d, "eval_items").count()
    few = _vectors(spark, d).orderBy("doc").limit(n)
    return few.select(F.row_number().over(Window.orderBy("doc")).cast("long").alias("query_id"), "v")


def _scored(spark, d):
    both = _questions(spark, d).select(F.struct("query_id", F.lit(0).alias("leg")).alias("query_id"), "text").unionByName(_short(spark, d).select(F.struct("query_id", F.lit(1).alias("leg")).alias("query_id"), "text"))
    return _index(spark, d).scores(both)


def _fused(spark, d):
    words = bm25.top(_scored(spark, d), 20).select("query_id.query_id", "doc", "rank")
    near = vector.nearest(_question_vectors(spark, d), _vectors(spark, d), 20, DIM)
    return fusion.reciprocal_rank([words, near])


def rrf_fusion(spark, d):
    return _fused(spark, d).select("query_id", "doc", F.round("score", 9).alias("score"))


def _requests(spark, d):
    t = table(spark, d, "technical_types").select("tt_id", "series_icecode", F.row_number().over(Window.orderBy("tt_id")).cast("long").alias("query_id"))  # a fixed table of 300 types
    q = table(spark, d, "eval_items").select(F.col("item_id").alias("query_id"))
    return q.join(t, "query_id").select("query_id", F.col("series_icecode").alias("series"), (F.col("query_id") % 5 == 0).alias("series_only"), "tt_id", (F.col("query_id") % 4 == 0).alias("tt_only"))


def _unit_series(spark, d):
    e = table(spark, d, "canonical_ius_enriched").select(F.col("canonical_id").alias("unit"), F.explode("appearances.series").alias("series"))
    return _once(spark, d, "series", lambda: materialise(e.filter("series IS NOT NULL").distinct(), "unit-series"))


def _unit_types(spark, d):
    a = table(spark, d, "iu_tt_applicability").select(canonical_form(F.col("iu_miuid")).alias("base"), "tt_id")
    clean = a.filter("base IS NOT NULL AND tt_id IS NOT NULL").distinct().repartitionByRange("tt_id", "base").sortWithinPartitions("tt_id", "base")
    return _once(spark, d, "types", lambda: materialise(clean, "unit-types"))  # sorted by type, so a look-up reads few row groups


def _boosted(spark, d):
    """All legs go as deep as their request asks; the hard filters narrow the keyword legs before their top k."""
    asked, series, types = _requests(spark, d), _unit_series(spark, d), _unit_types(spark, d)
    own = chunk_owner(F.col("doc"))
    owned = {"unit": own, "base": base_id(own)}
    legs = _scored(spark, d).select(F.col("query_id").alias("leg"), "query_id.query_id", "doc", "score").withColumns(owned)
    kept = fusion.masked(legs, asked, series, types).select(F.col("leg").alias("query_id"), "doc", "score")
    words = bm25.top(kept, fusion.WIDE).select("query_id.query_id", "doc", "rank")
    near = vector.nearest(_question_vectors(spark, d), _vectors(spark, d), fusion.WIDE, DIM).select("query_id", "doc", "rank")
    fused = materialise(fusion.reciprocal_rank([fusion.within_depth(x, asked) for x in (words, near)]), "fused")
    return fusion.boosted(fused.withColumns(owned), asked, series, types)


def hybrid_ranking(spark, d):
    """The flagship: keyword and vector legs, fusion, boosts, hard filters, final order."""
    return fusion.ranked(_boosted(spark, d), 15).select("query_id", "pos", "doc", "score", "in_series", "in_type")


def _packable(spark, d):
    return _chunks(spark, d).filter("text IS NOT NULL").select(F.col("chunk_id").alias("doc"), chunk_owner(F.col("chunk_id")).alias("unit"), F.col("chunk_index").alias("idx"), estimated_tokens(F.col("text")).alias("tokens"), "text", F.col("content_type").alias("kind"))


def context_pack(spark, d):
    ranking = fusion.ranked(_boosted(spark, d), context.MOST_CHUNKS)
    return context.pack(ranking.select("query_id", "doc", "pos"), _packable(spark, d))


def context_blocks(spark, d):
    """The packed text of each question."""
    parents = first_per_key(table(spark, d, "canonical_ius_enriched"), "canonical_id", "loaded_at").select(F.col("canonical_id").alias("unit"), "title", F.col("content_type").alias("kind"))
    return context.blocks(materialise(context_pack(spark, d), "packed"), _packable(spark, d), parents)


def adjacent_chunks(spark, d):
    return context.adjacent(_packable(spark, d))


def chunk_parents(spark, d):
    """Chunks with title and type of their unit; the chunk's own type, then unknown, stand in."""
    parents = first_per_key(table(spark, d, "canonical_ius_enriched"), "canonical_id", "loaded_at").select(F.col("canonical_id").alias("unit"), "title", F.col("content_type").alias("kind"))
    c = _chunks(spark, d).select(F.col("chunk_id").alias("doc"), chunk_owner(F.col("chunk_id")).alias("unit"), "content_type")
    return c.join(parents, "unit", "left").select("doc", "unit", F.coalesce("title", F.lit("")).alias("title"), F.coalesce(F.nullif("kind", F.lit("")), F.nullif("content_type", F.lit("")), F.lit("unknown")).alias("kind"))


def followup_replay(spark, d):
    src = table(spark, d, "document_structure").groupBy("document_id").agg(F.min_by("iu_ids", "loaded_at").alias("docs")).select(F.col("document_id").alias("query_id"), "docs")
    return context.replay(src).select("query_id", "doc", "pos", F.round("score", 6).alias("score"))


def tt_lookup(spark, d):
    """Units of the most used type."""
    t = _unit_types(spark, d)
    most = t.groupBy("tt_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tt_id").limit(1)
    return t.join(most.select("tt_id"), "tt_id", "left_semi").select("tt_id", F.col("base").alias("unit"))


def zero_vectors(spark, d):
    return vector.all_zero(table(spark, d, "chunk_embeddings"), "embedding").select("chunk_id").distinct()


def embedding_todo(spark, d):
    """Chunks still without a usable vector: what a resumed run has to embed."""
    done = vector.usable(table(spark, d, "chunk_embeddings"), "embedding", DIM).select("chunk_id")
    return _chunks(spark, d).filter("text IS NOT NULL").join(done, "chunk_id", "left_anti").select("chunk_id", estimated_tokens(F.col("text")).alias("tokens"))


_C = "(SELECT * FROM chunks QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY loaded_at) = 1)"
_TOK = r"list_filter(string_split_regex(lower({}), '[\s\p{{Z}}\x0b\x85]+'), lambda t: t <> '')"
_OWN = "CASE WHEN position('_c' IN doc) = 0 THEN doc ELSE regexp_replace(doc, '_c([^_]|_[^c])*_?$', '') END"


def _bm25_sql(queries: str) -> str:
    return f"""q AS ({queries}),
    d AS (SELECT chunk_id AS doc, {_TOK.format('text')} AS t FROM {_C} WHERE text IS NOT NULL),
    s AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM d),
    tf AS (SELECT doc, dl, term, count(*) AS tf FROM (SELECT doc, len(t) AS dl, unnest(t) AS term FROM d) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    raw AS (SELECT term, df, ln((n - df + 0.5) / (df + 0.5)) AS r FROM df, s),
    idf AS (SELECT term, df, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END AS idf FROM raw),
    qt AS (SELECT query_id, leg, term, count(*) AS times FROM (SELECT query_id, leg, unnest({_TOK.format('text')}) AS term FROM q) GROUP BY ALL),
    sc AS (SELECT query_id, leg, doc, round(sum(times * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM qt JOIN idf USING (term) JOIN tf USING (term), s GROUP BY 1, 2, 3)"""


_Q = "SELECT item_id AS query_id, 0 AS leg, query AS text FROM eval_items"
_Q2 = _Q + f" UNION ALL SELECT item_id, 1, array_to_string(list_slice({_TOK.format('query')}, 1, 5), ' ') FROM eval_items"
_VEC = "(SELECT chunk_id AS doc, embedding::DOUBLE[] AS v FROM chunk_embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY embedded_at) = 1)"
_FUSED = f"""{_bm25_sql(_Q2)},
    w AS (SELECT query_id, doc, row_number() OVER (PARTITION BY query_id, leg ORDER BY score DESC, doc) - 1 AS rank FROM sc WHERE score > 0 QUALIFY rank < 20),
    vv AS {_VEC}, qv AS (SELECT row_number() OVER (ORDER BY doc) AS query_id, v FROM vv QUALIFY query_id <= (SELECT count(*) FROM eval_items)),
    vs AS (SELECT query_id, doc, round(list_cosine_similarity(qv.v, vv.v), 6) AS score FROM qv, vv),
    vr AS (SELECT query_id, doc, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) - 1 AS rank FROM vs QUALIFY rank < 20),
    fu AS (SELECT query_id, doc, sum(1 / (60 + rank)) AS score FROM (SELECT * FROM w UNION ALL SELECT * FROM vr) GROUP BY ALL)"""
_KEY = r"upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(iu_miuid, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '(?s)^.*[/\\]', ''), '(?i)\.xml$', ''), '[^\p{L}\p{N}]', '', 'g'))"
_TYPES = f"(SELECT DISTINCT CASE WHEN regexp_matches(b, '^IU[0-9]+V[0-9]+$') THEN regexp_replace(b, 'V([0-9]+)$', '_v\\1') ELSE b END AS base, tt_id FROM (SELECT {_KEY} AS b, tt_id FROM iu_tt_applicability) WHERE b <> '' AND tt_id IS NOT NULL)"
# as the query: the hard filters of a request narrow the keyword legs before their top k, and every leg goes as deep as its request asks
_BOOSTED = f"""{_bm25_sql(_Q2)},
    r AS (SELECT query_id, series_icecode AS series, query_id % 5 = 0 AS series_only, tt_id, query_id % 4 = 0 AS tt_only FROM (SELECT row_number() OVER (ORDER BY tt_id) AS query_id, * FROM technical_types) WHERE query_id IN (SELECT item_id FROM eval_items)),
    us AS (SELECT DISTINCT unit, series FROM (SELECT canonical_id AS unit, unnest(appearances).series AS series FROM canonical_ius_enriched) WHERE series IS NOT NULL), ut AS {_TYPES},
    most AS (SELECT query_id, CASE WHEN coalesce(series, '') <> '' OR tt_id IS NOT NULL THEN 200 ELSE 20 END AS most FROM r),
    own AS (SELECT doc, {_OWN} AS unit, regexp_replace({_OWN}, '_v[0-9]+$', '') AS base FROM (SELECT DISTINCT doc FROM sc)),
    kept AS (SELECT sc.* FROM sc JOIN own USING (doc) LEFT JOIN r USING (query_id)
      LEFT JOIN us ON us.unit = own.unit AND us.series = r.series LEFT JOIN ut ON ut.base = own.base AND ut.tt_id = r.tt_id
      WHERE sc.score > 0 AND (NOT coalesce(r.series_only AND r.series IS NOT NULL, false) OR us.unit IS NOT NULL) AND (NOT coalesce(r.tt_only AND r.tt_id IN (SELECT tt_id FROM ut), false) OR ut.base IS NOT NULL)),
    w AS (SELECT query_id, doc, row_number() OVER (PARTITION BY query_id, leg ORDER BY score DESC, doc) - 1 AS rank FROM kept),
    vv AS {_VEC}, qv AS (SELECT row_number() OVER (ORDER BY doc) AS query_id, v FROM vv QUALIFY query_id <= (SELECT count(*) FROM eval_items)),
    vs AS (SELECT query_id, doc, round(list_cosine_similarity(qv.v, vv.v), 6) AS score FROM qv, vv),
    vr AS (SELECT query_id, doc, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) - 1 AS rank FROM vs),
    fu AS (SELECT query_id, doc, sum(1 / (60 + rank)) AS score FROM (SELECT * FROM w UNION ALL SELECT * FROM vr) JOIN most USING (query_id) WHERE rank < most GROUP BY ALL),
    x AS (SELECT fu.query_id, doc, score, r.*, {_OWN} AS unit, regexp_replace({_OWN}, '_v[0-9]+$', '') AS base FROM fu JOIN r USING (query_id)),
    y AS (SELECT x.query_id, doc, us.unit IS NOT NULL AS in_series, ut.base IS NOT NULL AS in_type, x.tt_id IN (SELECT tt_id FROM ut) AS tt_known, score, series_only, tt_only, x.series FROM x LEFT JOIN us ON us.unit = x.unit AND us.series = x.series LEFT JOIN ut ON ut.base = x.base AND ut.tt_id = x.tt_id),
    z AS (SELECT query_id, doc, in_series, in_type, round(score * CASE WHEN in_series THEN 3 ELSE 1 END * CASE WHEN in_type THEN 3 ELSE 1 END, 9) AS score FROM y WHERE (in_series OR NOT (series_only AND series IS NOT NULL)) AND (in_type OR NOT (tt_only AND tt_known)))"""

QUERIES = {
    f.__name__: f
    for f in (bm25_topk, bm25_masked_topk, bm25_terms, vector_topk, rrf_fusion, hybrid_ranking, context_pack, context_blocks, adjacent_chunks, chunk_parents, followup_replay, tt_lookup, zero_vectors, embedding_todo)
}
SQL = {
    "bm25_topk": f"WITH {_bm25_sql(_Q)} SELECT query_id, doc, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) - 1 AS INTEGER) AS rank FROM sc WHERE score > 0 QUALIFY rank < 20",
    "bm25_masked_topk": f"WITH {_bm25_sql(_Q)} SELECT query_id, doc, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) - 1 AS INTEGER) AS rank FROM sc WHERE score > 0 AND doc IN (SELECT chunk_id FROM {_C} WHERE content_type = 'Diagnostic_IU') QUALIFY rank < 20",
    "bm25_terms": f"WITH {_bm25_sql(_Q)} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "vector_topk": "WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS doc, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0) SELECT query_id, doc, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) - 1 AS INTEGER) AS rank FROM s QUALIFY rank < 20",
    "rrf_fusion": f"WITH {_FUSED} SELECT query_id, doc, round(score, 9) AS score FROM fu",
    "hybrid_ranking": f"WITH {_BOOSTED} SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) - 1 AS INTEGER) AS pos, doc, score, in_series, in_type FROM z QUALIFY pos < 15",
    "context_pack": f"""WITH RECURSIVE hits AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS pos, doc FROM ({"WITH " + _BOOSTED + " SELECT query_id, doc, score FROM z"}) QUALIFY pos <= 15),
      cc AS (SELECT chunk_id AS doc, chunk_index AS idx, CAST(length(text) // 4 AS BIGINT) AS tokens FROM {_C} WHERE text IS NOT NULL), cu AS (SELECT *, {_OWN} AS unit FROM cc),
      near AS (SELECT cu.doc, p.doc AS prev_doc, n.doc AS next_doc, cu.tokens, p.tokens AS pt, n.tokens AS nt FROM cu LEFT JOIN cu p ON p.unit = cu.unit AND p.idx = cu.idx - 1 LEFT JOIN cu n ON n.unit = cu.unit AND n.idx = cu.idx + 1),
      items AS (SELECT query_id, doc, tokens, pt, nt, row_number() OVER (PARTITION BY query_id ORDER BY pos, pt NULLS FIRST, nt NULLS FIRST) AS r FROM hits JOIN near USING (doc)),
      step AS (SELECT query_id, 0::BIGINT AS r, 0::BIGINT AS used, NULL::VARCHAR AS doc, false AS wp, false AS wn FROM (SELECT DISTINCT query_id FROM items)
        UNION ALL SELECT query_id, r, CASE WHEN wn THEN u2 + nt ELSE u2 END, doc, wp, wn FROM (SELECT *, nt IS NOT NULL AND u2 + nt <= 10000 AS wn FROM (SELECT *, CASE WHEN wp THEN u1 + pt ELSE u1 END AS u2 FROM (SELECT *, pt IS NOT NULL AND u1 + pt <= 10000 AS wp FROM (SELECT i.query_id, i.r, i.doc, i.pt, i.nt, s.used + i.tokens AS u1 FROM step s JOIN items i ON i.query_id = s.query_id AND i.r = s.r + 1 WHERE s.used + i.tokens <= 10000)))))
      SELECT query_id, CAST(r - 1 AS INTEGER) AS pos, doc, wp AS with_prev, wn AS with_next, CAST(max(used) OVER (PARTITION BY query_id) AS INTEGER) AS used FROM step WHERE r > 0""",
    "adjacent_chunks": f"WITH c AS (SELECT chunk_id AS doc, chunk_index AS idx FROM {_C} WHERE text IS NOT NULL), u AS (SELECT doc, idx, {_OWN} AS unit FROM c) SELECT u.doc, p.doc AS prev_doc, n.doc AS next_doc FROM u LEFT JOIN u p ON p.unit = u.unit AND p.idx = u.idx - 1 LEFT JOIN u n ON n.unit = u.unit AND n.idx = u.idx + 1",
    "chunk_parents": f"WITH c AS (SELECT chunk_id AS doc, content_type FROM {_C}), u AS (SELECT *, {_OWN} AS unit FROM c), e AS (SELECT * FROM canonical_ius_enriched QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY loaded_at) = 1) SELECT doc, unit, coalesce(title, '') AS title, coalesce(nullif(e.content_type, ''), nullif(u.content_type, ''), 'unknown') AS kind FROM u LEFT JOIN e ON e.canonical_id = unit",
    "followup_replay": "WITH s AS (SELECT document_id, arg_min(iu_ids, loaded_at) AS l FROM document_structure GROUP BY 1) SELECT document_id AS query_id, unnest(l) AS doc, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, round(1 / generate_subscripts(l, 1), 6) AS score FROM s",
    "tt_lookup": f"WITH t AS {_TYPES} SELECT tt_id, base AS unit FROM t WHERE tt_id = (SELECT tt_id FROM t GROUP BY 1 ORDER BY count(*) DESC, tt_id LIMIT 1)",
    "zero_vectors": "SELECT DISTINCT chunk_id FROM chunk_embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR x <> 0)) = 0",
    "embedding_todo": f"SELECT chunk_id, CAST(length(text) // 4 AS INTEGER) AS tokens FROM {_C} WHERE text IS NOT NULL AND chunk_id NOT IN (SELECT chunk_id FROM chunk_embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)",
}

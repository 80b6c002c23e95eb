import math
import random
from collections import Counter

from pyspark.sql import functions as F

from manualmill.engine import Engine
from manualmill.operators import bm25, context, fusion, vector
from manualmill.plans import retrieval_queries
from manualmill.providers import HashEmbedder, expansions, resolved


def brute_bm25(docs, query, k1=1.5, b=0.75):
    toks = {d: t.lower().split() for d, t in docs}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = Counter(w for t in toks.values() for w in set(t))
    idf = {w: math.log((n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: v if v >= 0 else 0.25 * mean for w, v in idf.items()}
    out = {}
    for d, t in toks.items():
        tf = Counter(t)
        out[d] = sum(idf[w] * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / avg)) for w in query.lower().split() if w in tf)
    return {d: s for d, s in out.items() if s > 0}


def test_bm25_equals_a_plain_model(spark):
    rng = random.Random(3)
    vocabulary = [f"t{i}" for i in range(40)] + ["the"] * 30
    docs = [(f"d{i}", " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))) for i in range(60)] + [("dup", "the THE t1")]
    queries = [(1, "the t1 t1 t2"), (2, "nothing here"), (3, None), (4, "T5")]
    got = bm25.scores(spark.createDataFrame(queries, "query_id long, text string"), spark.createDataFrame(docs + [("null", None)], "doc string, text string")).collect()
    for q, t in queries:
        want = brute_bm25(docs, t or "")
        mine = {r.doc: r.score for r in got if r.query_id == q}
        assert mine.keys() == {d for d, s in want.items() if round(s, 6) > 0} and all(abs(mine[d] - want[d]) < 1e-5 for d in mine)


def test_vector_ties_and_unusable_rows(spark):
    rows = [("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("c", [0.0, 1.0]), ("zero", [0.0, 0.0]), ("short", [1.0]), ("null", None), ("nan", [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "doc string, v array<double>")
    got = vector.nearest(df.filter("doc IN ('a', 'zero')").withColumnRenamed("doc", "query_id"), df, 2, 2).collect()
    assert [(r.query_id, r.doc, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [("a", "a", 0), ("a", "b", 1)]
    assert vector.nearest(df.limit(0).withColumnRenamed("doc", "query_id"), df, 2, 2).count() == 0
    assert [r.doc for r in vector.all_zero(df, "v").collect()] == ["zero"]


def plain_pack(order, size, prev, nxt, budget):
    used, out = 0, []
    for d in order:
        if used + size[d] > budget:
            break
        used += size[d]
        flags = []
        for near in (prev.get(d), nxt.get(d)):
            ok = near is not None and used + size[near] <= budget
            used += size[near] if ok else 0
            flags.append(ok)
        out.append((d, *flags))
    return out, used


def test_packing_equals_a_plain_model(spark):
    rng = random.Random(5)
    chunks = [(f"u{u}_c{i:03d}", f"u{u}", i, rng.randrange(1, 60)) for u in range(8) for i in range(5)]
    size = {c[0]: c[3] for c in chunks}
    prev = {f"u{u}_c{i:03d}": f"u{u}_c{i - 1:03d}" for u in range(8) for i in range(1, 5)}
    nxt = {v: k for k, v in prev.items()}
    ranking, want = [], {}
    for q in range(30):
        order = rng.sample(list(size), 15)
        ranking += [(q, d, p) for p, d in enumerate(order)]
        want[q] = plain_pack(order, size, prev, nxt, 200)
    got = context.pack(spark.createDataFrame(ranking, "query_id int, doc string, pos int"), spark.createDataFrame(chunks, "doc string, unit string, idx int, tokens int"), budget=200).collect()
    for q, (items, used) in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.pos)
        assert [(r.doc, r.with_prev, r.with_next) for r in mine] == items
        assert all(r.used == used <= 200 for r in mine)


def test_boosts_compose_and_empty_types_filter_nothing(spark):
    fused = spark.createDataFrame([(1, "a_c0", 1.0, "a_v2", "a"), (1, "b_c0", 1.0, "b", "b"), (2, "b_c0", 1.0, "b", "b")], "query_id int, doc string, score double, unit string, base string")
    req = spark.createDataFrame([(1, "S", False, 7, True), (2, "S", False, 8, True)], "query_id int, series string, series_only boolean, tt_id int, tt_only boolean")
    us = spark.createDataFrame([("a_v2", "S")], "unit string, series string")
    ut = spark.createDataFrame([("a", 7)], "base string, tt_id int")
    got = {(r.query_id, r.doc): r.score for r in fusion.boosted(fused, req, us, ut).collect()}
    assert got == {(1, "a_c0"): 9.0, (2, "b_c0"): 1.0}


def test_reciprocal_rank(spark):
    a = spark.createDataFrame([(1, "x", 0), (1, "y", 1)], "query_id int, doc string, rank int")
    got = {r.doc: r.score for r in fusion.reciprocal_rank([a, a.filter("doc = 'y'")]).collect()}
    assert abs(got["x"] - 1 / 60) < 1e-12 and abs(got["y"] - 2 / 61) < 1e-12


def test_engine_end_to_end(spark):
    chunks = spark.createDataFrame([(f"IU{i}_c{k:03d}", k, f"pump number {i} part {k} pressure hose", "Service_IU") for i in range(20) for k in range(3)], "chunk_id string, chunk_index int, text string, content_type string")
    units = spark.createDataFrame([(f"IU{i}", f"Title {i}", "Service_IU", [("A", "p")] if i == 3 else None) for i in range(20)], "canonical_id string, title string, content_type string, appearances array<struct<series:string,filepath:string>>")
    app = spark.createDataFrame([("iu-4", 9)], "iu_miuid string, tt_id int")
    e = Engine(chunks, units, app, embedder=HashEmbedder(32), expand=lambda q: "hose\n\n pump \n")
    got = {r.query_id: r for r in e.query(Engine.of(spark, [(1, "pump number 3", "A", False, None, False), (2, "pump", None, False, 9, True), (3, "zzz", "A", True, None, False)])).collect()}
    assert got[1].sources[0].unit == "IU3" and got[1].context.startswith("[Source: IU3 | Title 3 | Type: Service_IU]")
    assert {s.unit for s in got[2].sources} == {"IU4"}
    assert 3 not in got or {s.unit for s in got[3].sources} == {"IU3"}


def test_engine_opens_what_it_wrote(spark, tmp_path):
    chunks = spark.createDataFrame([(f"IU{i}_c000", 0, f"pump {i} hose", "Service_IU") for i in range(6)], "chunk_id string, chunk_index int, text string, content_type string")
    units = spark.createDataFrame([(f"IU{i}", f"T{i}", "Service_IU", None) for i in range(6)], "canonical_id string, title string, content_type string, appearances array<struct<series:string,filepath:string>>")
    asked = Engine.of(spark, [(1, "pump 3", None, False, None, False)])
    first = Engine(chunks, units, spark.createDataFrame([("iu2", 1)], "iu_miuid string, tt_id int"), embedder=HashEmbedder(16)).warm(str(tmp_path))
    again = Engine.opened(spark, str(tmp_path), embedder=HashEmbedder(16))
    rows = lambda e: [tuple(r) for r in e.rank(asked).orderBy("pos").collect()]
    assert rows(first) == rows(again) and again.health() == {"texts": 6, "vectors": 6, "types": 1, "series": 0, "parents": 6, "without_vector": 0, "ok": True}
    assert again.query(asked).first().sources[0].unit == "IU3"
    assert not Engine.opened(spark, str(tmp_path), embedder=HashEmbedder(8)).health()["ok"]


def test_providers(spark):
    df = spark.createDataFrame([("a\n\n b \nc\nd",), (None,)], "raw string")
    assert [r.x for r in df.select(expansions(F.col("raw")).alias("x")).collect()] == [["a", "b", "c"], None]
    req = spark.createDataFrame([(1, "V1"), (2, "V9"), (3, None)], "query_id int, identifier string")
    ids, types = spark.createDataFrame([("V1", 5)], "identifier string, tt_id int"), spark.createDataFrame([(5, "T", "S")], "tt_id int, tt_name string, series_icecode string")
    got = {r.query_id: (r.tt_name, r.error) for r in resolved(req, ids, types).collect()}
    assert got == {1: ("T", None), 2: (None, "unknown identifier V9"), 3: (None, None)}


def test_hybrid_legs_go_deep_and_are_masked(spark, monkeypatch):
    """The unit of a series_only request ranks 400th of all; one of a request without hard filter 100th by vector."""
    n = 420
    q = retrieval_queries
    scored = spark.createDataFrame([((i, 0), f"IU{k}_c000", float(n - k)) for i in (5, 4) for k in range(n)], "query_id struct<query_id:bigint,leg:int>, doc string, score double")
    asked = spark.createDataFrame([(5, "S", True, 1, False), (4, "T", False, 2, True), (3, "S", False, 1, False)], "query_id bigint, series string, series_only boolean, tt_id int, tt_only boolean")
    near = spark.createDataFrame([(3, f"IU{k}_c000", 1.0, k) for k in range(300)], "query_id bigint, doc string, score double, rank int")
    stand_ins = {"_scored": scored, "_requests": asked, "_unit_series": spark.createDataFrame([("IU400", "S"), ("IU100", "S")], "unit string, series string"), "_unit_types": spark.createDataFrame([("IU410", 2)], "base string, tt_id int"), "_question_vectors": None, "_vectors": None}
    for name, df in stand_ins.items():
        monkeypatch.setattr(q, name, lambda s, d, df=df: df, raising=False)
    monkeypatch.setattr(q.vector, "nearest", lambda a, b, k, dim: near.filter(F.col("rank") < k))
    got = {}
    for r in q._boosted(spark, "").collect():
        got.setdefault(r.query_id, set()).add(r.doc)
    assert got[5] == {"IU100_c000", "IU400_c000"} and got[4] == {"IU410_c000"} and len(got[3]) == 200


def test_engine_masks_the_series_before_the_top_k(spark):
    """The only unit of series S ranks last by keyword and vector, beyond the depth."""
    texts = [(f"IU{i}", "pump pump pump" if i < 30 else "pump and a long text on hoses") for i in range(31)] + [(f"IU{i}", "valve seat") for i in range(40, 110)]
    chunks = spark.createDataFrame([(f"{u}_c000", 0, t, "Service_IU") for u, t in texts], "chunk_id string, chunk_index int, text string, content_type string")
    units = spark.createDataFrame([(u, u, "Service_IU", [("S", "p")] if u == "IU30" else None) for u, _ in texts], "canonical_id string, title string, content_type string, appearances array<struct<series:string,filepath:string>>")
    e = Engine(chunks, units, spark.createDataFrame([], "iu_miuid string, tt_id int"), embedder=HashEmbedder(32), depth=5)
    got = e.rank(Engine.of(spark, [(1, "pump", "S", True, None, False), (2, "pump", "S", False, None, False)])).collect()
    assert [r.doc for r in got if r.query_id == 1] == ["IU30_c000"] and len([r for r in got if r.query_id == 2]) >= 5

import pytest

from manualmill.operators.evaluate import relevance, request_packing
from manualmill.providers import Retrying, identify, resolved, token_matches
from manualmill.sources.tables import lookup, progress, upsert
from pyspark.sql import functions as F


def test_retries_wait_longer_each_time():
    waits, calls = [], []

    def call(x):
        calls.append(x)
        if len(calls) < 4:
            raise OSError("busy")
        return x * 2

    assert Retrying(call, 5, 1.0, 3.0, waits.append)(21) == 42 and waits == [1.0, 2.0, 3.0]
    calls.clear()
    with pytest.raises(OSError):
        Retrying(call, 2, 1.0, 3.0, waits.append)(1)


def test_services(spark):
    req = spark.createDataFrame([(1, "V1", "abc"), (2, "V9", " "), (3, None, None), (4, "V1", "ABC"), (5, "bad", "x")], "query_id int, identifier string, token string")
    assert [r.ok for r in req.orderBy("query_id").select(token_matches(F.col("token"), "abc").alias("ok")).collect()] == [True, False, False, False, False]
    assert req.select(token_matches(F.col("token"), "").alias("ok")).filter("ok").count() == 5
    found = identify(req, lambda v: {"V1": 5, "V9": None}[v])
    got = {r.identifier: (r.tt_id, r.failure) for r in found.collect()}
    assert got == {"V1": (5, None), "V9": (None, None), "bad": (None, "KeyError: 'bad'")}
    types = spark.createDataFrame([(5, "T", "S")], "tt_id int, tt_name string, series_icecode string")
    assert {r.query_id: r.tt_name for r in resolved(req, found.filter("tt_id IS NOT NULL").select("identifier", "tt_id"), types).collect()} == {1: "T", 2: None, 3: None, 4: "T", 5: None}
    asked = spark.createDataFrame([(1, 0, "q", "good text"), (1, 1, "q", "x"), (1, 2, "q", None), (1, 3, "q", "boom")], "query_id int, pos int, query string, text string")

    def judge(q, t):
        return {"good text": " high\n", "x": "maybe"}[t]

    assert [r.rating for r in relevance(asked, judge).orderBy("pos").collect()] == ["HIGH", "?", "?", "?"]
    assert relevance(asked.limit(0), judge).count() == 0


def test_upsert_keeps_the_last_row_of_each_key(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), (None, 1, 1)], "k string, v int, at int")
    new = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("b", 3, 2), ("c", 4, None), (None, 9, 9)], "k string, v int, at int")
    upsert(None, old, f"{tmp_path}/one", "k", order=("at",))
    upsert(spark.read.parquet(f"{tmp_path}/one").drop("key_range"), new, f"{tmp_path}/two", "k", order=("at",))
    assert {(r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/two").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    assert [r.v for r in lookup(spark, f"{tmp_path}/two", "k", ["b", "zz"]).collect()] == [3] and lookup(spark, f"{tmp_path}/two", "k", []).count() == 0
    p = progress(old.filter("k = 'a'"), old.filter("k IS NOT NULL"), "k").first()
    assert (p["items"], p.finished, p.share) == (2, 1, 0.5)


def test_packing_holds_only_the_open_request(spark):
    rows = [(i, 40 if i % 7 else 300) for i in range(200)] + [(1000, None)]
    df = spark.createDataFrame(rows, "id int, n int")
    got = request_packing(df, "id", "n", F.pmod("id", F.lit(2)), 5, 200).collect()
    per = {}
    for r in sorted(got, key=lambda r: (r.shard, r.item)):
        per.setdefault((r.shard, r.request), []).append(r.tokens)
    assert len(got) == 200 and all(len(x) <= 5 and (sum(x) <= 200 or len(x) == 1) for x in per.values())

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from manualmill.llm.representative_queries import rules
from manualmill.llm.representatives import groups, suppliers, survivors
from manualmill.functions.ids import unit_key

SCHEMA = "mapping_id long, canonical_id string, variant_count int, source_series string, appearances array<struct<series:string,filepath:string>>, loaded_at timestamp, `key` int, rank string, field string"


def plain(rows):
    by = {}
    for r in rows:
        if r[1] and r[1].strip():
            by.setdefault(r[1].strip().upper(), []).append(r)
    out = set()
    for k, rs in by.items():
        recent = lambda r: (r[5] is not None, r[5] or datetime.min, r[0])
        pairs = lambda r: len({(a[0].strip(), a[1].strip()) for a in r[4] or [] if a[0] and a[1] and a[0].strip() and a[1].strip()})
        import re

        for field, ok, rank in (("variant_count", lambda r: r[2] is not None and 1 <= r[2] <= 99, recent), ("source_series", lambda r: bool(r[3]) and bool(re.fullmatch(r"[A-Za-z]\.[A-Za-z]\.\d\d\.\d{3}", r[3].strip())), recent), ("appearances", lambda r: pairs(r) > 0, lambda r: (pairs(r), *recent(r)))):
            good = [r for r in rs if ok(r)]
            if good:
                out.add((k, field, max(good, key=rank)[0]))
    return out


def test_same_as_plain_model(spark):
    rng = random.Random(4)
    t0 = datetime(2025, 1, 1)
    rows = []
    for i in range(400):
        app = rng.choice([None, [], [("A", "p"), (" A ", "p")], [("A", "p"), ("B", None)], [("A", "p"), ("B", "q")], [(" ", "x")]])
        unit = "HOT" if i % 3 == 0 else rng.choice(["u1", " U1", "u2", "U3 ", None, " "])
        rows.append((i, unit, rng.choice([None, -1, 0, 1, 7, 99, 100]), rng.choice([None, "", "A.B.01.123", " a.b.01.999 ", "n/a"]), app, rng.choice([None, t0 + timedelta(days=rng.randrange(3))]), 1, "x", "y"))
    df = spark.createDataFrame(rows, SCHEMA)
    got = suppliers(df, unit_key(F.col("canonical_id")), "mapping_id", "loaded_at", rules())
    assert {(r.key, r.field, r.row_id) for r in got.collect()} == plain(rows)
    one = {r.key: r for r in survivors(df, unit_key(F.col("canonical_id")), "mapping_id", "loaded_at", rules()).collect()}
    assert set(one) == {"HOT", "U1", "U2", "U3"} and 1 <= one["HOT"].variant_count <= 99
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    assert groups(df.limit(0), F.col("canonical_id"), "mapping_id").count() == 0
    assert suppliers(df.limit(0), unit_key(F.col("canonical_id")), "mapping_id", "loaded_at", rules()).count() == 0

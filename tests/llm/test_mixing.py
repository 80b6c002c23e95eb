from pyspark.sql import functions as F

from manualmill.llm.mixing import MixParams, Share, mix, plan, schedule, token_sizes


def test_schedule_stays_within_one_block():
    for weights in ([0.5, 0.3, 0.2], [0.34, 0.33, 0.33], [0.01, 0.99], [0.125] * 8):
        shares = [Share(f"s{i}", w, 10**6, 1, int(w * 100_000)) for i, w in enumerate(weights)]
        _, slots = schedule(shares, 1000)
        count = {s.source: 0 for s in shares}
        for t, s, j in slots[: int(len(slots) * 0.98)]:
            assert j == count[s]
            count[s] += 1
            assert all(abs(count[x.source] - x.weight * (t + 1)) < 1 + 1e-6 for x in shares)


def test_plan_is_the_largest_that_keeps_shares():
    got = plan({"a": 100, "b": 1000, "d": 5}, [("a", 0.5, 2), ("b", 0.5, 1), ("missing", 0.2, 3), (None, 0.1, 1), ("d", 0.0, 1)])
    assert [(s.source, s.quota) for s in got] == [("a", 200), ("b", 200)]
    assert plan({}, [("a", 1.0, 1)]) == []


def test_mix(spark):
    rows = [(i, "big" if i % 3 else "small", "word " * (5 + i % 7)) for i in range(600)] + [(1000, None, "x"), (1001, "big", None), (1002, "big", ""), (1003, "other", "y y")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("tokens", F.lit(1))
    targets = spark.createDataFrame([("big", 0.2, 1), ("small", 0.7, 3), ("none", 0.1, 2)], "source string, target_weight double, max_repeats int")
    p = MixParams(slots=50, ranges=8)
    sized = token_sizes(docs, "doc_id", "text", "source", p)
    sel, shares = mix(sized, targets, p)
    got = sel.collect()
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append(r.repeat)
    assert all(sorted(x) == list(range(len(x))) and len(x) <= 3 for x in per.values())
    s = {r.source: r for r in shares.collect()}
    assert abs(s["small"].actual_share - 7 / 9) < 0.01 and abs(s["big"].actual_share - 2 / 9) < 0.01
    assert s["none"].actual_share == 0 and s["other"].mixed_tokens == 0 and s["small"].repeats == 3
    streams = {}
    for r in sorted(got, key=lambda r: (r.source, r.position)):
        assert streams.get(r.source, 0) == r.position  # no gap before the quota's end
        streams[r.source] = r.position + r.tokens
    sel0, shares0 = mix(sized.limit(0), targets, p)
    assert sel0.count() == 0 and all(r.actual_share == 0 for r in shares0.collect())

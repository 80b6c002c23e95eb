import random

from pyspark.sql import functions as F

from manualmill.llm import leakage as L

WORDS = [f"w{i}" for i in range(300)]


def brute(docs, items, n=13):
    grams = {}
    for i, p in items:
        ws = L.words(p or "")
        for j in range(len(ws) - n + 1):
            grams.setdefault(tuple(ws[j : j + n]), set()).add(i)
    out = set()
    for d, t in docs:
        ws = L.words(t or "")
        for j in range(len(ws) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(ws[j : j + n]), ()) if d is not None}
    return out


def test_same_as_brute_force(spark):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([12, 13, 40, 70])))) for i in range(30)] + [(98, None), (99, "short")]
    docs = []
    for d in range(150):
        own = [rng.choice(WORDS) for _ in range(rng.randrange(0, 120))]
        if d % 2:
            ws = items[rng.randrange(30)][1].split()
            n = rng.choice([12, 13, 14, 30])
            s = rng.randrange(max(1, len(ws) - n + 1))
            at = rng.randrange(len(own) + 1)
            own[at:at] = [w.upper() if d % 3 else w[0] + "\u200b" + w[1:] for w in ws[s : s + n]]
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(own)))
    docs += [(500, None), (501, ""), (None, items[2][1]), (502, "x " * 40_000 + items[3][1]), (0, docs[0][1])]
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("run", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, passage string").withColumn("text", F.lit(0))
    got = L.leaks(a, "doc_id", "text", b, "item_id", "passage", L.Retrieval(vocabulary=1 << 12, rank=160, sample_docs=100, min_cosine=0.3)).filter("kind = 'copied'")
    found, want = {(r.doc_id, r.item_id) for r in got.collect()}, brute(docs, items)
    assert found <= want and len(found) >= 0.95 * len(want)
    assert L.leaks(a.limit(0), "doc_id", "text", b, "item_id", "passage").count() == 0
    assert L.leaks(a, "doc_id", "text", b.limit(0), "item_id", "passage").count() == 0


def test_lcs_and_runs():
    assert L.lcs_length("a b c d".split(), "b x d a".split()) == 2 and L.lcs_length([], ["a"]) == 0
    a, b = "x a b c d y".split(), "q a b c d z".split()
    assert L.longest_run(a, L.grams(a, 2), b, L.grams(b, 2), 2) == 4 and L.longest_run(a, L.grams(a, 5), b, L.grams(b, 5), 5) == 0


def test_paraphrase_in_a_window_that_is_not_the_nearest(spark):
    """A window of the passage's words in reverse is nearer than the paraphrase, but shares no sequence with it."""
    passage = [f"p{i}" for i in range(18)] + ["42"]
    near = passage[::-1]
    told = [w if i % 4 else f"q{i}" for i, w in enumerate(passage)]
    doc = near + [f"x{i}" for i in range(19)] + told
    fill = [(i, " ".join(f"z{i}w{j}" for j in range(40))) for i in range(1, 30)]
    a = spark.createDataFrame([(0, " ".join(doc)), *fill], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(passage))], "item_id long, passage string")
    got = L.leaks(a, "doc_id", "text", b, "item_id", "passage").collect()
    assert [(r.doc_id, r.item_id, r.kind) for r in got] == [(0, 7, "paraphrased")]

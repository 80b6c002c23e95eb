import random

from pyspark.sql import functions as F

from manualmill.llm import toxicity as T


def corpus(n, seed):
    rng = random.Random(seed)
    parts = ["pump", "valve", "hose", "filter", "belt", "clamp", "gear"]
    fine = ["Replace the {0} behind the {1} and tighten it evenly.", "Check the {0} for wear before you fit the {1}.", "This damn {0} would not come off the {1}.", "Fit a new {0} next to the {1} at 5.6 bar."]
    bad = ["You are nothing but a brainless {2} and a liar.", "Shut your filthy mouth, {2}, nobody asked you.", "Whoever wrote this is a worthless {2}."]
    names = ["idiot", "moron", "clown", "scumbag"]
    rows = []
    for i in range(n):
        text = [rng.choice(fine).format(rng.choice(parts), rng.choice(parts)) for _ in range(rng.randrange(3, 9))]
        toxic = i % 8 == 0
        if toxic:
            s = rng.choice(bad).format(0, 0, rng.choice(names))
            text.insert(rng.randrange(len(text)), rng.choice([s, s.upper(), s.replace("o", "0"), s.replace("i", "iiii")]))
        rows.append((i, " ".join(text), toxic))
    return rows


def test_folding():
    assert T.fold("yоur mоthеr") == "your mother" and T.fold("r e t a r d e d") == "retarded" and T.fold("w*****r **Parts** s**t") == "w*r  parts  s*t"
    assert "clown" in T.fold("you clooooown") and "stupid" in T.fold("$tup1d") and "ke" not in T.fold("part KE012345")


def test_held_out_accuracy(spark):
    train, test = corpus(800, 1), corpus(400, 2)
    rng = random.Random(3)
    labels = [(i, int(t) if rng.random() > (0.01 if t else 0.03) else 1 - int(t)) for i, _, t in train] + [(0, None), (1, 1), (1, 0), (None, 1)]
    docs = spark.createDataFrame([(i, x) for i, x, _ in train] + [(10_000 + i, x) for i, x, _ in test] + [(20_000, None), (20_001, ""), (20_002, "x " * 50_000)], "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("toxic", F.lit("clash"))
    model = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "text", "toxic")
    got = {r.doc_id: r for r in T.score(docs, "doc_id", "text", model).collect()}
    want = {10_000 + i for i, _, t in test if t}
    found = {i for i in got if 10_000 <= i < 20_000 and got[i].toxic}
    assert len(found & want) >= 0.9 * len(want) and len(found - want) <= 0.05 * len(want)
    assert got[20_000].score is None and not got[20_000].toxic and got[20_001].score == -1 and len(got) == 1203
    none = T.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), "doc_id", "text", "toxic")
    assert T.score(docs, "doc_id", "text", none).filter("toxic").count() == 0 and T.score(docs.limit(0), "doc_id", "text", model).count() == 0


def test_rough_phrase_hit_by_wrong_labels():
    """A phrase about a machine, in one document of 200, whose labels are wrong more often than others (6 of 20 against 4 of 100)."""
    rng = random.Random(4)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) for _ in range(400)]
    bad, names, rough = ["You are nothing but a brainless {}.", "Shut your filthy mouth, {}.", "Whoever wrote this is a worthless {}."], ["idiot", "moron", "clown", "scumbag"], "This wiring is a hell of a mess."
    texts, labels = [], []
    for i in range(4000):
        text = [" ".join(rng.choices(words, k=rng.randrange(6, 12))).capitalize() + "." for _ in range(10)]
        toxic, mess = i % 25 == 0, i % 200 == 1
        if toxic:
            text.insert(rng.randrange(9), rng.choice(bad).format(rng.choice(names)))
        if mess:
            text.insert(rng.randrange(9), rough)
        texts.append(" ".join(text))
        labels.append(toxic if rng.random() > (0.3 if mess else 0.04) else not toxic)
    m = T.fit_windows(texts, labels, T.Params())
    assert sum(labels[1::200]) == 6 and m.score(rough)[0] < 0 and all(m.score(b.format(n))[0] > m.threshold for b in bad for n in names)

import random
from fractions import Fraction

import numpy as np
import pytest

from manualmill.llm import neardup as N


def brute(rows, t=Fraction(4, 5), least=30):
    sets = {}
    for i, x in rows:
        if i is not None and x is not None and len(set(x.split())) >= least:
            sets.setdefault(i, []).append(set(x.split()))
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if any(len(x & y) >= t * len(x | y) for x in sets[a] for y in sets[b])}


def edited(rng, words, changes, vocabulary):
    out = list(words)
    for _ in range(changes):
        k = rng.randrange(3)
        if k == 0 and out:
            out[rng.randrange(len(out))] = rng.choice(vocabulary)
        elif k == 1:
            out.insert(rng.randrange(len(out) + 1), rng.choice(vocabulary))
        elif len(out) > 1:
            out.pop(rng.randrange(len(out)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("vocabulary_size", [60, 400, 20_000])
def test_same_pairs_as_brute_force(spark, vocabulary_size):
    """Small vocabularies make every token common, so nothing tells the texts apart but their combinations."""
    rng = random.Random(vocabulary_size)
    vocabulary = [f"w{i}" for i in range(vocabulary_size)]
    rows = []
    for g in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([31, 45, 90, 200, 700]))]
        for v in range(4):
            rows.append((f"u{g}_{v}", " ".join(edited(rng, words, rng.randrange(1 + len(words) // 6), vocabulary))))
    rows += [("copy1", rows[0][1]), ("copy2", rows[0][1]), ("copy2", rows[0][1]), ("none", None), (None, rows[0][1]), ("empty", ""), ("short", "a b c"), ("long", " ".join(f"x{i}" for i in range(30_000)))]
    df = spark.createDataFrame(rows, "canonical_id string, content_md string").selectExpr("*", "1 AS class_id", "'x' AS tokens")
    found = N.near_duplicates(df, "canonical_id", "content_md")
    assert {tuple(r) for r in N.item_pairs(found).collect()} == brute(rows)


def test_groups_and_empty_table(spark):
    base = [f"w{i}" for i in range(100)]
    chain = [" ".join(base[: 100 - 6 * k] + [f"n{j}" for j in range(6 * k)]) for k in range(4)]
    rows = [(f"c{k}", t) for k, t in enumerate(chain)] + [("copy", chain[0]), ("alone", " ".join(f"z{i}" for i in range(50)))]
    df = spark.createDataFrame(rows, "id string, t string")
    g = {r.item_id: r for r in N.item_groups(N.near_duplicates(df, "id", "t")).collect()}
    assert len({g[f"c{k}"].group_id for k in range(4)} | {g["copy"].group_id}) == 1
    assert g["alone"].links == 0 and g["alone"].group_id != g["c0"].group_id
    assert N.item_pairs(N.near_duplicates(df.limit(0), "id", "t")).count() == 0


def test_counters_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x, y = (np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(2))
        assert N._apart(*(N.counters([v]) for v in (x, y)))[0] <= len(np.setxor1d(x, y))

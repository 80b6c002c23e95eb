from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from manualmill.llm.neighbour_queries import nearest
from manualmill.llm.neighbours import Search, neighbours


def brute(ids, x, k, least):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    g = x @ x.T
    out = set()
    for i, a in enumerate(ids):
        best = sorted((j for j in range(len(ids)) if j != i and g[i, j] >= least), key=lambda j: (-round(g[i, j], 9), ids[j]))[:k]
        out |= {(a, ids[j]) for j in best}
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(250, 64))
    x = np.concatenate([c + rng.normal(size=(rng.integers(1, 9), 64)) * rng.uniform(0.05, 0.33) for c in centres]).astype(np.float32)
    x = np.concatenate([x, np.repeat(x[:1] * 2, 1, 0)])
    ids = [f"v{i:05d}" for i in range(len(x))]
    t = datetime(2025, 1, 1)
    rows = [(i, v.tolist(), t) for i, v in zip(ids, x)] + [(ids[3], x[3].tolist(), t), ("null", None, t), ("zero", [0.0] * 64, t), ("short", [1.0], t), ("hole", [1.0] * 63 + [None], t), (None, [1.0] * 64, t)]
    df = spark.createDataFrame(rows, "chunk_id string, embedding array<float>, embedded_at timestamp").withColumn("class_id", F.lit(1)).withColumn("v", F.lit("x"))
    got = {(r.item_id, r.neighbour_id) for r in neighbours(df, "chunk_id", "embedding", "embedded_at").collect()}
    want = brute(ids, x.astype(float), 5, 0.9)
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(want)


def test_hot_copies_and_crowded_cells(spark):
    """A third of all rows are copies of one vector, another third lies close together."""
    rng = np.random.default_rng(3)
    one, centre = rng.normal(size=(2, 64))
    x = np.concatenate([np.repeat(one[None], 300, 0), centre + rng.normal(size=(300, 64)) * 0.02, rng.normal(size=(300, 64))]).astype(np.float32)
    df = spark.createDataFrame([(f"v{i:04d}", v.tolist(), None) for i, v in enumerate(x)], "id string, e array<float>, at timestamp")
    got = neighbours(df, "id", "e", "at", Search(crowded=64, reach=16)).collect()
    by = {}
    for r in got:
        by.setdefault(r.item_id, []).append((r["rank"], r.neighbour_id, r.cosine))
    for i in range(300):
        want = [f"v{j:04d}" for j in range(6) if j != i][:5]
        assert [n for _, n, _ in sorted(by[f"v{i:04d}"])] == want
    assert all(len(by[f"v{i:04d}"]) == 5 and min(c for *_, c in by[f"v{i:04d}"]) > 0.95 for i in range(300, 600))
    assert neighbours(df.limit(0), "id", "e", "at").count() == 0


def test_dense_cloud_above_the_crowded_limit(spark):
    """A third of 36,000 vectors lies at a mean cosine of about 0.99, at the parameters of the queries."""
    rng = np.random.default_rng(4)
    n, dense = 36_000, 12_000
    centre = rng.normal(size=64)
    cloud = centre / np.linalg.norm(centre) + rng.normal(size=(dense, 64)) * np.sqrt(0.01 / 64)
    x = np.concatenate([cloud * rng.uniform(0.5, 2, size=(dense, 1)), rng.normal(size=(n - dense, 64))]).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "e": x.tolist()}), "id long, e array<float>").withColumn("at", F.lit(0))
    got = neighbours(df, "id", "e", "at", Search(dim=64, k=5, min_cosine=0.90)).filter(F.col("item_id") < dense).toPandas()
    u = x[:dense].astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    found = set(zip(got["item_id"], got["neighbour_id"]))
    true = []
    for s in range(0, dense, 1000):
        g = u[s : s + 1000] @ u.T
        g[np.arange(len(g)), s + np.arange(len(g))] = -2
        true += [(s + i, int(j)) for i, r in enumerate(np.argpartition(g, -5, axis=1)[:, -5:]) for j in r]
    assert len(found & set(true)) >= 0.999 * len(true)


def test_every_chunk_gets_k_neighbours(spark, tmp_path):
    """Unrelated vectors have no partner at 0.90, yet each has its five most similar."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(1200, 64)), np.repeat(rng.normal(size=(1, 64)), 8, 0)]).astype(np.float32)
    x[7] = -x[3]
    ids = [f"v{i:04d}" for i in range(len(x))]
    spark.createDataFrame([(i, v.tolist(), datetime(2025, 1, 1)) for i, v in zip(ids, x)], "chunk_id string, embedding array<float>, embedded_at timestamp").write.parquet(f"{tmp_path}/chunk_embeddings.parquet")
    got = nearest(spark, str(tmp_path)).collect()
    assert {(r.chunk_id, r.neighbour) for r in got} == brute(ids, x.astype(float), 5, -2) and len(got) == 5 * len(x)
    few = spark.createDataFrame([("a", [1.0] + [0.0] * 63, 0), ("b", [-1.0] + [0.0] * 63, 0)], "id string, e array<float>, at int")
    assert {(r.item_id, r.neighbour_id, r.cosine) for r in neighbours(few, "id", "e", "at", Search(whole=True)).collect()} == {("a", "b", -1.0), ("b", "a", -1.0)}

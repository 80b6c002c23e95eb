"""Exact cosine top-k of query vectors against all vectors.

Queries are taken in blocks of a fixed size, each held by every task as one matrix; a task
keeps the k best of each query among its rows, and a window merges them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manualmill.operators.bm25 import top


def usable(df: DataFrame, vector: str, dim: int) -> DataFrame:
    v = F.col(vector)
    return df.filter((F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & F.exists(v, lambda x: x != 0))


def all_zero(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector holds nothing but zeros."""
    return df.filter(F.col(vector).isNotNull() & F.forall(F.col(vector), lambda x: x == 0))


def nearest(queries: DataFrame, rows: DataFrame, k: int, dim: int, block: int = 2048, digits: int = 6) -> DataFrame:
    """(query_id, doc, score, rank): queries (query_id, v), rows (doc, v). Vectors of another length, null or all zero take no part."""
    spark = rows.sparkSession
    src = usable(rows, "v", dim).select("doc", F.col("v").cast("array<double>").alias("v"))
    doc_type, id_type = dict(rows.dtypes)["doc"], dict(queries.dtypes)["query_id"]
    schema = f"query_id {id_type}, doc {doc_type}, score double"
    held, out = [], None

    def search(ids: list, matrix: np.ndarray) -> DataFrame:
        sent = spark.sparkContext.broadcast((ids, matrix / np.linalg.norm(matrix, axis=1, keepdims=True)))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, q = sent.value
            for b in batches:
                for s in range(0, len(b), 4096):
                    part = b.iloc[s : s + 4096]
                    x = np.stack(part["v"].to_numpy())
                    cos = np.round((x @ q.T) / np.linalg.norm(x, axis=1)[:, None], digits)
                    docs = part["doc"].to_numpy()
                    if len(docs) > k:  # all that tie with the k-th stay, the window decides
                        least = np.partition(cos, len(docs) - k, axis=0)[len(docs) - k]
                        i, j = np.nonzero(cos >= least[None, :])
                    else:
                        i, j = np.nonzero(np.ones_like(cos, bool))
                    yield pd.DataFrame({"query_id": [names[x] for x in j], "doc": docs[i], "score": cos[i, j]})

        return src.mapInPandas(run, schema)

    for r in usable(queries, "v", dim).select("query_id", "v").toLocalIterator():
        held.append((r.query_id, r.v))
        if len(held) == block:
            part = search([i for i, _ in held], np.array([v for _, v in held], float))
            out, held = part if out is None else out.unionByName(part), []
    if held or out is None:
        part = search([i for i, _ in held], np.array([v for _, v in held], float)) if held else spark.createDataFrame([], schema)
        out = part if out is None else out.unionByName(part)
    return top(out, k)

"""BM25 over a corpus for a batch of queries, by a stored index.

``Index.build`` writes the postings once: every document's in one slice, slices sorted by
term, and the weights of all terms beside them (terms that more than half of the documents
hold get a share of the mean weight, so the whole vocabulary is needed). ``Index.scores``
joins the postings with the terms of its queries; as a document lies in one slice, its
score is added up before anything is shuffled. The corpus is not read again.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from manualmill.functions.text import tokens
from manualmill.session import materialise, shared_dir


@dataclass(frozen=True)
class Bm25:
    k1: float = 1.5
    b: float = 0.75
    floor: float = 0.25  # share of the mean weight for terms with a negative one
    digits: int = 6


def tokenised(docs: DataFrame) -> DataFrame:
    """(doc, t) of (doc, text)."""
    return docs.filter("text IS NOT NULL").select("doc", tokens(F.col("text")).alias("t"))


def _weights(df: DataFrame, size: DataFrame, p: Bm25) -> DataFrame:
    """(term, df, idf, avgdl) of (term, df) and the single row (n, avgdl)."""
    raw = df.crossJoin(F.broadcast(size)).withColumn("raw", F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)))  # size is a single row
    mean = raw.agg(F.avg("raw").alias("mean"))
    return raw.crossJoin(F.broadcast(mean)).select("term", "df", F.when(F.col("raw") < 0, F.lit(p.floor) * F.col("mean")).otherwise(F.col("raw")).alias("idf"), "avgdl")


def asked_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, times) of queries (query_id, text)."""
    return queries.filter("text IS NOT NULL").select("query_id", F.explode(tokens(F.col("text"))).alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))


MOST_BROADCAST = 200_000  # (query, term) rows, some 10 MB
_LENGTH = ""  # no token: the posting of this name tells a document's length, also that of an empty one


@dataclass(frozen=True)
class Index:
    """postings: term, doc, dl, tf; terms: term, df, idf, avgdl."""

    postings: DataFrame
    terms: DataFrame
    p: Bm25 = Bm25()

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None, p: Bm25 = Bm25(), slices: int | None = None) -> Index:
        """Writes the index of docs (doc, text) under ``path``, by default in the shared folder; an index that is there is replaced. Null texts are not part of it."""
        spark = docs.sparkSession
        path = path or os.path.join(shared_dir(spark), f"bm25-{uuid.uuid4().hex}")
        src = docs.filter("text IS NOT NULL").select("doc", "text")
        split = tokenised(src.repartition(slices, "doc") if slices else src.repartition("doc"))
        tf = split.select("doc", F.size("t").alias("dl"), F.explode(F.array_append("t", F.lit(_LENGTH))).alias("term")).groupBy("doc", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
        tf.sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
        stored = spark.read.parquet(f"{path}/postings")
        size = stored.filter(F.col("term") == _LENGTH).agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))
        df = stored.filter(F.col("term") != _LENGTH).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        _weights(df, size, p).write.mode("overwrite").parquet(f"{path}/terms")
        return cls.open(spark, path, p)

    @classmethod
    def open(cls, spark: SparkSession, path: str, p: Bm25 = Bm25()) -> Index:
        """An index written before."""
        return cls(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"), p)

    def scores(self, queries: DataFrame) -> DataFrame:
        """(query_id, doc, score > 0) of queries (query_id, text); repeated query tokens count each time."""
        p = self.p
        weights = self.terms.select("term", "idf", "avgdl")
        terms = materialise(asked_terms(queries), "asked")
        few = terms.count() <= MOST_BROADCAST
        if few:  # a batch of queries against a corpus: the terms go to the postings, whatever the size of these in files
            weights = weights.join(F.broadcast(terms.select("term").distinct()), "term", "left_semi")
        asked = terms.join(weights, "term")
        asked = F.broadcast(asked) if few else asked
        part = F.col("times") * F.col("idf") * F.col("tf") * (p.k1 + 1) / (F.col("tf") + p.k1 * (1 - p.b + p.b * F.col("dl") / F.col("avgdl")))
        out = self.postings.filter(F.col("term") != _LENGTH).join(asked, "term").groupBy("query_id", "doc").agg(F.round(F.sum(part), p.digits).alias("score"))
        return out.filter("score > 0")


def scores(self, queries: DataFrame) -> DataFrame:
        """(query_id, doc, score > 0) of queries (query_id, text); repeated query tokens count each time."""
        p = self.p
        asked = asked_terms(queries).join(self.terms.select("term", "idf", "avgdl"), "term").withColumn("bucket", _bucket(F.col("term"), self.buckets))
        part = F.col("times") * F.col("idf") * F.col("tf") * (p.k1 + 1) / (F.col("tf") + p.k1 * (1 - p.b + p.b * F.col("dl") / F.col("avgdl")))
        out = self.postings.join(asked, ["bucket", "term"]).groupBy("query_id", "doc").agg(F.round(F.sum(part), p.digits).alias("score"))
        return out.filter("score > 0")


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def scores(queries: DataFrame, docs: DataFrame, p: Bm25 = Bm25()) -> DataFrame:
    """The scores of queries (query_id, text) over docs (doc, text) by an index that is built for them alone."""
    return Index.build(docs, p=p).scores(queries)


def top(scored: DataFrame, k: int) -> DataFrame:
    """The k best per query with a rank from 0; ties go to the smaller doc."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc")
    return scored.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("query_id", "doc", "score", (F.col("place") - 1).alias("rank"))

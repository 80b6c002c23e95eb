"""Packing ranked chunks and their neighbours into a budget of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_CHUNKS, BUDGET = 15, 10_000


def adjacent(chunks: DataFrame) -> DataFrame:
    """(doc, prev_doc, next_doc) of chunks (doc, unit, idx): the chunks before and after in the same unit."""
    c = chunks.select("doc", "unit", "idx")
    near = lambda by, name: c.select("unit", (F.col("idx") + by).alias("idx"), F.col("doc").alias(name))
    return c.join(near(1, "prev_doc"), ["unit", "idx"], "left").join(near(-1, "next_doc"), ["unit", "idx"], "left").select("doc", "prev_doc", "next_doc")


def _fold(items: Column, budget: int) -> Column:
    """Sequential packing: stop at the first chunk that does not fit; then its neighbours, before and after, each if it still fits."""
    state = F.struct(F.lit(0).alias("used"), F.lit(False).alias("stop"), F.array().cast("array<struct<doc:string,prev:boolean,next:boolean>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        fits = ~s["stop"] & (s["used"] + x["tokens"] <= budget)
        used = s["used"] + x["tokens"]
        prev = x["prev_tokens"].isNotNull() & (used + x["prev_tokens"] <= budget)
        used = used + F.when(prev, x["prev_tokens"]).otherwise(0)
        nxt = x["next_tokens"].isNotNull() & (used + x["next_tokens"] <= budget)
        used = used + F.when(nxt, x["next_tokens"]).otherwise(0)
        taken = F.struct(used.alias("used"), F.lit(False).alias("stop"), F.concat(s["out"], F.array(F.struct(x["doc"].alias("doc"), prev.alias("prev"), nxt.alias("next")))).alias("out"))
        stopped = F.struct(s["used"].alias("used"), F.lit(True).alias("stop"), s["out"].alias("out"))
        return F.when(fits, taken).otherwise(stopped)

    return F.aggregate(items, state, step)


def pack(ranking: DataFrame, chunks: DataFrame, budget: int = BUDGET, most: int = MOST_CHUNKS) -> DataFrame:
    """(query_id, pos, doc, with_prev, with_next, used): ranking (query_id, doc, pos), chunks (doc, unit, idx, tokens).

    The first ``most`` are cut off before unknown docs are skipped. A neighbour that is a
    hit itself may appear twice. A query holds at most ``most`` rows, so its fold is bounded.
    """
    size = chunks.select("doc", "tokens")
    near = adjacent(chunks)
    x = ranking.filter(F.col("pos") < most).join(size, "doc").join(near, "doc", "left")
    x = x.join(size.select(F.col("doc").alias("prev_doc"), F.col("tokens").alias("prev_tokens")), "prev_doc", "left").join(size.select(F.col("doc").alias("next_doc"), F.col("tokens").alias("next_tokens")), "next_doc", "left")
    items = F.sort_array(F.collect_list(F.struct("pos", "doc", "tokens", "prev_tokens", "next_tokens")))
    packed = x.groupBy("query_id").agg(items.alias("items")).select("query_id", _fold(F.col("items"), budget).alias("s"))
    return packed.select("query_id", "s.used", F.posexplode("s.out").alias("pos", "o")).select("query_id", "pos", F.col("o.doc").alias("doc"), F.col("o.prev").alias("with_prev"), F.col("o.next").alias("with_next"), "used")


def source_header(unit: Column, title: Column, kind: Column) -> Column:
    return F.format_string("[Source: %s | %s | Type: %s]", unit, F.coalesce(title, F.lit("")), F.coalesce(F.nullif(kind, F.lit("")), F.lit("unknown")))


def blocks(packed: DataFrame, texts: DataFrame, parents: DataFrame) -> DataFrame:
    """(query_id, context): the packed chunks with their neighbours and headers. texts: (doc, unit, idx, text, kind); parents: (unit, title, kind)."""
    near = adjacent(texts)
    t = texts.select("doc", "unit", "text", F.col("kind").alias("own_kind"))
    x = packed.join(near, "doc").join(t, "doc").join(parents.select("unit", "title", "kind"), "unit", "left")
    x = x.join(texts.select(F.col("doc").alias("prev_doc"), F.col("text").alias("before")), "prev_doc", "left").join(texts.select(F.col("doc").alias("next_doc"), F.col("text").alias("after")), "next_doc", "left")
    body = F.concat_ws("\n\n", F.when(F.col("with_prev"), F.col("before")), F.col("text"), F.when(F.col("with_next"), F.col("after")))
    block = F.concat(source_header(F.col("unit"), F.col("title"), F.coalesce(F.nullif(F.col("kind"), F.lit("")), F.col("own_kind"))), F.lit("\n"), body)
    one = x.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("pos", block.alias("block")))).alias("b"))
    return one.select("query_id", F.array_join(F.col("b.block"), "\n\n---\n\n").alias("context"))


def replay(sources: DataFrame) -> DataFrame:
    """(query_id, doc, score, pos) of (query_id, docs array): the sources of an earlier turn, scored by their place."""
    return sources.select("query_id", F.posexplode("docs").alias("pos", "doc")).withColumn("score", 1.0 / (F.col("pos") + 1))

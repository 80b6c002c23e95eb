"""Evaluation of rankings, costs and token budgets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_ratings(ranking: DataFrame, ratings: DataFrame) -> DataFrame:
    """ranking (query_id, pos, …) with ratings (query_id, pos, rating); a missing rating is ``?``."""
    return ranking.join(ratings.select("query_id", "pos", "rating"), ["query_id", "pos"], "left").withColumn("rating", F.coalesce("rating", F.lit("?")))


def precision(rated: DataFrame, good: str = "HIGH") -> DataFrame:
    """(query_id, high, total, precision); the row with a null query_id is the whole batch, weighted by rows. No rows give a null precision."""
    one = rated.rollup("query_id").agg(F.count_if(F.col("rating") == good).alias("high"), F.count(F.lit(1)).alias("total"))
    return one.withColumn("precision", F.round(F.try_divide(F.col("high").cast("double"), F.col("total")), 6))


def cost(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    """In units of price per million tokens; unknown prices cost nothing."""
    return F.coalesce((tokens_in * price_in + tokens_out * price_out) / 1e6, F.lit(0.0))


def cost_rollup(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """calls (name, model, tokens_in, tokens_out), prices (model, price_in, price_out): totals by name and model."""
    x = calls.join(prices, "model", "left").withColumn("cost", cost(F.col("tokens_in"), F.col("tokens_out"), F.col("price_in"), F.col("price_out")))
    return x.groupBy("name", "model").agg(F.count(F.lit(1)).alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.round(F.sum("cost"), 6).alias("cost"))


def sliding_tokens(df: DataFrame, at: str, tokens: str, seconds: int, by: str) -> DataFrame:
    """Tokens used within the last ``seconds`` up to each row, per ``by``."""
    us = F.unix_micros(F.col(at).cast("timestamp"))
    w = Window.partitionBy(by).orderBy(us).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("in_window", F.sum(tokens).over(w))


def request_packing(df: DataFrame, item: str, tokens: str, shard: Column, most_inputs: int = 2048, most_tokens: int = 250_000) -> DataFrame:
    """(shard, item, tokens, request): consecutive items packed greedily until a request is full; an item over the limit goes alone.

    Packing is sequential, so a shard is one task: its items arrive sorted, batch by batch,
    and only the state of the open request is held. Take as many shards as tasks.
    """
    types = dict(df.dtypes)
    src = df.select(shard.alias("shard"), F.col(item).alias("item"), F.col(tokens).cast("long").alias("tokens"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, request, inputs, used = None, 0, 0, 0
        for b in batches:
            out = []
            for name, n in zip(b["shard"].array, b["tokens"].array):
                if name != at:
                    at, request, inputs, used = name, 0, 0, 0
                if inputs and (inputs >= most_inputs or used + n > most_tokens):
                    request, inputs, used = request + 1, 0, 0
                inputs, used = inputs + 1, used + n
                out.append(request)
            yield b.assign(request=out)

    sorted_items = src.filter("shard IS NOT NULL AND tokens IS NOT NULL").repartition("shard").sortWithinPartitions("shard", "item", "tokens")
    return sorted_items.mapInPandas(run, f"shard {dict(src.dtypes)['shard']}, item {types[item]}, tokens long, request int")


def relevance(asked: DataFrame, judge: Callable[[str, str], str], levels: tuple[str, ...] = ("HIGH", "MEDIUM", "LOW")) -> DataFrame:
    """(query_id, pos, rating) of asked (query_id, pos, query, text): the judge's answer, in upper case; ``?`` for anything but one of the levels, for its failures and for null texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for q, t in zip(b["query"], b["text"]):
                try:
                    said = "" if q is None or t is None else str(judge(q, t)).strip().upper()
                except Exception:  # one failed call must not end the batch
                    said = ""
                out.append(said if said in levels else "?")
            yield b[["query_id", "pos"]].assign(rating=out)

    types = dict(asked.dtypes)
    return asked.select("query_id", "pos", "query", "text").mapInPandas(run, f"query_id {types['query_id']}, pos {types['pos']}, rating string")


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed run still has to do."""
    return items.join(done.select(key), key, "left_anti")

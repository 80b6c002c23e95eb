"""Mixing sources to target weights by Pfair scheduling.

The size of the mix is the largest at which every source can give its share with no record
used more than ``max_repeats`` times. Each source is a stream of its records in hash order,
repeated as often as needed, cut into blocks of equally many tokens. Block j of a source of
weight w may start at floor(j / w) and is due by ceil((j + 1) / w); the earliest deadline
first puts the blocks into slots, so that after every slot each source is less than one
block from its target.

The plan holds one row per source and ``slots`` blocks, whatever the size of the data, and
is made on the driver. Positions in the streams are running sums over hash ranges
(``ranges`` per source) and inside them, so a source with a third of all rows is spread.
"""

from __future__ import annotations

import base64
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from manualmill.session import unpacked

# fixed value: the public splitting pattern of this vocabulary
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class MixParams:
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    slots: int = 4096
    ranges: int = 1024
    seed: int = 17


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(docs: DataFrame, doc_id: str, text: str, source: str, p: MixParams) -> DataFrame:
    """(doc_id, source, tokens); null texts have no tokens. Whole texts are counted."""
    types = dict(docs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(p.vocabulary)
        for b in batches:
            b["tokens"] = [0 if t is None else len(enc.encode_ordinary(t)) for t in b.pop("text__")]
            yield b

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text__"))
    return unpacked(src).mapInPandas(run, f"doc_id {types[doc_id]}, source {types[source]}, tokens long")


@dataclass(frozen=True)
class Share:
    source: str
    weight: float  # of the sources that have tokens, summing to 1
    tokens: int
    max_repeats: int
    quota: int


def _heavier(target: tuple) -> tuple:
    s, w, r = target
    return s or "", -(w or 0.0), -(r or 0)


def plan(totals: dict[str, int], targets: list[tuple[str, float, int]]) -> list[Share]:
    """Quotas of the largest mix that keeps all shares. Targets that are null, not positive or without tokens leave their share to the others; of repeated targets the heaviest usable one counts, then the one with more repeats."""
    usable: dict[str, tuple[float, int]] = {}
    for s, w, r in sorted(targets, key=_heavier):
        if s is not None and w is not None and w > 0 and r is not None and r > 0 and totals.get(s, 0) > 0:
            usable.setdefault(s, (w, r))
    whole = sum(w for w, _ in usable.values())
    if not usable:
        return []
    size = min(totals[s] * r / (w / whole) for s, (w, r) in usable.items())
    return [Share(s, w / whole, totals[s], r, min(int(w / whole * size), totals[s] * r)) for s, (w, r) in sorted(usable.items())]


def schedule(shares: list[Share], slots: int) -> tuple[int, list[tuple[int, str, int]]]:
    """(tokens of a block, [(slot, source, block)]) by earliest deadline first among released blocks."""
    total = sum(s.quota for s in shares)
    block = max(1, -(-total // slots))
    blocks = {s.source: max(1, -(-s.quota // block)) for s in shares}
    weight = {s.source: s.weight for s in shares}
    waiting = [(0, s, 0) for s in sorted(blocks)]
    heapq.heapify(waiting)
    ready: list[tuple[int, float, str, int]] = []
    out = []
    for t in range(sum(blocks.values())):
        while waiting and (waiting[0][0] <= t or not ready):
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (math.ceil((j + 1) / weight[s] - 1e-9), (j + 1) / weight[s], s, j))
        _, _, s, j = heapq.heappop(ready)
        out.append((t, s, j))
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, (math.floor((j + 1) / weight[s] + 1e-9), s, j + 1))
    return block, out


def positions(sized: DataFrame, p: MixParams) -> DataFrame:
    """(doc_id, source, tokens, start): where each record begins in its source's stream, in hash order."""
    h = F.xxhash64(F.col("doc_id"), F.lit(p.seed))
    rows = sized.filter("tokens > 0 AND source IS NOT NULL").withColumn("h", h).withColumn("part", F.pmod(F.shiftrightunsigned("h", 40), F.lit(p.ranges)).cast("int"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("source", "part").agg(F.sum("tokens").alias("t")).select("source", "part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "part").orderBy("h", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(ends, ["source", "part"]).select("doc_id", "source", "tokens", (F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("start"))


def mix(sized: DataFrame, targets: DataFrame, p: MixParams = MixParams()) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    selection: slot, source, doc_id, repeat (from 0), tokens, position in the stream; read in
    the order of slot, then position. A record belongs to the block where it begins, and is
    left out if it would pass its source's quota. shares: one row per target or source with
    its target share, tokens, repeats and actual share. Sources without a target give
    nothing; targets without tokens have an actual share of 0.
    """
    spark = sized.sparkSession
    asked = [(r.source, r.target_weight, r.max_repeats) for r in targets.select("source", "target_weight", "max_repeats").orderBy("source").collect()]
    names = [s for s, _, _ in asked if s is not None]
    totals = {r.source: r.tokens for r in sized.filter(F.col("source").isin(names)).groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    shares = plan(totals, asked)
    block, slots = schedule(shares, p.slots) if shares else (1, [])
    quota = spark.createDataFrame([(s.source, s.weight, s.tokens, s.max_repeats, s.quota) for s in shares], "source string, weight double, stream long, max_repeats int, quota long")
    slot_of = spark.createDataFrame(slots, "slot long, source string, block long")
    placed = positions(sized.filter(F.col("source").isin(names)), p).join(F.broadcast(quota), "source")  # one row per target
    used = placed.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("quota") / F.col("stream")).cast("int") - 1))))
    at = F.col("repeat") * F.col("stream") + F.col("start")
    used = used.withColumn("position", at).filter((F.col("position") + F.col("tokens") <= F.col("quota")) & (F.col("repeat") < F.col("max_repeats")))
    used = used.withColumn("block", F.floor(F.col("position") / block).cast("long"))
    selection = used.join(F.broadcast(slot_of), ["source", "block"]).select("slot", "source", "doc_id", "repeat", "tokens", "position")  # at most slots + sources rows
    got = selection.groupBy("source").agg(F.sum("tokens").alias("mixed_tokens"), F.count(F.lit(1)).alias("records"), (F.max("repeat") + 1).alias("repeats"))
    all_sources = sized.filter("source IS NOT NULL").groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    stated = {s: (s, w, r) for s, w, r in sorted(asked, key=_heavier, reverse=True) if s is not None}  # of repeated targets the heaviest, as in the plan
    stated |= {x: next(t for t in sorted(asked, key=_heavier) if t[0] == x and t[1] and t[2] and t[1] > 0 and t[2] > 0) for x in (s.source for s in shares)}
    wanted = spark.createDataFrame(list(stated.values()), "source string, target_weight double, max_repeats int")
    report = wanted.join(all_sources, "source", "full").join(got, "source", "left").join(quota.select("source", "weight"), "source", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    whole = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    report = report.crossJoin(F.broadcast(whole))  # a single row
    return selection, report.select(
        "source", "target_weight", F.round("weight", 6).alias("target_share"), "max_repeats", zero("source_tokens"), zero("mixed_tokens"), zero("records"), zero("repeats"),
        F.round(F.coalesce(F.try_divide(F.col("mixed_tokens"), F.col("all_tokens")), F.lit(0.0)), 6).alias("actual_share"),
    )

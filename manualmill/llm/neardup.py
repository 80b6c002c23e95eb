"""Near-duplicate texts by a byte-position inverted index with count filtering.

A text is the set of its tokens (separated by white space, case kept). Two texts are
linked if intersection / union of their sets reaches the threshold. The search is exact:
no linked pair is lost, whatever the data.

1. Equal sets form a class; only one set per class goes on.
2. Every set is hashed into N *positions*: a token belongs to the position its hash names,
   and the position's bytes are the sum of its tokens' hashes. In a linked pair at most k
   tokens differ (k follows from the sizes), so at most k/2 positions differ in two or more
   tokens: at least N - k/2 positions are equal up to one token. Each position is therefore
   posted under its bytes and under its bytes less any one token.
3. The postings (position, bytes) -> text are the inverted index. A posting that matches
   counts 1 for the pair; pairs that reach the guaranteed minimum are verified.
   Beside its postings a text carries counters of its tokens that bound the difference of
   two texts from below, so most chance meetings are not even counted.
4. N has room to spare: each text may leave out the ``spare`` positions that many texts
   share (those with common tokens only, by a count sketch of all texts); of the N - k/2
   matches at most 2 * spare are lost, so ``least`` are still guaranteed.

N depends on a band of sizes. A text is posted in its own band and in the next larger one,
where its larger partners are; two texts meet in exactly one band.

Postings travel as packed bytes (8 a posting) and are matched by sorting within buckets,
whose number grows with the postings. A posting list of any length is paired in blocks as
a stream; classes keep exact copies from making long lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manualmill.llm.pairs import meetings, runs
from manualmill.session import materialise, unpacked

TOKEN_BYTES = 5
SKETCH = 1 << 20  # counters, whatever the size of the collection: 4 MB
BUCKET_POSTINGS = 1_500_000
COUNTERS = 32  # of 4 bits, so 16 bytes a text
BLOCK = 500_000
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Similarity:
    threshold: Fraction = Fraction(4, 5)
    min_tokens: int = 30
    spare: int = 2
    least: int = 2

    def bands(self, largest: int = 1 << 40) -> np.ndarray:
        """Lower ends of the size bands; the next band reaches every size that a partner from this one can have."""
        ends = [max(1, self.min_tokens)]
        while ends[-1] < largest:
            ends.append(int(Fraction(ends[-1]) / self.threshold) + 1)
        return np.array(ends, np.int64)


def _mix(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * by
    return x ^ (x >> np.uint64(32))


def _pack(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    n = len(b) // TOKEN_BYTES
    out = np.zeros((n, 8), np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(b, np.uint8).reshape(n, TOKEN_BYTES)
    return out.reshape(-1).view("<u8")


def token_sets(df: DataFrame, item: str, text: str, sim: Similarity) -> DataFrame:
    """(item_id, class_id, n, tokens): the token set as sorted 40-bit hashes; texts that are null or have too few tokens are left out."""
    item_type = dict(df.dtypes)[item]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, cls, ns, toks = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = set(t.as_py().split())
                if len(words) < sim.min_tokens:
                    continue
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                h.sort()
                ids.append(i), ns.append(len(words))
                cls.append(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64).item())
                toks.append(_pack(h >> np.uint64(24)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(cls, pa.int64()), pa.array(ns, pa.int32()), pa.array(toks, pa.binary())], names=["item_id", "class_id", "n", "tokens"])

    return unpacked(df.select(F.col(item).alias("item_id"), F.col(text).alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL")).mapInArrow(run, f"item_id {item_type}, class_id long, n int, tokens binary")


def token_counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold a token, by a sketch of fixed size over all sets: a float32 of SKETCH entries, summed in the executors block by block."""
    part = 1 << 14

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SKETCH, np.int64)
        for b in batches:
            for t in b["tokens"]:
                np.add.at(total, (_unpack(t) % np.uint64(SKETCH)).astype(np.int64), 1)
        yield pd.DataFrame({"block": range(SKETCH // part), "counts": [total[i : i + part].astype("<i8").tobytes() for i in range(0, SKETCH, part)]})

    def add(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "counts": [sum(np.frombuffer(x, "<i8") for x in b["counts"]).tobytes()]})

    rows = sets.select("tokens").mapInPandas(count, "block int, counts binary").groupBy("block").applyInPandas(add, "block int, counts binary").collect()
    out = np.zeros(SKETCH, np.float32)
    for r in rows:
        out[r.block * part : (r.block + 1) * part] = np.frombuffer(r.counts, "<i8")
    return out


def postings(tokens: list[np.ndarray], sim: Similarity, bands: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, ref) of all postings of some texts; ref = 4 * number of the text + 2 * (posted in the next band) + (less one token)."""
    size = np.array([len(t) for t in tokens], np.int64)
    flat, doc = np.concatenate(tokens), np.repeat(np.arange(len(tokens)), size)
    own = np.searchsorted(bands, size, side="right") - 1
    where, rank_of = _mix(flat, _M1), weight[(flat % np.uint64(SKETCH)).astype(np.int64)]
    share, t = _mix(flat, _M2), sim.threshold
    keys, refs = [], []
    for lift in (0, 1):
        band = own + lift
        k = ((bands[band + 1] - 1) * 2 * (t.denominator - t.numerator)) // (t.denominator + t.numerator)
        count = k // 2 + sim.least + 2 * sim.spare  # N
        goes = np.ones(len(size), bool) if not lift else size * t.denominator >= t.numerator * bands[own + 1]
        at = np.flatnonzero(goes[doc])
        first = np.concatenate([[0], np.cumsum(np.where(goes, count, 0))])
        pos = (where[at] >> np.uint64(20)) % count[doc[at]].astype(np.uint64)
        cell = first[doc[at]] + pos.astype(np.int64)
        cells = int(first[-1])
        owner = np.repeat(np.arange(len(size)), np.where(goes, count, 0))
        total, rarest = np.zeros(cells, np.uint64), np.zeros(cells, np.float32)
        np.add.at(total, cell, share[at])
        np.minimum.at(rarest, cell, rank_of[at])
        commonness = np.bincount(cell, weights=rank_of[at], minlength=cells) - rarest
        order = np.lexsort((-commonness, owner))
        keep = np.ones(cells, bool)
        keep[order[np.arange(cells) - first[owner[order]] < sim.spare]] = False
        salt = _mix(np.arange(cells, dtype=np.uint64) - first[owner].astype(np.uint64) + (band[owner].astype(np.uint64) << np.uint64(32)), _M3)
        less = keep[cell]
        keys += [_mix(total[keep] + salt[keep], _M1), _mix(total[cell[less]] - share[at][less] + salt[cell[less]], _M1)]
        refs += [owner[keep] * 4 + 2 * lift, doc[at][less] * 4 + 2 * lift + 1]
    return np.concatenate(keys), np.concatenate(refs)


def counters(tokens: list[np.ndarray]) -> np.ndarray:
    """How many tokens of each text fall into each of COUNTERS parts, up to 15, two to a byte. Two texts differ in at least as many tokens as their counters do."""
    doc, flat = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]), np.concatenate(tokens)
    part = (_mix(flat, _M3) >> np.uint64(40)) % np.uint64(COUNTERS)
    n = np.bincount(doc * COUNTERS + part.astype(np.int64), minlength=len(tokens) * COUNTERS).reshape(-1, COUNTERS)
    n = np.minimum(n, 15).astype(np.uint8)
    return n[:, ::2] | n[:, 1::2] << 4


_PACKED = "bucket int, lo binary, hi binary, ref binary, classes binary, sizes binary, counters binary"


def packed_postings(classes: DataFrame, sim: Similarity, buckets: int, weight_of) -> DataFrame:
    """Postings by bucket as packed arrays: 48 bits of key, 16 of reference into the classes named beside them."""
    bands = sim.bands()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cls, n, tokens = b["class_id"].to_numpy(np.int64), b["n"].to_numpy(np.uint32), b["tokens"]
            start = 0
            while start < len(b):
                stop, load = start, 0
                while stop < len(b) and stop - start < 4000 and (stop == start or load + n[stop] <= 200_000):
                    load += int(n[stop])
                    stop += 1
                sets = [_unpack(x) for x in tokens[start:stop]]
                key, ref = postings(sets, sim, bands, weight_of.value)
                parts = counters(sets)
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                key, ref, bucket = key[order], ref[order], bucket[order]
                out = []
                for i, j in zip(e := np.flatnonzero(np.r_[True, np.diff(bucket) > 0]), np.r_[e[1:], len(bucket)]):
                    used, inverse = np.unique(ref[i:j] >> 2, return_inverse=True)
                    out.append((int(bucket[i]), key[i:j].astype("<u4").tobytes(), (key[i:j] >> np.uint64(32)).astype("<u2").tobytes(), (inverse * 4 + (ref[i:j] & 3)).astype("<u2").tobytes(), cls[start:stop][used].astype("<i8").tobytes(), n[start:stop][used].astype("<u4").tobytes(), parts[used].tobytes()))
                yield pd.DataFrame(out, columns=["bucket", "lo", "hi", "ref", "classes", "sizes", "counters"])
                start = stop

    return classes.select("class_id", "n", "tokens").mapInPandas(run, _PACKED)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the differences of two rows of counters, a lower bound of the tokens in which the texts differ."""
    low = np.abs((x & 15).astype(np.int8) - (y & 15).astype(np.int8)).sum(axis=1, dtype=np.int64)
    return low + np.abs((x >> 4).astype(np.int8) - (y >> 4).astype(np.int8)).sum(axis=1, dtype=np.int64)


def _match(key: np.ndarray, row: np.ndarray, flag: np.ndarray, cls: np.ndarray, size: np.ndarray, parts: np.ndarray, t: Fraction) -> Iterator[pd.DataFrame]:
    """Tallies of the pairs that meet in one bucket, in blocks: whole positions against whole ones and against those less one token.

    Pairs whose sizes or counters already forbid the threshold are not counted.
    """
    order = np.lexsort((flag & 1, key))
    key, row, flag = key[order], row[order], flag[order]
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    end = np.repeat(np.r_[begin[1:], len(key)], np.diff(np.r_[begin, len(key)]))
    whole = np.flatnonzero(((flag & 1) == 0) & (end - np.arange(len(key)) > 1))  # whole ones come first: each meets what follows it
    for left, right in meetings(whole, end[whole] - whole - 1, BLOCK):
        once = (flag[left] & flag[right] & 2) == 0
        x, y = row[left[once]], row[right[once]]
        small, large = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
        ok = (cls[x] != cls[y]) & (small * t.denominator >= large * t.numerator)
        x, y = x[ok], y[ok]
        ok = _apart(parts[x], parts[y]) * (t.denominator + t.numerator) <= (size[x] + size[y]) * (t.denominator - t.numerator)
        a, b = cls[x[ok]], cls[y[ok]]
        if len(a):
            pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
            yield pairs.groupby(["a", "b"], sort=False).size().reset_index(name="shared")


def tally(packed: DataFrame, sim: Similarity, buckets: int) -> DataFrame:
    """(a, b, shared): pairs of classes and how many positional bytes they share, at least the guaranteed minimum."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in runs(batches):
            key = np.concatenate([np.frombuffer(r[0], "<u4").astype(np.uint64) | (np.frombuffer(r[1], "<u2").astype(np.uint64) << np.uint64(32)) for r in held])
            refs = [np.frombuffer(r[2], "<u2").astype(np.int64) for r in held]
            cls = np.concatenate([np.frombuffer(r[3], "<i8") for r in held])
            size = np.concatenate([np.frombuffer(r[4], "<u4") for r in held]).astype(np.int64)
            parts = np.concatenate([np.frombuffer(r[5], np.uint8).reshape(-1, COUNTERS // 2) for r in held])
            first = np.cumsum([0, *(len(r[3]) // 8 for r in held)])
            row = np.concatenate([(x >> 2) + f for x, f in zip(refs, first)]).astype(np.int32)
            flag = np.concatenate([(x & 3).astype(np.uint8) for x in refs])
            yield from _match(key, row, flag, cls, size, parts, sim.threshold)

    met = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(run, "a long, b long, shared long")
    return met.groupBy("a", "b").agg(F.sum("shared").alias("shared")).filter(F.col("shared") >= sim.least)


def verify(candidates: DataFrame, classes: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b, similarity) of the candidates whose sets reach the threshold, compared whole."""
    t = sim.threshold

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for x, y, p, q in zip(b["a"], b["b"], b["ta"], b["tb"]):
                u, v = _unpack(p), _unpack(q)
                both = np.concatenate([u, v])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                union = len(both) - inter
                if inter * t.denominator >= union * t.numerator:
                    rows.append((x, y, inter / union))
            yield pd.DataFrame(rows, columns=["a", "b", "similarity"])

    side = lambda k, c: classes.select(F.col("class_id").alias(k), F.col("tokens").alias(c))
    return candidates.select("a", "b").join(side("a", "ta"), "a").join(side("b", "tb"), "b").mapInPandas(run, "a long, b long, similarity double")


@dataclass(frozen=True)
class NearDuplicates:
    """``members``: (item_id, class_id), every item with a text long enough; ``links``: (a, b, similarity) between classes."""

    members: DataFrame
    links: DataFrame


def near_duplicates(df: DataFrame, item: str, text: str, sim: Similarity = Similarity()) -> NearDuplicates:
    """Null items and texts, and texts under ``min_tokens``, belong to no class. Repeated rows count once; an item with several texts is in several classes."""
    spark = df.sparkSession
    sets = token_sets(df, item, text, sim)
    members = materialise(sets.select("item_id", "class_id").distinct(), "members")
    classes = materialise(sets.select("class_id", "n", "tokens").dropDuplicates(["class_id"]), "classes")
    total = classes.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("n")).first()
    counts = token_counts(classes)
    weight = np.log((counts + 1) / ((total.n or 0) + 1)).astype(np.float32)
    held = spark.sparkContext.broadcast(weight)
    least = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    buckets = max(least, int((total.tokens or 0) * 2.2 // BUCKET_POSTINGS) + 1)
    candidates = tally(packed_postings(classes, sim, buckets, held), sim, buckets)
    return NearDuplicates(members, materialise(verify(candidates, classes, sim), "links"))


def item_pairs(found: NearDuplicates) -> DataFrame:
    """(item_a, item_b) of different items, the smaller first, distinct: links between classes and copies within one."""
    m = found.members
    left, right = m.select(F.col("item_id").alias("x"), F.col("class_id").alias("a")), m.select(F.col("item_id").alias("y"), F.col("class_id").alias("b"))
    pairs = found.links.select("a", "b").join(left, "a").join(right, "b").select("x", "y")
    copies = left.join(right, F.col("a") == F.col("b")).filter("x < y").select("x", "y")
    return pairs.unionByName(copies).filter("x <> y").select(F.least("x", "y").alias("item_a"), F.greatest("x", "y").alias("item_b")).distinct()


def item_groups(found: NearDuplicates, most_rounds: int = 60) -> DataFrame:
    """(item_id, class_id, group_id, links): connected classes share group_id, the smallest class_id; links counts linked classes.

    Labels are lowered along links and by pointer jumping until none changes; each round is
    written to the shared folder. Only the number of changes reaches the driver.
    """
    both = found.links.select("a", "b").unionByName(found.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.countDistinct("b").alias("links"))
    label = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("g")), "labels")
    for _ in range(most_rounds):
        near = both.join(label.select(F.col("a").alias("b"), "g"), "b").groupBy("a").agg(F.min("g").alias("near"))
        low = label.join(near, "a").select("a", F.col("g").alias("was"), F.least("g", "near").alias("g"))
        jump = label.select(F.col("a").alias("g"), F.col("g").alias("beyond"))
        new = materialise(low.join(jump, "g", "left").select("a", "was", F.least("g", F.coalesce("beyond", "g")).alias("g")), "labels")
        label = new.select("a", "g")
        if new.filter("g <> was").limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"groups did not settle in {most_rounds} rounds")
    m = found.members.join(label.withColumnRenamed("a", "class_id"), "class_id", "left").join(degree.withColumnRenamed("a", "class_id"), "class_id", "left")
    return m.select("item_id", "class_id", F.coalesce("g", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))

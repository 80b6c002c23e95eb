"""The most similar vectors of every vector by collision-counting hashing.

Vectors are projected on single directions: ``rotations`` random rotations of as many
directions as the vector has numbers. In each rotation a vector's window is the block at
the end of the sorted array of the direction where its projection is most extreme; two
vectors collide in a rotation if they are in one window. Similar vectors collide in a
known share of the rotations, unrelated ones in one of about 2 * dim. Pairs that collide
at least ``threshold`` times are verified with the exact cosine.

Counting all pairs would be quadratic, so the first collisions are demanded by join keys:
tables of ``windows`` rotations each, whose count is set so that a pair at the wanted
cosine meets in some table with a chance of ``recall``; the count is then taken over all
rotations. Virtual rehashing works in both directions: with more vectors a key demands
more windows (finer cells, more tables), and for a cell that is still crowded the window widens
until nothing is left outside: all classes that lie in some crowded cell are compared with
each other, exactly and once, whatever the number of tables (``nearest_classes``).

Equal vectors form a class and only the class goes on, so copies cannot fill a cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from manualmill.llm.pairs import meetings, runs
from manualmill.session import materialise

BUCKET_ENTRIES = 600_000
BLOCK = 8192  # classes in a packed matrix
SPARE = 4  # candidates beyond k kept in single precision, so the exact cosine decides


@dataclass(frozen=True)
class Search:
    dim: int = 64
    k: int = 5
    min_cosine: float = 0.90
    rotations: int = 48
    recall: float = 0.998
    crowded: int = 2048
    reach: int = 256  # without effect since crowded cells are compared whole
    seed: int = 7
    whole: bool = False  # no cosine floor: every class against every other, exactly

    @property
    def floor(self) -> float:
        return -1.0 - 1e-9 if self.whole else self.min_cosine

    def directions(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        return np.stack([np.linalg.qr(rng.normal(size=(self.dim, self.dim)))[0] for _ in range(self.rotations)]).astype(np.float32)

    def collision_share(self) -> float:
        """Share of rotations in which two vectors at ``min_cosine`` collide, by simulation."""
        rng, c = np.random.default_rng(self.seed + 1), self.min_cosine
        x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(2, 20_000, self.dim)))
        y = y - (x * y).sum(1, keepdims=True) * x
        z = c * x + math.sqrt(1 - c * c) * y / np.linalg.norm(y, axis=1, keepdims=True)
        return float((_windows(x) == _windows(z)).mean())

    def threshold(self, share: float) -> int:
        """Collisions that all but one in about 2,000 pairs at ``min_cosine`` reach."""
        return max(2, math.floor(self.rotations * share - 3.3 * math.sqrt(self.rotations * share * (1 - share))))

    def tables(self, n: int, share: float) -> list[tuple[int, ...]]:
        windows = max(2, math.ceil(math.log(max(n, 2) / 128) / math.log(1.7 * self.dim)))
        count = math.ceil(math.log(1 - self.recall) / math.log(1 - share**windows))
        rng, out, order = np.random.default_rng(self.seed + 2), {}, []
        while len(out) < min(count, math.comb(self.rotations, windows)):
            if len(order) < windows:
                order = list(rng.permutation(self.rotations))
            pick, order = tuple(sorted(int(x) for x in order[:windows])), order[windows:]
            out.setdefault(pick)
        return list(out)


def _windows(projected: np.ndarray) -> np.ndarray:
    axis = np.abs(projected).argmax(axis=1)
    return (axis * 2 + (projected[np.arange(len(projected)), axis] > 0)).astype(np.uint8 if projected.shape[1] <= 128 else np.uint16)


def clean(df: DataFrame, item: str, vector: str, recency: str, dim: int) -> DataFrame:
    """(item_id, v): one usable vector per item. Null items and vectors that are null, hold null or NaN, are all zero or of another length take no part; of several deliveries the latest counts."""
    v = F.col(vector)
    ok = F.col(item).isNotNull() & (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & F.exists(v, lambda x: x != 0)
    at = F.struct(F.col(recency).isNotNull(), F.col(recency), F.xxhash64(v))
    return df.filter(ok).select(F.col(item).alias("item_id"), v.cast("array<float>").alias("v"), at.alias("at")).groupBy("item_id").agg(F.max_by("v", "at").alias("v"))


_ENTRY = "bucket int, key binary, cls binary, code binary, crowd binary"


def entries(classes: DataFrame, crowd: DataFrame | None, search: Search, tables: list[tuple[int, ...]], buckets: int) -> DataFrame:
    """Every class in every table: packed keys, classes, windows in all rotations and whether the class is in ``crowd``, by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        directions = search.directions()
        for whole in batches:
            for start in range(0, len(whole), 2500):
                b = whole.iloc[start : start + 2500]
                x = np.stack(b["v"].to_numpy()).astype(np.float32)
                x /= np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True).astype(np.float32)
                cls, known = b["class_id"].to_numpy(np.int64), b["crowd"].to_numpy(bool)
                code = np.stack([_windows(x @ r) for r in directions], axis=1)
                keys = []
                for t, picked in enumerate(tables):
                    key = np.full(len(x), t + 1, np.uint64)
                    for r in picked:
                        key = key * np.uint64(2 * search.dim + 1) + code[:, r]
                    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                    keys.append(key ^ (key >> np.uint64(29)))
                key, row = np.concatenate(keys), np.tile(np.arange(len(x)), len(tables))
                bucket = ((key >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                begin = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0])
                out = []
                for part in np.split(order, begin[1:]):
                    r = row[part]
                    out.append((int(bucket[part[0]]), key[part].tobytes(), cls[r].tobytes(), code[r].tobytes(), known[r].tobytes()))
                yield pd.DataFrame(out, columns=["bucket", "key", "cls", "code", "crowd"])

    known = classes.withColumn("crowd", F.lit(False)) if crowd is None else classes.join(crowd.withColumn("crowd", F.lit(True)), "class_id", "left")
    return known.select("class_id", "v", F.coalesce("crowd", F.lit(False)).alias("crowd")).mapInPandas(run, _ENTRY)


def crowded_classes(packed: DataFrame, search: Search, buckets: int) -> DataFrame:
    """(class_id): the classes that lie in some crowded cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in runs(batches):
            key = np.concatenate([np.frombuffer(r[0], "<u8") for r in held])
            cls = np.concatenate([np.frombuffer(r[1], "<i8") for r in held])
            _, cell, size = np.unique(key, return_inverse=True, return_counts=True)
            yield pd.DataFrame({"class_id": np.unique(cls[size[cell] > search.crowded])})

    return packed.select("bucket", "key", "cls").repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(run, "class_id long").distinct()


def colliding(packed: DataFrame, search: Search, threshold: int, buckets: int) -> DataFrame:
    """(a, b, collisions), a < b: the pairs that share a cell and collide often enough; distinct. Pairs of two classes of the crowd are left to ``nearest_classes``."""
    width = search.rotations

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in runs(batches):
            key = np.concatenate([np.frombuffer(r[0], "<u8") for r in held])
            cls = np.concatenate([np.frombuffer(r[1], "<i8") for r in held])
            code = np.concatenate([np.frombuffer(r[2], np.uint8).reshape(-1, width) for r in held])
            known = np.concatenate([np.frombuffer(r[3], bool) for r in held])
            order = np.lexsort((known, key))
            key, cls, code, known = key[order], cls[order], code[order], known[order]
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[begin, len(key)])
            todo = np.repeat(begin + size, size) - np.arange(len(key)) - 1
            todo = np.where(known, 0, todo)  # the crowd comes last in its cell, so only its own pairs are left out
            for left, right in meetings(np.arange(len(key)), todo, 200_000):
                count = (code[left] == code[right]).sum(axis=1)
                ok = (count >= threshold) & (cls[left] != cls[right])
                a, b = cls[left[ok]], cls[right[ok]]
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "collisions": count[ok].astype(np.int32)})

    met = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(run, "a long, b long, collisions int")
    return met.groupBy("a", "b").agg(F.max("collisions").alias("collisions"))


def verified(pairs: DataFrame, classes: DataFrame, search: Search) -> DataFrame:
    """(a, b, cosine) of the pairs at or above ``min_cosine``, computed in double precision."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in range(0, len(b), 20_000):
                part = b.iloc[s : s + 20_000]
                x, y = (np.stack(part[c].to_numpy()).astype(np.float64) for c in ("va", "vb"))
                cos = np.minimum((x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)), 1.0)
                ok = cos >= search.floor
                yield pd.DataFrame({"a": part["a"][ok], "b": part["b"][ok], "cosine": cos[ok]})

    side = lambda k, c: classes.select(F.col("class_id").alias(k), F.col("v").alias(c))
    return pairs.select("a", "b").join(side("a", "va"), "a").join(side("b", "vb"), "b").mapInPandas(run, "a long, b long, cosine double")


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Classes as matrices of at most BLOCK unit vectors."""
    ids, rows, count = [], [], 0

    def out() -> pd.DataFrame:
        x = np.concatenate(rows)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        return pd.DataFrame({"ids": [np.concatenate(ids).astype("<i8").tobytes()], "x": [x.astype("<f4").tobytes()]})

    for b in batches:
        for s in range(0, len(b), 1024):
            part = b.iloc[s : s + 1024]
            if count + len(part) > BLOCK:
                yield out()
                ids, rows, count = [], [], 0
            ids.append(part["class_id"].to_numpy(np.int64))
            rows.append(np.stack(part["v"].to_numpy()).astype(np.float64))
            count += len(part)
    if count:
        yield out()


def _keep_best(g: np.ndarray, ids: np.ndarray, best: np.ndarray, who: np.ndarray) -> None:
    """Merge the cosines ``g`` of rows with ``ids`` into the best so far, in place."""
    keep = best.shape[1]
    least = best.min(axis=1)
    hit = g > least[:, None]
    if g.shape[1] > keep and np.count_nonzero(hit) > 16 * keep * len(g):
        hit &= g >= np.partition(g, g.shape[1] - keep, axis=1)[:, g.shape[1] - keep][:, None]
    r, c = np.nonzero(hit)
    if not len(r):
        return
    row = np.r_[np.repeat(np.arange(len(g)), keep), r]
    value, name = np.r_[best.reshape(-1), g[r, c]], np.r_[who.reshape(-1), ids[c]]
    order = np.lexsort((name, -value, row))
    row = row[order]
    begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    place = np.arange(len(row)) - np.repeat(begin, np.diff(np.r_[begin, len(row)]))
    order = order[place < keep]
    best[:], who[:] = value[order].reshape(best.shape), name[order].reshape(who.shape)


def nearest_classes(classes: DataFrame, search: Search) -> DataFrame:
    """(a, b), a < b, distinct: every class with the k others of highest cosine, at least ``min_cosine``, of all of them.

    Exact: every class meets every other in a product of packed matrices; quadratic in the
    number of classes. Single precision picks k + SPARE candidates, ``verified`` gives their cosine.
    """
    keep, least, dim = search.k + SPARE, search.floor - 1e-5, search.dim

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ids, x, best, who = None, None, None, None, None

        def out() -> pd.DataFrame:
            r, c = np.nonzero(best > least)
            a, b = ids[r], who[r, c]
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        for batch in batches:
            for left, xl, right, xr in batch[["ids", "x", "other_ids", "other_x"]].itertuples(index=False, name=None):
                if left != held:  # the other side is run through for one matrix after another
                    if held is not None:
                        yield out()
                    held, ids, x = left, np.frombuffer(left, "<i8"), np.frombuffer(xl, "<f4").reshape(-1, dim)
                    best, who = np.full((len(ids), keep), least, np.float32), np.zeros((len(ids), keep), np.int64)
                other, y = np.frombuffer(right, "<i8"), np.frombuffer(xr, "<f4").reshape(-1, dim)
                for s in range(0, len(ids), 512):
                    g = x[s : s + 512] @ y.T
                    if left == right:
                        i = np.arange(len(g))
                        g[i, s + i] = -2
                    _keep_best(g, other, best[s : s + 512], who[s : s + 512])
        if held is not None:
            yield out()

    packed = materialise(classes.select("class_id", "v").mapInPandas(_pack, "ids binary, x binary"), "packed")
    cores = packed.sparkSession.sparkContext.defaultParallelism
    left = packed.repartition(2 * cores)
    other = packed.select(F.col("ids").alias("other_ids"), F.col("x").alias("other_x")).coalesce(1)
    return left.crossJoin(other).mapInPandas(run, "a long, b long").distinct()


def class_links(vectors: DataFrame, search: Search) -> tuple[DataFrame, DataFrame]:
    """(members, links): (item_id, class_id) of every vector, and (a, b, cosine) between classes of different vectors."""
    spark = vectors.sparkSession
    rows = materialise(vectors.select("item_id", F.xxhash64("v").alias("class_id"), "v"), "vectors")
    classes = materialise(rows.groupBy("class_id").agg(F.first("v").alias("v")), "vector-classes")
    if search.whole:
        return rows.select("item_id", "class_id"), materialise(verified(nearest_classes(classes, search), classes, search), "cosines")
    n = classes.count()
    share = search.collision_share()
    tables = search.tables(n, share)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")) * 2, n * len(tables) // BUCKET_ENTRIES + 1)
    crowd = materialise(crowded_classes(entries(classes, None, search, tables, buckets), search, buckets), "crowd")
    pairs = colliding(entries(classes, crowd, search, tables, buckets), search, search.threshold(share), buckets).select("a", "b")
    if not crowd.isEmpty():
        pairs = pairs.unionByName(nearest_classes(classes.join(crowd, "class_id", "left_semi"), search))
    return rows.select("item_id", "class_id"), materialise(verified(pairs, classes, search), "cosines")


def neighbours(df: DataFrame, item: str, vector: str, recency: str, search: Search = Search()) -> DataFrame:
    """(item_id, rank, neighbour_id, cosine): up to k most similar other items of every item with a cosine of at least ``min_cosine``; of any cosine if ``whole``.

    Ties go to the smaller id. Items with equal vectors are each other's neighbours at
    cosine 1; only the first k + 1 of a class can be anyone's neighbours through ties, so
    no more of them are paired.
    """
    members, links = class_links(clean(df, item, vector, recency, search.dim), search)
    first = Window.partitionBy("class_id").orderBy("item_id")
    head = members.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= search.k + 1)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    both = both.unionByName(head.filter("place = 1").select(F.col("class_id").alias("a"), F.col("class_id").alias("b"), F.lit(1.0).alias("cosine")))
    mine = head.select(F.col("class_id").alias("a"), "item_id")
    other = head.select(F.col("class_id").alias("b"), F.col("item_id").alias("neighbour_id"))
    best = Window.partitionBy("item_id").orderBy(F.desc("cosine"), "neighbour_id")
    heads = both.join(mine, "a").join(other, "b").filter("item_id <> neighbour_id").select("item_id", "neighbour_id", "cosine")
    top = heads.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= search.k)
    # copies beyond the first k + 1: their neighbours are the first k of their class
    rest = members.join(head.select("item_id"), "item_id", "left_anti")
    copies = rest.join(head.filter(F.col("place") <= search.k).select("class_id", F.col("item_id").alias("neighbour_id"), F.col("place").alias("rank")), "class_id")
    return top.select("item_id", "rank", "neighbour_id", "cosine").unionByName(copies.select("item_id", "rank", "neighbour_id", F.lit(1.0).alias("cosine")))

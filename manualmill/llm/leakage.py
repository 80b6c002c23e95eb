"""Held-out passages inside a corpus, by latent semantic retrieval.

1. Document frequencies of all words are counted over the whole corpus, in a hashed
   vocabulary of fixed size.
2. A randomised singular value decomposition of TF-IDF windows gives the latent space: the
   windows of all held-out passages and of a bounded sample of documents (``sample_docs``
   with the smallest hashes). Each pass is a distributed product; the driver only sees
   matrices of vocabulary x rank.
3. Every window of every document is projected and compared with all passage windows by
   the cosine; (document, item) pairs over ``min_cosine`` are candidates. Windows begin
   every ``stride`` words and are so wide that a run of ``run_words`` words always lies
   whole in one of them.
4. Candidates are checked on their words: the longest run of consecutive common words, and
   for paraphrases the longest common subsequence and the share of the passage's answer
   words (those that hold digits).

The passages are a stated query set, taken in blocks of at most ``block_windows`` of their
windows, which bounds what is broadcast and held on the driver at a time; a document meets
a block inside its own task, so the search shuffles nothing but its few results. A block
holds some three thousand passages, and each block is one scan of the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manualmill.session import materialise, unpacked

_INVISIBLE = dict.fromkeys([0xAD, 0x180E, *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF])
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Retrieval:
    run_words: int = 13
    vocabulary: int = 1 << 15
    rank: int = 64
    oversample: int = 8
    sample_docs: int = 4000
    stride: int = 7
    min_cosine: float = 0.45
    paraphrase_cosine: float = 0.75
    min_lcs: float = 0.5
    min_answer: float = 0.5
    block_windows: int = 50_000
    seed: int = 11

    @property
    def window(self) -> int:
        return self.run_words + self.stride - 1


def words(text: str) -> list[str]:
    """Maximal runs of letters and digits in lower case, once soft hyphens and zero-width characters are gone."""
    return _WORD.findall((text if text.isascii() else text.translate(_INVISIBLE)).lower())


class _Hashes(dict):
    """Hashes of words seen before; emptied when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh32_intdigest(word)
        return h


_HASHES = _Hashes()


def _ids(ws: list[str], size: int) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, ws), np.int64, len(ws)) % size


def _starts(n: int, width: int, stride: int) -> np.ndarray:
    """Starts of windows that cover all n words; the last one ends with the last word."""
    if n <= width:
        return np.zeros(1, np.int64)
    s = np.arange(0, n - width + stride, stride)
    return np.unique(np.minimum(s, n - width))


def window_sums(values: np.ndarray, width: int, stride: int) -> np.ndarray:
    """Sums of the rows of values over each window."""
    total = np.vstack([np.zeros((1, values.shape[1]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    s = _starts(len(values), width, stride)
    return (total[np.minimum(s + width, len(values))] - total[s]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.maximum(n, 1e-9)


def _summed(rows: DataFrame) -> list:
    """Sums the float64 arrays of (block, part) by block, in the executors."""

    def add(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [key[0]], "part": [sum(np.frombuffer(x, "<f8") for x in b["part"]).tobytes()]})

    return rows.groupBy("block").applyInPandas(add, "block int, part binary").collect()


def document_frequency(texts: DataFrame, r: Retrieval) -> tuple[np.ndarray, int]:
    """Documents per hashed word, and documents, over all rows of ``text``."""
    block = 2048

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(r.vocabulary + block, np.float64)
        for b in batches:
            for t in b["text"]:
                total[np.unique(_ids(list(set(words(t))), r.vocabulary))] += 1
                total[r.vocabulary] += 1
        yield pd.DataFrame({"block": range(len(total) // block), "part": [total[i : i + block].tobytes() for i in range(0, len(total), block)]})

    out = np.zeros(r.vocabulary + block)
    for row in _summed(texts.mapInPandas(count, "block int, part binary")):
        out[row.block * block : (row.block + 1) * block] = np.frombuffer(row.part, "<f8")
    return out[: r.vocabulary], int(out[r.vocabulary])


def latent_space(passages: DataFrame, idf: np.ndarray, r: Retrieval) -> np.ndarray:
    """vocabulary x rank: right singular vectors of the TF-IDF windows of ``text``, by a randomised range finder with one power iteration."""
    spark, q, block = passages.sparkSession, r.rank + r.oversample, 1024
    rng = np.random.default_rng(r.seed)
    held_idf = spark.sparkContext.broadcast(idf.astype(np.float32))

    def product(basis: np.ndarray) -> np.ndarray:
        """X' X basis, where the rows of X are the windows."""
        held = spark.sparkContext.broadcast(basis.astype(np.float32))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, b_, w_ = np.zeros((r.vocabulary, q), np.float64), held.value, held_idf.value
            for b in batches:
                for t in b["text"]:
                    ids = _ids(words(t), r.vocabulary)
                    if not len(ids):
                        continue
                    w = w_[ids][:, None]
                    begin = _starts(len(ids), r.window, r.stride)
                    y = window_sums(w * b_[ids], r.window, r.stride) / window_sums(w * w, r.window, r.stride)
                    spread = np.zeros((len(ids) + 1, q), np.float64)
                    np.add.at(spread, begin, y)
                    np.add.at(spread, np.minimum(begin + r.window, len(ids)), -y)
                    np.add.at(total, ids, w * np.cumsum(spread[:-1], axis=0))
            used = [i for i in range(0, r.vocabulary, block) if total[i : i + block].any()]
            yield pd.DataFrame({"block": [i // block for i in used], "part": [total[i : i + block].tobytes() for i in used]})

        out = np.zeros((r.vocabulary, q))
        for row in _summed(passages.mapInPandas(run, "block int, part binary")):
            out[row.block * block : (row.block + 1) * block] = np.frombuffer(row.part, "<f8").reshape(block, q)
        held.unpersist()
        return out

    basis = np.linalg.qr(product(rng.normal(size=(r.vocabulary, q))))[0]
    z = product(basis)
    small = basis.T @ z  # = (X basis)'(X basis)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    return (basis @ vector[:, np.argsort(-value)[: r.rank]]).astype(np.float32)


def grams(ws: list[str], n: int) -> dict[str, list[int]]:
    """Positions of every run of n words."""
    out: dict[str, list[int]] = {}
    for j in range(len(ws) - n + 1):
        out.setdefault(" ".join(ws[j : j + n]), []).append(j)
    return out


def longest_run(a: list[str], a_grams: dict, b: list[str], b_grams: dict, least: int) -> int:
    """Length of the longest run of consecutive words that a and b share, if it has ``least`` words, else 0; the grams are those of ``least`` words."""
    best = 0
    for g in a_grams.keys() & b_grams.keys():
        for i in a_grams[g]:
            for j in b_grams[g]:
                n = least
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                best = max(best, n)
    return best


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[str, int] = {}
    for i, w in enumerate(b):
        where[w] = where.get(w, 0) | 1 << i
    row = (1 << len(b)) - 1
    for w in a:
        hit = row & where.get(w, 0)
        row = (row + hit) | (row - hit)
        row &= (1 << len(b)) - 1
    return len(b) - row.bit_count()


LEAK = "run int, cosine double, lcs double, answer double, kind string"


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str, r: Retrieval = Retrieval()) -> DataFrame:
    """(doc_id, item_id, run, cosine, lcs, answer, kind): kind ``copied`` if run >= run_words, else ``paraphrased``; distinct.

    run: longest run of common words, 0 under run_words; lcs: longest
    common subsequence of a window and the passage as a share of the window, the largest of
    the windows over paraphrase_cosine and the nearest one; cosine: of that window;
    answer: share of the passage's words with digits that the document holds. Null ids,
    null texts and passages shorter than run_words take no part.
    """
    spark = docs.sparkSession
    doc_type, item_type = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    src = unpacked(src)
    asked = items.select(F.col(item_id).alias("item_id"), F.col(passage).alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item_id", "text")
    held_out = ((x.item_id, ws) for x in asked.toLocalIterator() if len(ws := words(x.text)) >= r.run_words)
    schema = f"doc_id {doc_type}, item_id {item_type}, {LEAK}"
    first_item = next(held_out, None)
    if first_item is None:
        return spark.createDataFrame([], schema)
    df, n = document_frequency(src.select("text"), r)
    idf = np.log((n + 1) / (df + 1)) + 0.05
    sample = src.select("text").orderBy(F.xxhash64("text"), "text").limit(r.sample_docs).repartition(8)
    fit = materialise(sample.unionByName(asked.select("text")), "passages")
    space = latent_space(fit, idf, r) * idf[:, None].astype(np.float32)
    held_space = spark.sparkContext.broadcast(space.astype(np.float32))
    found = []
    for block in _blocks(chain([first_item], held_out), space, r):
        found.append(_search(src, schema, spark.sparkContext.broadcast(block), held_space, r))
    return reduce(DataFrame.unionByName, found).distinct()


def _blocks(items: Iterator[tuple], space: np.ndarray, r: Retrieval) -> Iterator[tuple]:
    """Items with the latent vectors of their windows, where each item's begin, and their runs of words, up to ``block_windows`` windows at a time.

    Windows begin every ``stride`` words as those of the documents do, so a run of ``run_words`` lies whole in a window on either side.
    """
    block, latent, count = [], [], 0
    for item in items:
        z = _unit(window_sums(space[_ids(item[1], r.vocabulary)], r.window, r.stride))
        if block and count + len(z) > r.block_windows:
            yield _packed(block, latent, r)
            block, latent, count = [], [], 0
        block.append(item)
        latent.append(z)
        count += len(z)
    yield _packed(block, latent, r)


def _packed(block: list, latent: list, r: Retrieval) -> tuple:
    first = np.cumsum([0, *map(len, latent)])
    return block, np.concatenate(latent), first, [grams(ws, r.run_words) for _, ws in block]


def _nearest(z: np.ndarray, latent: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest cosine of each row of z with the windows of each item, in products of bounded size."""
    out = np.empty((len(z), len(first) - 1), np.float32)
    i = 0
    while i < len(first) - 1:
        j = max(i + 1, int(np.searchsorted(first, first[i] + 4096, side="right")) - 1)
        part = latent[first[i] : first[j]].T
        for s in range(0, len(z), 2048):
            out[s : s + 2048, i:j] = np.maximum.reduceat(z[s : s + 2048] @ part, first[i:j] - first[i], axis=1)
        i = j
    return out


def _search(src: DataFrame, schema: str, held, held_space, r: Retrieval) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, latent, first, runs = held.value
        digits = [{w for w in ws if any(c.isdigit() for c in w)} for _, ws in block]
        for whole in batches:
            rows, pending, count = [], [], 0
            for doc_id, t in zip(whole["doc_id"], whole["text"]):
                ws = words(t)
                if not ws:
                    continue
                z = _unit(window_sums(held_space.value[_ids(ws, r.vocabulary)], r.window, r.stride))
                pending.append((doc_id, ws, z))
                count += len(z)
                if count >= 1500:
                    rows += judge(pending, block, latent, first, runs, digits)
                    pending, count = [], 0
            rows += judge(pending, block, latent, first, runs, digits) if pending else []
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "run", "cosine", "lcs", "answer", "kind"])

    def judge(pending, block, latent, first, runs, digits):
        upto = np.cumsum([0, *(len(z) for _, _, z in pending)])
        z = np.concatenate([z for _, _, z in pending])
        best = _nearest(z, latent, first)
        for d, (doc_id, ws, _) in enumerate(pending):
            mine = best[upto[d] : upto[d + 1]]
            top = mine.max(axis=0)
            near = np.flatnonzero(top >= r.min_cosine)
            own = grams(ws, r.run_words) if len(near) else {}
            for i in near:
                n = 0 if runs[i].keys().isdisjoint(own) else longest_run(ws, own, block[i][1], runs[i], r.run_words)
                if n < r.run_words and top[i] < r.paraphrase_cosine:
                    continue
                at = np.union1d(mine[:, i].argmax(), np.flatnonzero(mine[:, i] >= r.paraphrase_cosine))
                parts = [ws[s : s + r.window] for s in _starts(len(ws), r.window, r.stride)[at]]
                lcs, cosine = max((lcs_length(part, block[i][1]) / len(part), float(c)) for part, c in zip(parts, mine[at, i]))
                answer = len(digits[i] & set(ws)) / len(digits[i]) if digits[i] else 0.0
                if n >= r.run_words or (lcs >= r.min_lcs and answer >= r.min_answer):
                    yield doc_id, block[i][0], n, cosine, lcs, answer, "copied" if n >= r.run_words else "paraphrased"

    return src.mapInPandas(run, schema)

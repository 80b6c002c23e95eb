"""Abusive, hateful and sexual content by compression distance.

Two zstandard dictionaries are trained, on toxic and on ordinary text of labelled
documents. A window (a sentence, or part of a long one) is compressed with either; how
many bytes fewer a character the toxic dictionary needs is its score, and the score of a
document is that of its worst window. Text is folded first, so that disguises (look-alike
letters, invisible characters, digits for letters, stretched or spaced words, masked
words) compress like the plain form. Numbers do not count, and short lines join their
neighbours, so no text is left out.

Labels are of documents and noisy, windows are not labelled. A window of a document
labelled toxic is toxic if parts of the other toxic documents explain it better than parts
of the ordinary ones, each ordinary part holding ``ordinary_parts`` times as many
documents: what is said now and then in ordinary text is explained by those too, so a
wrongly labelled document adds nothing. It must also hold a word, or two in a row, that
toxic documents have ``least_odds`` times as often as ordinary ones, counted over all
labelled documents, and so must the window itself if several ordinary documents have it: a
phrase of ordinary text that wrong labels hit more often than others stays ordinary. The windows are then chosen again by cross-fitting: they are only
ever scored by dictionaries trained without their fold.

The threshold follows the whole corpus. The share r(t) of held-out toxic documents over a
score t and the share c(t) of all other documents over it keep their ratio as long as only
toxic documents pass; where c grows faster, ordinary ones do. Toxic documents are counted
by the ratio in the upper part of r, and the threshold is where precision and recall so
estimated are balanced.

The fit takes at most ``max_toxic`` and ``max_ordinary`` labelled documents, those with
the smallest hashes, of which ``dictionary_docs`` ordinary ones go into the dictionaries;
every document is scored, by its whole text, and counts for the threshold.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, pairwise

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manualmill.session import materialise, unpacked

# fixed values: letters of other scripts that look like Latin ones, and digits or signs used for letters
_ALIKE = str.maketrans("аеорсухіјѕһԁոԛԝмткнвгпαεορτυνικ", "aeopcyxijshdnqwmtkhbrnaeoptuvik")
_LEET = str.maketrans("013457@$!", "oieastasi")
_INVISIBLE = re.compile("[­͏ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁯︀-️﻿]")
_TAG = re.compile(r"</?[a-z][^<>\n]*>|<!--|-->")
_SPACED = re.compile(r"\b(?:[a-z][ .\-_]){3,}[a-z]\b")
_LEETED = re.compile(r"(?<![a-z0-9@$!])(?:[a-z]+[0-9@$!]|[0-9@$!]+[a-z])[a-z0-9@$!]*")
_CODE = re.compile(r"\d{3}|^\d+[a-z]{1,3}$|^[a-z]{1,2}\d+$|^[a-z]+!+$")
_NUMBER = re.compile(r"\b[a-z]{0,2}-?\d[\d.,\-–]*\b")
_LETTER = re.compile("[a-z]")
_STRETCH = re.compile(r"(.)\1{2,}")
_EMPHASIS = re.compile(r"(?<![a-z*])[*_]+|[*_]+(?![a-z*])|[~`#|>]+")
_STARS = re.compile(r"\*+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"[\w*']+")


def _plain(m: re.Match) -> str:
    w = m.group()
    return w if w.isalpha() or len(w) < 3 or _CODE.search(w) else w.rstrip("!").translate(_LEET)


def fold(text: str) -> str:
    """The text in plain lower-case letters, sentences on lines of their own."""
    if text.isascii():
        t = text.lower()
    else:
        t = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower().translate(_ALIKE)
        t = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
    t = _SENTENCE.sub("\n", _TAG.sub(" ", t))
    t = _SPACED.sub(lambda m: re.sub(r"[^a-z]", "", m.group()), t)
    t = _LEETED.sub(_plain, t)
    t = _STRETCH.sub(r"\1", _NUMBER.sub("0", _EMPHASIS.sub(" ", t)))
    return _STARS.sub("*", t) if "*" in t else t


@dataclass(frozen=True)
class Params:
    max_toxic: int = 2000
    max_ordinary: int = 10_000
    dictionary_docs: int = 3000
    window_words: int = 7
    stride: int = 3
    line_chars: int = 16
    toxic_bytes: int = 1 << 18
    ordinary_bytes: int = 1 << 20
    explained: float = 0.4
    level: int = 3
    ordinary_weight: float = 10.0
    folds: int = 4
    rounds: int = 2
    support_docs: int = 100
    supports: int = 6
    ordinary_parts: int = 6
    ordinary_supports: int = 12
    quiet: float = 0.995
    least_lift: float = 0.06
    least_docs: int = 2
    least_pairs: int = 6
    least_odds: float = 10.0
    least_held: int = 8
    seed: int = 5


def lines(text: str, p: Params) -> list[list[str]]:
    """The lines of the folded text as words with letters in them; short lines join the next one, the last the one before."""
    out: list[list[str]] = []
    held: list[str] = []
    size = 0
    for line in fold(text).split("\n"):
        ws = [w for w in line.split() if _LETTER.search(w)]
        held += ws
        size += sum(map(len, ws)) + len(ws)
        if size >= p.line_chars:
            out.append(held)
            held, size = [], 0
    if held and out:
        out[-1] = out[-1] + held
    elif held:
        out.append(held)
    return out


def spans(ws: list[str], p: Params) -> list[str]:
    """A line of moderate length whole, and the longer ones also as overlapping runs of words."""
    out = [" ".join(ws)] if len(ws) <= 2 * p.window_words else []
    if len(ws) > p.window_words + 1:
        last = len(ws) - p.window_words
        out += [" ".join(ws[i : i + p.window_words]) for i in sorted({*range(0, last, p.stride), last})]
    return out


def windows(text: str, p: Params) -> list[str]:
    return list(dict.fromkeys(w for line in lines(text, p) for w in spans(line, p)))


def dictionary(samples: list[str], p: Params, most: int) -> bytes:
    """A dictionary trained on the samples: in growing batches, those that it does not yet explain are added to it, up to ``most`` bytes. The first samples come last, where the compressor looks first."""
    kept: list[bytes] = []
    size, at, step = 0, 0, 500
    while at < len(samples) and size < most:
        z = _compressor(b"\n".join(reversed(kept)) or _NOTHING, p.level)
        for x in (s.encode() for s in samples[at : at + step]):
            if len(z.compress(x)) > p.explained * (len(x) + 8) and size + len(x) < most:
                kept.append(x)
                size += len(x) + 1
        at, step = at + step, int(step * 1.5)
    return b"\n".join(reversed(kept)) or _NOTHING


def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
    z = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    z.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=z, write_checksum=False, write_content_size=False, write_dict_id=False)


class Model:
    """Scores windows and texts. Holds only the dictionaries' bytes and numbers, so it travels.

    ``threshold`` is that of the labelled documents alone, ``held`` are the held-out scores
    of those labelled toxic, ``known`` the hashes of the texts in the fit.
    """

    def __init__(self, ordinary: bytes, toxic: bytes, threshold: float, p: Params, held: np.ndarray | None = None, known: frozenset[int] = frozenset()):
        self.ordinary, self.toxic, self.threshold, self.p, self.held, self.known = ordinary, toxic, threshold, p, held, known
        self._ready = None

    def __getstate__(self):
        return self.ordinary, self.toxic, self.threshold, self.p, self.held, self.known

    def __setstate__(self, s):
        self.__init__(*s)

    def sizes(self, ws: list[str]) -> np.ndarray:
        """Bytes a character with the ordinary and with the toxic dictionary."""
        if self._ready is None:
            self._ready = [_compressor(d, self.p.level).compress for d in (self.ordinary, self.toxic)]
        first, second = self._ready
        out = np.empty((len(ws), 2))
        for i, x in enumerate(w.encode() for w in ws):
            n = len(x) + 8
            out[i] = len(first(x)) / n, len(second(x)) / n
        return out

    def score_windows(self, ws: list[str]) -> np.ndarray:
        return -np.diff(self.sizes(ws), axis=1)[:, 0]

    def score(self, text: str | None) -> tuple[float | None, str | None]:
        """The worst window's score, and that window; null for null texts, -1 for texts without any letter."""
        if text is None:
            return None, None
        ws = windows(text, self.p)
        if not ws:
            return -1.0, None
        s = self.score_windows(ws)
        i = int(s.argmax())
        return float(s[i]), ws[i]


_NOTHING = bytes(64)


def _hash(text: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(text, seed=seed)


def fit_windows(texts: list[str], toxic: list[bool], p: Params) -> Model:
    """Dictionaries, held-out scores and threshold from labelled texts."""
    label = np.array(toxic, bool)
    hash_of = np.array([_hash(t, p.seed) for t in texts], np.uint64)
    cut_up = [[(" ".join(ws), spans(ws, p)) for ws in lines(t, p)] for t in texts]
    line = [x for d in cut_up for x, _ in d]
    line_doc = np.repeat(np.arange(len(texts)), [len(d) for d in cut_up])
    ws = [w for d in cut_up for _, s in d for w in s]
    line_of = np.repeat(np.arange(len(line)), [len(s) for d in cut_up for _, s in d])
    owner = line_doc[line_of]
    inside = label.copy()
    inside[np.flatnonzero(~label)[np.argsort(hash_of[~label])[: p.dictionary_docs]]] = True
    label_w, inside_w, label_l, inside_l = label[owner], inside[owner], label[line_doc], inside[line_doc]
    # Support: how well parts of the ordinary and of the toxic documents explain a window
    part_docs = int(min(p.support_docs, max(1, label.sum() // 2)))
    bytes_by = []
    for kind, docs_each, most, supports in ((False, part_docs * p.ordinary_parts, p.ordinary_bytes, p.ordinary_supports), (True, part_docs, p.ordinary_bytes, p.supports)):
        count = max(2, int((label == kind).sum()) // docs_each)
        part = (hash_of // np.uint64(p.folds)) % np.uint64(count)
        total, seen = np.zeros(len(ws)), np.zeros(len(ws))
        for f in range(min(count, supports)):
            own = (part == f) & (label == kind)
            z = _compressor(dictionary(_pick(line, own[line_doc]), p, most), p.level)
            at = np.flatnonzero(inside_w & ~own[owner])
            total[at] += [len(z.compress(x)) / (len(x) + 8) for x in (ws[i].encode() for i in at)]
            seen[at] += 1
        bytes_by.append(total / np.maximum(seen, 1))
    lift = np.where(inside_w, bytes_by[0] - bytes_by[1], -1.0)
    quiet = lift[~label_w & inside_w]
    cut = max(p.least_lift, float(np.quantile(quiet, p.quiet)) if len(quiet) else 0.0)
    marked = marks(line, line_doc, ws, line_of, label, p)
    bad, fine = label_w & marked & (lift > cut), ~label_w & ~(marked & (lift > cut))
    # ordinary labels on documents that toxic ones explain much better are most likely wrong
    most_lift = np.full(len(texts), -1.0)
    np.maximum.at(most_lift, owner, lift)
    sure = label | inside & (most_lift <= 2 * cut)
    fold_w, fold_l = (hash_of % np.uint64(p.folds)).astype(int)[owner], (hash_of % np.uint64(p.folds)).astype(int)[line_doc]

    def trained(ordinary: np.ndarray, toxic: np.ndarray) -> tuple[bytes, bytes]:
        whole = inside_l & ~label_l
        whole[line_of[~fine]] = False
        return dictionary(_pick(line, whole & ordinary), p, p.ordinary_bytes), dictionary(_pick(ws, bad & toxic), p, p.toxic_bytes)

    for turn in range(p.rounds):
        score = np.full(len(ws), -1.0)
        for f in range(p.folds):
            at = np.flatnonzero(inside_w & (fold_w == f))
            score[at] = Model(*trained(fold_l != f, fold_w != f), 0, p).score_windows([ws[i] for i in at])
        worst = np.full(len(texts), -1.0)
        np.maximum.at(worst, owner, score)
        threshold, _ = calibrate(worst[sure], label[sure], p.ordinary_weight)
        if turn < p.rounds - 1:  # the last scores hold for dictionaries made of these windows
            bad = label_w & marked & (score > threshold) & (lift > cut / 2)
            fine = (~label_w | (lift <= cut) | ~marked) & ~(marked & (score > threshold))
    every_l, every_w = np.ones(len(line), bool), np.ones(len(ws), bool)
    return Model(*trained(every_l, every_w), threshold, p, worst[label], frozenset(int(h) for h in hash_of))


def _runs(text: str) -> set[str]:
    ws = _WORD.findall(text)
    return {*ws, *(f"{a} {b}" for a, b in pairwise(ws))}


def marks(line: list[str], line_doc: np.ndarray, ws: list[str], line_of: np.ndarray, label: np.ndarray, p: Params) -> np.ndarray:
    """Which windows hold a word that is in at least ``least_docs`` toxic documents, or a pair of words in ``least_pairs``, and that is ``least_odds`` times as frequent there as in ordinary ones, and are not themselves, as a whole, windows of several ordinary documents without being so much more frequent in toxic ones."""
    docs = {True: Counter(), False: Counter()}
    for d, held in groupby(range(len(line)), key=line_doc.__getitem__):
        docs[bool(label[d])].update(set().union(*(_runs(line[i]) for i in held)))
    toxic, ordinary = int(label.sum()), int((~label).sum())
    telling = {r for r, n in docs[True].items() if n >= (p.least_pairs if " " in r else p.least_docs) and n * ordinary >= p.least_odds * docs[False][r] * toxic}
    there = np.array([not telling.isdisjoint(_runs(x)) for x in line], bool)
    marked = np.array([there[i] and not telling.isdisjoint(_runs(w)) for i, w in zip(line_of, ws)], bool)
    whole = {True: Counter(), False: Counter()}
    for d, w in {(line_doc[line_of[i]], ws[i]) for i in np.flatnonzero(marked)}:
        whole[bool(label[d])][w] += 1
    usual = {w for w, n in whole[False].items() if n >= p.least_docs and whole[True][w] * ordinary < p.least_odds * n * toxic}
    return marked & np.array([w not in usual for w in ws], bool)


def _pick(ws: list[str], mask: np.ndarray) -> list[str]:
    """Distinct windows, the most frequent first, then in an order that depends on the text only."""
    n = Counter(ws[i] for i in np.flatnonzero(mask))
    return sorted(n, key=lambda w: (-n[w], xxhash.xxh64_intdigest(w)))


def calibrate(worst: np.ndarray, label: np.ndarray, weight: float) -> tuple[float, float]:
    """The threshold with the best F1 on held-out scores, in the middle of its gap, and that F1.

    Ordinary documents count ``weight`` times, as the labelled documents were picked with toxic ones in mind.
    """
    order = np.argsort(-worst, kind="stable")
    hit = np.cumsum(label[order])
    f1 = 2 * hit / (hit + weight * np.cumsum(~label[order]) + max(1, label.sum()))
    k = int(f1.argmax())
    after = worst[order[k + 1]] if k + 1 < len(order) else worst[order[k]] - 0.1
    return float((worst[order[k]] + after) / 2), float(f1[k])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str, p: Params = Params()) -> Model:
    """Fits on a bounded sample of the labelled documents. Null labels do not count; of conflicting ones the majority does, ties drop the document."""
    vote = labels.filter(F.col(doc_id).isNotNull() & F.col(toxic).isin(0, 1)).groupBy(doc_id).agg(F.avg(F.col(toxic).cast("double")).alias("vote")).filter("vote <> 0.5")
    known = docs.select(doc_id, F.col(text).alias("text")).filter("text IS NOT NULL").join(vote, doc_id).select("text", (F.col("vote") > 0.5).alias("toxic"))
    h = F.xxhash64("text")
    rows = known.filter("toxic").orderBy(h, "text").limit(p.max_toxic).collect() + known.filter("NOT toxic").orderBy(h, "text").limit(p.max_ordinary).collect()
    if not any(r.toxic for r in rows) or all(r.toxic for r in rows):
        return Model(_NOTHING, _NOTHING, float("inf"), p)
    return fit_windows([r.text for r in rows], [r.toxic for r in rows], p)


STEPS = 200  # of the score, from 0 to 2


def corpus_threshold(held: np.ndarray, over: np.ndarray, docs: int, p: Params) -> float | None:
    """The threshold where the lesser of estimated precision and recall is largest, from held-out toxic scores and from ``over``, how many of ``docs`` other documents score above each step; none with too few of either."""
    grid = np.arange(2, STEPS) * 2 / STEPS
    r = np.array([(held > t).mean() for t in grid]) if len(held) else np.zeros(len(grid))
    if docs == 0 or r[0] * len(held) < p.least_held:
        return None
    c = over[2:STEPS] / docs
    half = np.flatnonzero((r <= 0.8 * r[0]) & (r >= 0.3 * r[0]) & (c > 0))
    if not len(half):
        return None
    toxic = float(np.median(c[half] / r[half]))  # documents that are toxic, for each share of held-out ones
    least = np.minimum(np.minimum(toxic * r / np.maximum(c, 1e-12), 1.0), r / r[0])
    return float(grid[int(least.argmax())])


def score(docs: DataFrame, doc_id: str, text: str, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, toxic, worst_window, *keep) of every document. Without toxic examples in the fit nothing is toxic.

    Scores are written once; the threshold comes from their counts over all documents that
    are not in the fit.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    types = dict(docs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = held.value
        for b in batches:
            s = [m.score(t) for t in b["text__"]]
            out = b.drop(columns=["text__"])
            out.insert(1, "score", pd.array([x for x, _ in s], dtype="Float64"))
            out.insert(2, "fitted__", [t is not None and _hash(t, m.p.seed) in m.known for t in b["text__"]])
            out.insert(3, "worst_window", [w for _, w in s])
            yield out

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text__"), *keep)
    extra = "".join(f", `{k}` {types[k]}" for k in keep)
    scored = unpacked(src).mapInPandas(run, f"doc_id {types[doc_id]}, score double, fitted__ boolean, worst_window string{extra}")
    threshold = model.threshold
    if model.held is not None:
        scored = materialise(scored, "toxicity")
        step = F.greatest(F.lit(-1), F.least(F.lit(STEPS), F.ceil(F.col("score") * (STEPS / 2)).cast("int") - 1))  # the highest step below the score
        counts = {r.step: r.n for r in scored.filter("score IS NOT NULL AND NOT fitted__").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
        per = np.array([counts.get(i, 0) for i in range(STEPS + 1)])
        found = corpus_threshold(model.held, per[::-1].cumsum()[::-1], sum(counts.values()), model.p)
        threshold = threshold if found is None else found
    toxic = F.coalesce(F.col("score") > threshold, F.lit(False)).alias("toxic")
    return scored.select("doc_id", "score", toxic, "worst_window", *keep)

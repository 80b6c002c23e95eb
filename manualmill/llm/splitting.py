"""Splitting oversized items at natural boundaries, with balanced targets.

For a text over the limit: take the least number of pieces that can hold it, put the cuts
at equal distances, and move each to the strongest boundary nearby. If a piece is still
over the limit, one more piece is planned, until all fit. Consecutive pieces overlap by
the wanted number of characters, the overlap's start being moved forward to a boundary
too. The size of an item is its length in code points ``div 4``, as stored counts are
unreliable; the limit is a parameter.

Items that fit leave the JVM untouched as one piece; only oversized texts go to Python,
one row at a time within an Arrow batch, so memory follows the longest text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# strength of a boundary by what begins or ends there
HEADING, BLANK, ITEM, LINE, SENTENCE, WORD = 6, 5, 4, 3, 2, 1
_MARK = re.compile(
    r"(?P<fence>^[ \t]*(?:```|~~~)[^\n]*\n?)|(?P<heading>^#{1,6}[ \t])|(?P<html><h[1-6]\b)|(?P<blank>\n[ \t]*\n+)|(?P<item>^[ \t]*(?:[-*+]|\d{1,4}[.)])[ \t])|(?P<line>\n)|(?P<sentence>[.!?。][\"')\]]*\s+(?=\S))|(?P<word>\s+)",
    re.MULTILINE,
)
PIECES = "piece int, pieces int, start int, core_start int, end int, text string, cut_at string"
NAMES = {HEADING: "heading", BLANK: "blank line", ITEM: "list item", LINE: "line", SENTENCE: "sentence", WORD: "word", 0: "none"}


@dataclass(frozen=True)
class Limits:
    max_tokens: int = 2000
    overlap_chars: int = 200
    chars_per_token: int = 4

    @property
    def max_chars(self) -> int:
        """The longest text whose size is within the limit."""
        return self.max_tokens * self.chars_per_token + self.chars_per_token - 1


def boundaries(text: str) -> tuple[list[int], list[int]]:
    """Positions where a piece may begin, ascending, and the strength of each. Inside code fences and tables only line ends count, weakly."""
    at: dict[int, int] = {}
    fenced = False
    for m in _MARK.finditer(text):
        kind = m.lastgroup
        if kind == "fence":
            if not fenced:
                at[m.start()] = max(at.get(m.start(), 0), ITEM)
            fenced = not fenced
            if not fenced:
                at[m.end()] = max(at.get(m.end(), 0), ITEM)
            continue
        pos = m.start() if kind in ("heading", "html", "item") else m.end()
        s = {"heading": HEADING, "html": HEADING, "blank": BLANK, "item": ITEM, "line": LINE, "sentence": SENTENCE, "word": WORD}[kind]
        if fenced:
            s = WORD if "\n" in m.group() else 0
        elif s in (BLANK, LINE) and text[pos : pos + 1] == "|":
            # between two rows of a table: better than tearing a row, worse than any other line
            s = BLANK if s == BLANK else SENTENCE
        if s and 0 < pos < len(text):
            at[pos] = max(at.get(pos, 0), s)
    keys = sorted(at)
    return keys, [at[k] for k in keys]


def _snap(keys: list[int], strength: list[int], low: int, high: int, target: int) -> tuple[int, int]:
    """The strongest boundary in [low, high], of equals the nearest to the target, then the earlier; without any the target itself."""
    i, j = bisect_left(keys, low), bisect_right(keys, high)
    if i >= j:
        return target, 0
    k = min(range(i, j), key=lambda x: (-strength[x], abs(keys[x] - target), x))
    return keys[k], strength[k]


def split_text(text: str, limits: Limits) -> list[tuple[int, int, int, int]]:
    """(start, core_start, end, strength of the cut) per piece. The cores tile the text; [start, core_start) repeats the end of the piece before."""
    n, most = len(text), limits.max_chars
    if n <= most:
        return [(0, 0, n, 0)]
    over = max(0, min(limits.overlap_chars, most // 2))
    room = most - over  # for the core of every piece but the first
    keys, strength = boundaries(text)
    count = max(2, -(-(n - over) // room))
    while True:
        step = n / count
        slack = max(1, int(min(step / 3, room - step))) if room > step else 0
        cuts, kinds, last, fits = [], [], 0, True
        for k in range(1, count):
            target = round(k * step)
            low, high = max(last + 1, target - slack), min(n - 1, target + slack, last + (most if last == 0 else room))
            cut, kind = _snap(keys, strength, low, high, min(target, max(low, high))) if low <= high else (target, 0)
            fits &= last < cut < n and cut - last <= (most if last == 0 else room)
            cuts.append(cut), kinds.append(kind)
            last = cut
        if fits and n - last <= room:
            break
        count += 1
    out = []
    for core, end, kind in zip([0, *cuts], [*cuts, n], [0, *kinds]):
        out.append((_overlap_start(keys, core, over) if core and over else core, core, end, kind))
    return out


def _overlap_start(keys: list[int], core: int, over: int) -> int:
    """The first boundary within the wanted overlap, so that it begins with a whole word; without any, exactly the wanted length."""
    low = max(0, core - over)
    i = bisect_left(keys, low)
    return keys[i] if i < len(keys) and keys[i] < core else low


def split(df: DataFrame, item: Column, text: Column, limits: Limits = Limits()) -> DataFrame:
    """One row per distinct item and piece: item_id, size, piece (from 0), pieces, start, core_start, end, text, cut_at.

    Positions count code points; ``text`` is [start, end) and the texts of [core_start, end)
    joined in order give the item back. Null texts give no piece, empty ones a single empty
    piece, rows with a null item keep a null item_id. Repeated rows count once. A limit that
    the overlap would exceed halves the overlap.
    """
    src = df.select(item.alias("item_id"), text.alias("whole"), F.floor(F.length(text) / limits.chars_per_token).cast("int").alias("size")).filter("whole IS NOT NULL")
    src = src.dropDuplicates(["item_id", "whole"])
    fits = src.filter(F.col("size") <= limits.max_tokens)
    n = F.length("whole")
    kept = fits.select("item_id", "size", F.lit(0).alias("piece"), F.lit(1).alias("pieces"), F.lit(0).alias("start"), F.lit(0).alias("core_start"), n.alias("end"), F.col("whole").alias("text"), F.lit("none").alias("cut_at"))
    return kept.unionByName(split_oversized(src, limits))


def split_oversized(src: DataFrame, limits: Limits) -> DataFrame:
    """The pieces of the rows over the limit, no shuffle; src: item_id, whole, size."""
    item_type = dict(src.dtypes)["item_id"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for item_id, whole, size in zip(b["item_id"], b["whole"], b["size"]):
                parts = split_text(whole, limits)
                yield pd.DataFrame(
                    [(item_id, size, i, len(parts), s, c, e, whole[s:e], NAMES[k]) for i, (s, c, e, k) in enumerate(parts)],
                    columns=["item_id", "size", "piece", "pieces", "start", "core_start", "end", "text", "cut_at"],
                )

    return src.filter(F.col("size") > limits.max_tokens).mapInPandas(cut, f"item_id {item_type}, size int, {PIECES}")


def oversized(pieces: DataFrame) -> DataFrame:
    """The items that were cut: (item_id), distinct."""
    return pieces.filter("pieces > 1").select("item_id").distinct()

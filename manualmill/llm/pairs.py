"""Pairing the entries of sorted runs in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def runs(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """The rows of each bucket, without the bucket; the first column names it and the rows come sorted by it."""
    held: list[tuple] = []
    bucket = None
    for b in batches:
        for r in b.itertuples(index=False, name=None):
            if r[0] != bucket and held:
                yield held
                held = []
            bucket = r[0]
            held.append(r[1:])
    if held:
        yield held


def meetings(left: np.ndarray, todo: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each entry its ``todo`` followers, as two index arrays of about ``block`` at a time; one entry with more goes in several blocks."""
    left, todo = left[todo > 0], todo[todo > 0]
    upto = np.cumsum(todo)
    i = 0
    while i < len(left):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + block, side="right")))
        if j == i + 1:
            for cut in range(0, int(todo[i]), block):
                right = left[i] + 1 + np.arange(cut, min(cut + block, int(todo[i])))
                yield np.full(len(right), left[i]), right
        else:
            length = todo[i:j]
            a = np.repeat(left[i:j], length)
            yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(length) - length, length)
        i = j

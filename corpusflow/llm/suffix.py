"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler
transform.

Bytes that a ``window``-byte string covers which also starts earlier are removed.
``repeats`` brings together the suffixes that can share such a string, aligned at
their anchor.  Here they are sorted, and breadth-first backward extension walks
left, one byte a level: the bytes before the sorted suffixes are their
Burrows-Wheeler column, a stable partition by that column (the LF step) gives
the order of the suffixes one byte longer, and their common prefixes are one
more than the smallest in the range that the step comes from.  At each level the
intervals whose common prefix reaches the threshold hold equal windows; their
oldest member is the first place.  Common prefixes are capped at the
threshold, and no level goes further left than a window that still holds the
anchor.

Defined results: a null text counts as empty; texts shorter than a window lose
nothing; a null identifier sorts first; rows repeated with one identifier and
text count as one document; an empty table gives an empty result; columns named
like an output column are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from corpusflow.llm import numerics as N
from corpusflow.llm.repeats import Aligned, RepeatParams, remove_repeats

GRAM = 24


def _range_min(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of x[a..b] (b included, a <= b) of each pair."""
    out = np.empty(len(a), x.dtype)
    level, table = 0, x
    power = np.floor(np.log2(b - a + 1)).astype(np.int64)
    while True:
        now = np.flatnonzero(power == level)
        out[now] = np.minimum(table[a[now]], table[b[now] - (1 << level) + 1])
        if level >= (power.max() if len(power) else 0):
            return out
        table = np.minimum(table[:-(1 << level)], table[1 << level:])
        level += 1


def _sorted_suffixes(al: Aligned, codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes from the anchors, by anchor and then content, and
    each one's common prefix with the one before (up to ``most`` bytes)."""
    size = np.minimum(al.right, most)
    grid = np.zeros((len(size), most), codes.dtype)
    cell = np.arange(most) < size[:, None]
    grid[cell] = codes[N.ragged_index(al.at, size)]         # 0 ends a suffix
    order = np.lexsort((grid.view(f"S{grid.itemsize * most}").ravel(), al.group))
    rows = grid[order]
    same = (rows[1:] == rows[:-1]) & (rows[1:] > 0)
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    lcp[1:][al.group[order][1:] != al.group[order][:-1]] = 0
    return order, lcp


def expand_intervals(al: Aligned, p: RepeatParams) -> np.ndarray:
    """Age of the oldest place of every window of every segment, flat."""
    alphabet = np.flatnonzero(np.bincount(al.v, minlength=256))
    number = np.zeros(256, np.uint8 if len(alphabet) < 256 else np.dtype(">u2"))    # UTF-8 never uses all bytes
    number[alphabet] = np.arange(1, len(alphabet) + 1)
    codes = number[al.v]
    order, lcp = _sorted_suffixes(al, codes, p.window)
    start = N.starts_of(al.windows)
    oldest = np.full(start[-1], -1, np.int64)
    none = len(al.age)
    for t in range(int(al.left.max()) + 1):
        # windows that begin t bytes before the anchor
        o = al.left[order] - t
        valid = (o >= 0) & (o < al.windows[order])
        head = lcp < p.window
        head[0] = True
        first = np.flatnonzero(head)
        low = np.minimum.reduceat(np.where(valid, al.age[order], none), first)
        of = np.cumsum(head) - 1
        oldest[(start[order] + o)[valid]] = low[of[valid]]
        # one byte to the left
        live = np.flatnonzero(al.left[order] > t)
        if not len(live):
            break
        moved = order[live]
        key = al.group[moved] * (len(alphabet) + 1) + codes[al.at[moved] - t - 1].astype(np.int64)
        step = np.argsort(key, kind="stable")
        back, key = live[step], key[step]
        grown = np.zeros(len(step), np.int64)
        pair = np.flatnonzero(key[1:] == key[:-1]) + 1
        if len(pair):
            grown[pair] = np.minimum(1 + _range_min(lcp, back[pair - 1] + 1, back[pair]), p.window)
        order, lcp = moved[step], grown
    return oldest


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 100) -> DataFrame:
    """``docs`` with ``n_units`` (bytes), ``n_removed``, ``removed_spans`` and
    ``clean`` (the remaining bytes)."""
    p = RepeatParams("bytes", min_bytes, min(GRAM, min_bytes), within_document=True)
    return remove_repeats(docs, id_col, text_col, p, expand_intervals)

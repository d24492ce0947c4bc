"""Substring dedup: seed and extend.

Words that a ``min_words``-word window covers are removed when the same words also
start in a document with a smaller identifier.  ``repeats`` joins the
documents on winnowed anchors (the seeds).  From a seed all its matches grow
together: a word to the left or right splits the matches by that word, so that
after t words left and r words right one class holds exactly the segments that
agree over all t + r of them.  Classes that reach the threshold hold equal
windows, their oldest member is the first place, and neighbouring windows join
into maximal repeats.

Defined results: a null text has no words; texts with fewer words than a
window lose nothing; a null identifier sorts first; rows repeated with one
identifier and text count as one document, and rows that share an identifier
never count as an earlier document of each other; an empty table gives an
empty result; columns named like an output column are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from corpusflow.llm import numerics as N
from corpusflow.llm.repeats import Aligned, RepeatParams, remove_repeats

GRAM = 5


def _classes(*keys: np.ndarray) -> np.ndarray:
    """Number of each distinct combination."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def extend_seeds(al: Aligned, p: RepeatParams) -> np.ndarray:
    """Age of the oldest place of every window of every segment, flat."""
    n = len(al.group)
    right = [al.group]                       # right[r]: agree on the anchor's group and r words on
    for r in range(p.window):
        have = al.right > r
        word = np.where(have, al.v[np.where(have, al.at + r, 0)], N.U(0))
        right.append(_classes(right[-1], word, have))
    start = N.starts_of(al.windows)
    oldest = np.full(start[-1], -1, np.int64)
    left = al.group
    for t in range(int(al.left.max()) + 1):
        o = al.left - t
        valid = np.flatnonzero((o >= 0) & (o < al.windows))
        if len(valid):
            same = _classes(left[valid], right[p.window - t][valid])
            low = np.full(int(same.max()) + 1, n, np.int64)
            np.minimum.at(low, same, al.age[valid])
            oldest[start[valid] + o[valid]] = low[same]
        have = al.left > t
        word = np.where(have, al.v[np.where(have, al.at - t - 1, 0)], N.U(0))
        left = _classes(left, word, have)
    return oldest


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 13) -> DataFrame:
    """``docs`` with ``n_units`` (words), ``n_removed``, ``removed_spans`` and
    ``clean`` (the remaining words, joined by one space)."""
    p = RepeatParams("words", min_words, min(GRAM, min_words), within_document=False)
    return remove_repeats(docs, id_col, text_col, p, extend_seeds)

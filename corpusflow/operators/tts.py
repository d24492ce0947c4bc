"""Utterances for speech synthesis from diarised, word-aligned recordings.

One row is one recording with its segments; all its words are cut into utterances
of one speaker each.  Speaker changes come first; then sentences, short ones joined
with those that follow while they stay below the longest duration; then, where there
is no end mark or a sentence is too long, duration, pauses and changes of bandwidth.

Each of these greedy passes has a successor rule (where does the next utterance
start if one starts here?), and following the rule touches every word a bounded
number of times.  A helper gets the times of a recording as flat arrays and returns
the cuts; everything nested is taken apart and put together again by built-ins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END_MARKS = ".!?。？？！。"
BLOCK = 64          # words looked at together


def _first(test, begin: int, stop: int) -> int:
    """First place from ``begin`` on where ``test(a, b)``, an array, holds; else ``stop``."""
    while begin < stop:
        end = min(begin + BLOCK, stop)
        hit = np.flatnonzero(test(begin, end))
        if len(hit):
            return begin + int(hit[0])
        begin = end
    return stop


class Recording:
    """Cuts of one recording.  ``kind`` numbers the bandwidths, ``mark`` says which
    words end a sentence, ``blank`` which are empty."""

    def __init__(self, start, end, speaker, kind, mark, blank, shortest: float, longest: float, pause: float):
        self.s, self.e = np.asarray(start, float), np.asarray(end, float)
        self.speaker, self.mark, self.blank = speaker, np.asarray(mark, bool), np.asarray(blank, bool)
        self.shortest, self.longest = shortest, longest
        n = len(self.s)
        self.break_ = np.zeros(n, bool)              # a pause or another bandwidth before the word
        kind = np.asarray(kind)
        self.break_[1:] = (self.s[1:] - self.e[:-1] > pause) | (kind[1:] != kind[:-1])

    def usable(self, a: int, b: int) -> bool:
        if b - a == 1:
            return not self.blank[a] and not self.e[a] - self.s[a] > self.longest
        return b > a

    def by_time(self, a: int, b: int):
        """Cuts by duration, pause and bandwidth of the words from ``a`` to before ``b``."""
        while a < b:
            begun = self.s[a]

            def over(i, j):
                early = self.e[i - 1:j - 1] - begun >= self.shortest
                return (self.e[i:j] - begun > self.longest) | (self.break_[i:j] & early)

            nxt = _first(over, a + 1, b)
            yield a, nxt
            a = nxt

    def sentences(self, points: np.ndarray) -> list[int]:
        """Which end marks end an utterance.  A sentence is measured from the start of
        the word that carries its mark; a short one takes in the sentences that end
        within the longest duration from there; if the next one does not, both stay."""
        chosen, c = [], 0
        while c < len(points):
            begun = self.s[points[c]]
            if self.e[points[c]] - begun >= self.shortest:
                chosen.append(points[c])
                c += 1
                continue
            last = _first(lambda i, j: self.e[points[i:j]] - begun > self.longest, c + 1, len(points)) - 1
            chosen += [points[last]] if last > c else points[c:c + 2].tolist()
            c = last + 1 if last > c else c + 2
        return chosen

    def of_speaker(self, a: int, b: int, marks_only: bool):
        points = a + np.flatnonzero(self.mark[a:b])
        if not len(points):
            if not marks_only:
                yield from self.by_time(a, b)
            return
        for p in self.sentences(points):
            if self.e[p] - self.s[a] <= self.longest:
                yield a, int(p) + 1
            else:
                yield from self.by_time(a, int(p) + 1)
            a = int(p) + 1
        yield from self.by_time(a, b)

    def cuts(self, marks_only: bool) -> list[tuple[int, int]]:
        speaker = np.asarray(self.speaker, object)
        edges = [0, *(np.flatnonzero(speaker[1:] != speaker[:-1]) + 1).tolist(), len(speaker)]
        return [(x, y) for a, b in zip(edges[:-1], edges[1:]) if a < b and speaker[a] is not None
                for x, y in self.of_speaker(a, b, marks_only) if self.usable(x, y)]


def _codes(values) -> np.ndarray:
    plain = np.asarray(values).dtype.kind in "iufb"
    return pd.factorize(np.asarray(values) if plain else pd.Series(list(values), dtype=object))[0]


def tts_segments(df: DataFrame, segments: str = "segments", min_duration: float = 5, max_duration: float = 20, max_pause: float = 2,
                 terminal_punct_marks: str = END_MARKS, punctuation_split_only: bool = False) -> DataFrame:
    """``segments`` (array of struct with ``speaker``, ``text``, ``words`` (array of
    ``word``, ``start``, ``end``) and ``metrics`` (``pesq_squim``, ``stoi_squim``,
    ``sisdr_squim``, ``bandwidth``)) becomes the array of utterances: ``speaker``,
    ``start``, ``end``, ``text``, ``words`` and the four measures of each word.  Segments
    without text or speaker are left out, as are single words above ``max_duration``
    and utterances without text; a null array stays null."""
    if min_duration > max_duration:
        raise ValueError("min_duration above max_duration")

    @F.pandas_udf("array<struct<a:int,n:int>>")
    def cuts(start: pd.Series, end: pd.Series, speaker: pd.Series, kind: pd.Series, mark: pd.Series, blank: pd.Series) -> pd.Series:
        out = []
        for s, e, who, k, m, b in zip(start, end, speaker, kind, mark, blank):
            found = [] if s is None else Recording(s, e, who, _codes(k), m, b, min_duration, max_duration, max_pause).cuts(punctuation_split_only)
            out.append([{"a": a + 1, "n": z - a} for a, z in found])
        return pd.Series(out)

    measures = ("pesq_squim", "stoi_squim", "sisdr_squim", "bandwidth")
    spoken = F.filter(segments, lambda g: F.coalesce(g["text"].rlike(r"\S"), F.lit(False)) & (F.coalesce(g["speaker"], F.lit("")) != "no-speaker"))
    flat = F.flatten(F.transform(spoken, lambda g: F.transform(
        F.coalesce(g["words"], F.array().cast("array<struct<word:string,start:double,end:double>>")),
        lambda w: F.struct(w["word"].alias("word"), w["start"].cast("double").alias("start"), w["end"].cast("double").alias("end"),
                           g["speaker"].alias("speaker"), *[g["metrics"][m].alias(m) for m in measures]))))
    rows = df.withColumn("_w", flat)

    def each(field: str) -> Column:
        return F.col("_w")[field]

    last = F.transform("_w", lambda w: F.contains(F.lit(terminal_punct_marks), F.substring(w["word"], -1, 1)) & (F.length(w["word"]) > 0))
    rows = rows.withColumn("_c", cuts.asNondeterministic()(each("start"), each("end"), each("speaker"), each("bandwidth"), last,
                                      F.transform("_w", lambda w: F.coalesce(w["word"], F.lit("")) == "")))

    def utterance(c: Column) -> Column:
        w = F.slice("_w", c["a"], c["n"])
        return F.get(F.transform(F.array(w), lambda x: F.struct(
            F.get(x, 0)["speaker"].alias("speaker"), F.get(x, 0)["start"].alias("start"), F.element_at(x, -1)["end"].alias("end"),
            F.array_join(x["word"], " ").alias("text"),
            F.transform(x, lambda y: F.struct(y["word"].alias("word"), y["start"].alias("start"), y["end"].alias("end"))).alias("words"),
            *[x[m].alias(m) for m in measures])), 0)

    return rows.withColumn(segments, F.when(F.col(segments).isNotNull(), F.transform("_c", utterance))).drop("_w", "_c")

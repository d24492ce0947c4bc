"""Two transcripts of one moment, from the customer's microphone and from the
speaker channel: does one bleed into the other, and which text counts (J4, T16, T18).

Everything is a column expression over the two texts and their similarity
(:func:`corpusflow.functions.metrics.similarity`, 0 to 100), which the caller makes
once as a column of its own.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.metrics import similarity_py
from corpusflow.functions.text import words

LOOK_AHEAD = 2       # words that one text may have more than the other before they meet again
ALIKE = 85.0         # similarity above which two words count as one


def _empty(c: Column) -> Column:
    return F.coalesce(F.length(c) == 0, F.lit(True))


def bleeding(mic: Column, speaker: Column, similarity: Column, threshold: float = 0.75) -> Column:
    """Struct of ``score`` -- the larger of the similarity (0 to 1) and the share of
    the speaker's distinct words that the microphone has too -- and ``detected``.
    Without one of the texts: 0 and false."""
    mine, theirs = F.array_distinct(words(F.lower(mic))), F.array_distinct(words(F.lower(speaker)))
    share = F.when(F.size(theirs) > 0, F.size(F.array_intersect(mine, theirs)) / F.size(theirs)).otherwise(F.lit(0.0))
    score = F.when(_empty(mic) | _empty(speaker), F.lit(0.0)).otherwise(F.greatest(similarity / 100.0, share))
    known = ~(_empty(mic) | _empty(speaker))
    return F.struct(score.alias("score"), (known & (score >= threshold)).alias("detected"))


def corrected(mic: Column, speaker: Column, similarity: Column, bleeding_score: Column, bleeding_threshold: float = 0.75,
              similarity_threshold: float = 0.6, prefer_speaker: bool = True) -> Column:
    """Struct of ``text``, ``source`` and ``confidence``, from the first rule that
    holds: no speaker text; bleeding; a speaker text with over one and a half times the
    words; 0.9 similar; similar enough, then the longer text; else the microphone."""
    sim = similarity / 100.0
    n_mic, n_speaker = F.size(words(mic)), F.size(words(speaker))

    def pick(text: Column, source: str, confidence: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(source).alias("source"), confidence.cast("double").alias("confidence"))

    out = F.when(_empty(speaker), pick(mic, "mic", F.lit(0.5))).when(bleeding_score >= bleeding_threshold, pick(speaker, "spk_bleeding", bleeding_score))
    if prefer_speaker:
        out = out.when(n_speaker > n_mic * 1.5, pick(speaker, "spk_preferred", F.lit(0.8)))
    longer = F.when(F.length(speaker) > F.length(mic), speaker).otherwise(mic)
    return (out.when(sim >= 0.9, pick(speaker, "spk_validated", sim))
               .when(sim >= similarity_threshold, pick(longer, "merged", sim)).otherwise(pick(mic, "mic", sim)))


def validated(mic: Column, speaker: Column, similarity: Column, similarity_threshold: float = 80.0, strategy: str = "best_confidence",
              use_cleaner_channel: bool = True) -> Column:
    """Struct of ``text``, ``confidence`` and ``agreement`` (high, medium, low; null
    with an empty text).  Of agreeing texts the speaker's counts if it is preferred,
    else the longer one; of others the cleaner channel's, the speaker's, or the
    microphone's.  The strategy ``consensus`` merges word by word (:func:`consensus`)
    what is at least half alike, unless agreeing texts have a preferred speaker."""
    if strategy not in ("best_confidence", "speaker_priority", "consensus"):
        raise ValueError(f"strategy {strategy!r}")

    def pick(text: Column, confidence: Column, agreement: str | None) -> Column:
        return F.struct(text.alias("text"), confidence.cast("double").alias("confidence"), F.lit(agreement).cast("string").alias("agreement"))

    sure = similarity / 100.0
    speaker_first = strategy == "speaker_priority" or use_cleaner_channel
    agreed = speaker if speaker_first else F.when(F.length(speaker) > F.length(mic), speaker).otherwise(mic)
    fallback = partial = speaker if use_cleaner_channel else mic
    if strategy == "consensus":
        partial = consensus(mic, speaker)
        agreed = speaker if use_cleaner_channel else partial
    return (F.when(_empty(mic) & _empty(speaker), pick(F.lit(""), F.lit(0.0), None)).when(_empty(mic), pick(speaker, F.lit(0.5), None))
             .when(_empty(speaker), pick(mic, F.lit(0.5), None)).when(similarity >= similarity_threshold, pick(agreed, sure, "high"))
             .when(similarity >= 50, pick(partial, sure, "medium")).otherwise(pick(fallback, sure, "low")))


def merged_words(mine: list[str], theirs: list[str]) -> list[str]:
    """Words on which two texts agree, in order, with up to LOOK_AHEAD words that only
    one of them has in between; a word of ``mine`` without a partner so near is skipped,
    and what is left of the longer text follows."""
    known: dict[tuple[str, str], bool] = {}

    def alike(a: str, b: str) -> bool:
        if (a, b) not in known:
            known[a, b] = a == b or similarity_py(a, b) > ALIKE
        return known[a, b]

    out: list[str] = []
    i = j = 0
    while i < len(mine) and j < len(theirs):
        ahead = next((k for k, w in enumerate(theirs[j:j + LOOK_AHEAD + 1]) if alike(mine[i], w)), None)
        if ahead is not None:                    # here, or after words that only the other text has
            out += [*theirs[j:j + ahead], mine[i]]
            i, j = i + 1, j + ahead + 1
            continue
        ahead = next((k for k, w in enumerate(mine[i + 1:i + LOOK_AHEAD + 1], 1) if alike(theirs[j], w)), None)
        if ahead is None:
            i += 1
        else:
            out += mine[i:i + ahead + 1]
            i, j = i + ahead + 1, j + 1
    return out + (mine[i:] or theirs[j:])


@F.pandas_udf(T.StringType())
def _merged(mine: pd.Series, theirs: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else " ".join(merged_words(a.split(" ")[:-1], b.split(" ")[:-1])) for a, b in zip(mine, theirs)], dtype=object)


_merged = _merged.asNondeterministic()        # evaluated once, never copied into a filter


def consensus(mic: Column, speaker: Column) -> Column:
    """T16, strategy ``consensus``: the lower-cased words that both channels have (null
    if one of the texts is)."""
    return _merged(*[F.array_join(F.concat(words(F.lower(c)), F.array(F.lit(""))), " ") for c in (mic, speaker)])     # a blank behind each word

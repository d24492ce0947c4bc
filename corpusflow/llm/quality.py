"""Quality rules, line first.

Every line with a word is held against three kinds of rules; failing lines are
removed, and a document that loses too many of its words is rejected:

* punctuation: the line has to end in a sentence mark (closing quotes and
  brackets may follow), symbols may not outnumber a third of its words, and
  doubled exclamation marks may not outnumber half of them;
* navigation: two or more menu separators, one to four words or fewer;
* boilerplate: licence, copyright, cookie, script and sign-up phrases.

Before that a document fails outright when it is short or mostly repeats
itself (``base_failed``).

Defined results: a null or empty text has no words, fails, and is cleaned to
an empty text; lines without a word are never judged and stay; the columns of
the input pass unchanged, except one named like the output struct, which is
replaced.  Whole texts are judged, one Arrow batch of rows at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import numerics as N

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
LINE_END = r"[.!?…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$"
MENU_MARKS = "|»›·•"
BOILERPLATE = ("(?i)(all rights reserved|licen[sc]ed under|released under the|terms of (use|service)|"
               "privacy policy|cookie (policy|settings)|accept (all )?cookies|enable javascript|"
               "subscribe to our newsletter|sign up for our newsletter|copyright (\\(c\\)|©))")


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_kept_percent: int = 50
    symbols_per_3_words: int = 1
    shouts_per_2_words: int = 1


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, n_lines long, n_bad_lines long, n_bad_words long, kept boolean, clean_text string")

_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
_word, _end, _boiler = re.compile(WORD), re.compile(LINE_END), re.compile(BOILERPLATE)


def line_fails(line: str, n_words: int, p: QualityParams) -> bool:
    symbols = sum(line.count(c) for c in SYMBOLS)
    menu = sum(line.count(c) for c in MENU_MARKS)
    return (not _end.search(line)
            or 3 * symbols > n_words * p.symbols_per_3_words
            or 2 * line.count("!!") > n_words * p.shouts_per_2_words
            or (menu >= 2 and 4 * menu >= n_words)
            or _boiler.search(line) is not None)


def repeated_words(words: list[str]) -> int:
    """Words in three-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, covered, upto = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def judge(text: str | None, p: QualityParams) -> tuple:
    text = text or ""
    words = _word.findall(text)
    seen: set[str] = set()
    keep, n_lines, dup, bad, bad_words = [], 0, 0, 0, 0
    for line in text.split("\n"):
        n = len(_word.findall(line))
        if n:
            n_lines += 1
            dup += line in seen
            seen.add(line)
            if line_fails(line, n, p):
                bad += 1
                bad_words += n
                continue
        keep.append(line)
    repeat = repeated_words(words)
    n = len(words)
    failed = n < p.min_words or 100 * repeat > p.max_repeat_percent * n
    kept = not failed and 100 * (n - bad_words) >= p.min_kept_percent * n
    return (n, len(text) - sum(text.count(c) for c in SEPARATORS), sum(text.count(c) for c in SYMBOLS), dup, repeat,
            failed, n_lines, bad, bad_words, kept, "\n".join(keep))


def quality_column(text: Column, params: QualityParams = QualityParams()) -> Column:
    """Struct of :data:`SCHEMA` for a text column."""
    @F.pandas_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(t, params) for t in texts], columns=_NAMES)

    return run(text)


def quality_rules(docs: DataFrame, text_col: str = "text", out: str = "quality",
                  params: QualityParams = QualityParams()) -> DataFrame:
    """``docs`` with the struct ``out``: counts, ``base_failed``, ``kept`` and
    the text without its failing lines (``clean_text``)."""
    return docs.withColumn(out, quality_column(F.col(text_col), params))


def cleaned(docs: DataFrame, text_col: str = "text", chars_col: str | None = None,
            params: QualityParams = QualityParams()) -> DataFrame:
    """The documents that the rules keep, with the cleaned text in ``text_col`` and,
    if named, its number of characters in ``chars_col``; columns and order of the
    input.  One pass, about a megabyte of texts at a time."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            off = N.utf8(batch.column(at))[1]
            for i, j in N.groups(off):
                part = batch.slice(i, j - i)
                judged = [dict(zip(_NAMES, judge(t, params))) for t in part.column(at).to_pylist()]
                stays = part.filter(pa.array([q["kept"] for q in judged], pa.bool_()))
                texts = [q["clean_text"] for q in judged if q["kept"]]
                new = {text_col: pa.array(texts, pa.string()), chars_col: pa.array([len(t) for t in texts], pa.int64())}
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(new[c], stays.schema.field(c).type) if c in new else stays.column(c) for c in names],
                    names=names)

    return docs.mapInArrow(run, docs.schema)

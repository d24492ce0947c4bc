"""Text functions (Column -> Column), JVM-side wherever a column expression
can carry the semantics.

Whitespace follows Python's ``str.split()`` / ``str.isspace()`` exactly: the
class below lists every code point Python treats as whitespace, so a Java
regex over it splits text the way the curation rules expect.
"""

from __future__ import annotations

import re
from itertools import accumulate

from functools import reduce
from typing import Callable, Iterable, Sequence

import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.regex import shift_group_refs, to_java_pattern, to_java_replacement

# The code points Python's str.isspace() accepts.
PY_WS_CLASS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
WS_RUN = PY_WS_CLASS + "+"

# Python's string.punctuation.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is made once, however often ``f`` reads it."""
    return F.get(F.transform(F.array(value), f), 0)


def words(c) -> Column:
    """``str.split()``: tokens separated by runs of whitespace, no empties."""
    return F.filter(F.split(_c(c), WS_RUN), lambda w: w != F.lit(""))


def remove_extra_spaces(c) -> Column:
    """``' '.join(s.split())``."""
    return F.trim(F.regexp_replace(_c(c), WS_RUN, " "))     # one blank is left at each end at most


def add_start_end_spaces(c) -> Column:
    """One space on each side of the space-normalised text."""
    return F.concat(F.lit(" "), remove_extra_spaces(c), F.lit(" "))


def lower(c) -> Column:
    """T1."""
    return F.lower(_c(c))


def sub_regex(c, params: Sequence[dict], normalise: bool = True) -> Column:
    """Ordered substitutions on the space-padded text, then space
    normalisation.  Each item is ``{"pattern", "repl", "count"}``; ``count``
    0 replaces all, 1 only the leftmost match (anchored lazy prefix); larger
    counts are served by :func:`sub_regex_counted`.
    """
    out = add_start_end_spaces(c) if normalise else _c(c)
    for p in params:
        out = _sub_one(out, p)
    return remove_extra_spaces(out) if normalise else out


def _sub_one(col: Column, p: dict) -> Column:
    pat = to_java_pattern(p["pattern"])
    repl = to_java_replacement(p.get("repl", ""))
    count = int(p.get("count", 0) or 0)
    if count == 0:
        return F.regexp_replace(col, pat, repl)
    if count == 1:
        # leftmost match only: keep the shortest prefix before it
        body = pat[4:] if pat.startswith("(?U)") else pat
        return F.regexp_replace(col, "(?U)(?s)^(.*?)(?-s)(?:" + body + ")",
                                "$1" + shift_group_refs(repl, 1))
    return sub_regex_counted(col, p["pattern"], p.get("repl", ""), count)


def sub_regex_counted(col: Column, pattern: str, repl: str, count: int) -> Column:
    """``re.sub(count=n)`` for n > 1: a per-batch Python helper (no native form)."""
    @F.pandas_udf("string")
    def _sub(s: pd.Series) -> pd.Series:
        import re
        rx = re.compile(pattern)
        return s.map(lambda x: None if x is None else rx.sub(repl, x, count=count))

    return _sub(col)


def count_words(c, alphabet: str | None = None) -> Column:
    """T4: number of words, after optionally deleting characters outside
    ``alphabet``."""
    t = _c(c)
    if alphabet:
        t = F.regexp_replace(t, to_java_pattern("[^" + alphabet + "]"), "")
    return F.size(words(t))


def split_line_by_sentence(c, end_pattern: str) -> Column:
    """T5: array of sentences.  A piece ends at the first character of each
    end-pattern match; text after the last end is lost; with no match the
    stripped line is the only piece.  End patterns are treated as matching at
    each start position independently (single-character end marks)."""
    t = _c(c)
    body = to_java_pattern(end_pattern)
    body = body[4:] if body.startswith("(?U)") else body
    marked = F.regexp_replace(t, "(?U)(?s)(?=" + body + ")(.)", "$1\u0000")
    pieces = F.split(marked, "\u0000")
    n = F.size(pieces)
    strip = lambda x: F.regexp_replace(x, "^" + WS_RUN + "|" + WS_RUN + "$", "")
    return F.when(n > 1, F.transform(F.slice(pieces, 1, n - 1), strip)) \
        .otherwise(F.array(strip(t)))


def make_sentence(c, end_symbol: str = ":", make_uppercase: bool = True, on_empty: str = "fail") -> Column:
    """Upper-case the first character, append ``end_symbol`` when the
    text ends with a letter.  Empty text is an error, as in the rule; with
    ``on_empty="keep"`` it stays empty."""
    if on_empty not in ("fail", "keep"):
        raise ValueError(f"on_empty must be fail or keep, got {on_empty!r}")
    t = _c(c)
    if on_empty == "fail":
        t = F.when(F.length(t) == 0, F.raise_error(F.lit("MakeSentence: empty text"))).otherwise(t)
    if make_uppercase:
        t = F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))
    return F.when(t.rlike("\\p{L}\\z"), F.concat(t, F.lit(end_symbol))).otherwise(t)


def uppercase_after_period(c, punctuation: str = ".!?") -> Column:
    """Upper-case a character that follows ``<punct><space>``.  Matches are
    consuming: the text is cut into the three-character matches and all other
    single characters, and only the former are upper-cased."""
    mark = "[" + "".join("\\" + ch for ch in punctuation) + "]"
    pieces = F.regexp_extract_all(_c(c), F.lit("(?s)" + mark + " .|."), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.when(F.length(x) == 3, F.upper(x)).otherwise(x)), "")


# Latin look-alikes and their Cyrillic letters, position by position.
LATIN_LOOKALIKE = "AaƏəBEeKkMHOoPpCcTYyXxhi"
CYRILLIC_EQUIVALENT = "АаӘәВЕеКкМНОоРрСсТУуХхһі"


def latin_to_cyrillic(c) -> Column:
    """The targets never occur among the sources, so a simultaneous
    ``translate`` equals the sequential replacement of the rule."""
    return F.translate(_c(c), LATIN_LOOKALIKE, CYRILLIC_EQUIVALENT)


def latin_lookalike_count(c) -> Column:
    """Counter of T9: number of Latin look-alike characters in the text."""
    t = _c(c)
    return F.length(t) - F.length(F.translate(t, LATIN_LOOKALIKE, ""))


def charset_ratio(c, charset: str | Column) -> Column:
    """Share of characters of the stripped text that are in
    ``charset``; empty text scores 0.0."""
    t = F.regexp_replace(_c(c), "^" + WS_RUN + "|" + WS_RUN + "$", "")
    cs = F.lit(charset) if isinstance(charset, str) else charset
    n = F.length(t)
    # characters outside the set: delete the set's characters
    outside = _translate_col(t, cs)
    return F.when(n == 0, F.lit(0.0)).otherwise((n - F.length(outside)) / n)


def _translate_col(t: Column, cs: Column) -> Column:
    """``translate(t, cs, '')`` where ``cs`` may be a column (per-row set)."""
    return F.call_function("translate", t, cs, F.lit(""))


def hallucination_flags(c, unique_words_threshold: float = 0.4,
                        long_word_threshold: int = 25,
                        long_word_rel_threshold: float = 3.0, on_empty: str = "fail") -> dict[str, Column]:
    """T12 without the phrase list (that one is a join, see
    ``operators.filters.hallucination_features``).  A text without words raises, as in
    the rule; with ``on_empty="false"`` neither flag of it is set."""
    if on_empty not in ("fail", "false"):
        raise ValueError(f"on_empty must be fail or false, got {on_empty!r}")

    def once(flag) -> Column:
        """``flag`` of the words, which are made once."""
        empty = F.raise_error(F.lit("hallucination features: empty text")) if on_empty == "fail" else F.lit(False)
        return F.get(F.transform(F.array(words(c)), lambda w: F.when(F.size(w) == 0, empty).otherwise(flag(w))), 0)

    def two_longest(acc: Column, word: Column) -> Column:
        size = F.length(word)
        return F.struct(F.greatest(acc["first"], size).alias("first"), F.greatest(acc["second"], F.least(acc["first"], size)).alias("second"))

    def far_longer(two: Column) -> Column:
        second = F.nullif(two["second"], F.lit(-1))
        return (two["first"] >= long_word_threshold) | (F.try_divide(two["first"] - second, second) >= long_word_rel_threshold)

    none = F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("second"))
    repeated = once(lambda w: F.size(F.array_distinct(w)) / F.size(w) <= unique_words_threshold)
    long_word = once(lambda w: F.aggregate(w, none, two_longest, far_longer))
    return {"hall_repeated_ngrams": repeated, "hall_long_word": F.coalesce(long_word, F.lit(False))}


def hallucination_clean(c) -> Column:
    """T12 phrase key: stripped text without ``. ? !``."""
    t = F.regexp_replace(_c(c), "^" + WS_RUN + "|" + WS_RUN + "$", "")
    return F.translate(t, ".?!", "")


# Markers stripped from generated text.
GEN_END_MARKERS = ["<|endoftext|>", "<|im_end|>"]
GEN_START_MARKER = "<|im_start|>"
GEN_PROMPT_LABELS = ["Input transcript:", "Output:", "Output transcript:"]


def clean_generation(c) -> Column:
    """T13 first half: cut at end markers, keep the last start-marker part,
    drop prompt labels and newlines."""
    g = _c(c)
    for m in GEN_END_MARKERS:
        g = F.substring_index(g, m, 1)
    g = F.substring_index(g, GEN_START_MARKER, -1)
    for lab in GEN_PROMPT_LABELS:
        g = F.replace(g, F.lit(lab), F.lit(""))
    return F.replace(g, F.lit("\n"), F.lit(""))


def strip_ascii_punct_lower(c) -> Column:
    t = F.translate(F.lower(_c(c)), ASCII_PUNCTUATION, "")
    return F.regexp_replace(t, "^" + WS_RUN + "|" + WS_RUN + "$", "")


def generation_fallback(generation, text, cer_threshold: float = 10.0,
                        upper_case_threshold: float = 0.6) -> Column:
    """T13 second half: struct of the final ``text`` and the ``replaced`` flag.
    It is one expression over the error rate, so select it into a column and read the
    fields from there: the distance then runs once a row."""
    from corpusflow.functions.metrics import cer

    g = clean_generation(generation)
    t = _c(text)
    chars = F.replace(g, F.lit(" "), F.lit(""))
    total = F.length(chars)
    upper = F.length(F.regexp_replace(chars, "\\P{IsUppercase}+", ""))
    nt = strip_ascii_punct_lower(t)
    ng = strip_ascii_punct_lower(g)
    replace = ((total == 0)
               | (upper / total > upper_case_threshold)
               | (F.length(nt) == 0)
               | (cer(nt, ng) > cer_threshold))
    def pick(flag: Column) -> Column:
        out = F.regexp_replace(F.when(flag, t).otherwise(g), "^" + WS_RUN + "|" + WS_RUN + "$", "")
        return F.struct(out.alias("text"), flag.cast("int").alias("replaced"))

    return F.transform(F.array(replace), pick)[0]


def reconstruct_from_tokens(tokens_sorted: Column, lower_case: bool = False) -> Column:
    """Join tokens by a space and remove the space before ``,.!?;:``."""
    t = F.array_join(tokens_sorted, " ")
    t = F.regexp_replace(t, " ([,.!?;:])", "$1")
    t = F.trim(t)
    return F.lower(t) if lower_case else t


def sentences_by_delimiter(c, delimiter: str = "։") -> Column:
    """Non-empty stripped pieces of the text split on ``delimiter``."""
    parts = F.split(_c(c), to_java_pattern(re.escape(delimiter)))
    parts = F.transform(parts, lambda x: F.regexp_replace(x, "^" + WS_RUN + "|" + WS_RUN + "$", ""))
    return F.filter(parts, lambda x: x != F.lit(""))


def remove_punctuation(c, remove_spaces: bool = True, do_lower: bool = True,
                       exclude: Iterable[str] | None = None) -> Column:
    """Delete ASCII punctuation except ``exclude``; optionally spaces and case."""
    keep = set(exclude or [])
    punct = "".join(ch for ch in ASCII_PUNCTUATION if ch not in keep)
    t = F.translate(_c(c), punct, "")
    if remove_spaces:
        t = F.regexp_replace(t, WS_RUN, "")
    if do_lower:
        t = F.lower(t)
    return t


def shift_alignment(alignment: Column, offset: Column, digits: int = 3) -> Column:
    """Word times plus segment start, rounded (half-even)."""
    return F.transform(alignment, lambda w: w.withField("start", F.bround(w["start"] + offset, digits))
                       .withField("end", F.bround(w["end"] + offset, digits)))


def _outermost(text: str, open_b: str, close_b: str) -> list[str]:
    """Non-empty texts between a bracket that lifts the depth to 1 and the next
    one that brings it back to 0; the depth is a running sum over the brackets."""
    marks = [(m.start(), 1 if m.group() == open_b else -1) for m in re.finditer(f"[{re.escape(open_b + close_b)}]", text)]
    depth = list(accumulate(step for _, step in marks))
    begins = [at + 1 for (at, step), d in zip(marks, depth) if step == 1 and d == 1]
    ends = [at for (at, step), d in zip(marks, depth) if step == -1 and d == 0]
    return [text[a:b] for a, b in zip(begins, ends) if b > a]


def extract_from_brackets(c, brackets: Sequence[str]) -> Column:
    """Texts inside the outermost bracket pairs, bracket kinds in list
    order; nested brackets stay in the text; a stray closer drives the depth
    negative (and so hides later openers), as in the rule.  One linear scan
    per row in an Arrow batch."""
    pairs = [(b[0], b[1]) for b in brackets]

    @F.pandas_udf("array<string>")
    def _ext(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else [t for o, cl in pairs for t in _outermost(x, o, cl)])

    return _ext(_c(c))

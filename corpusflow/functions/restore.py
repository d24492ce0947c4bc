"""Punctuation and case given back to normalised text (T20), written numerals (T21),
sentences of books (T26) and word predictions written onto an alignment (T27)."""

from __future__ import annotations

import re
import string
from collections import deque
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.text import once, words

END = "end_text"
_JOINED = r"(\d)[.,](\d)"
_PUNCTUATION = "[" + re.escape(string.punctuation) + "]"


# --- T20 ---------------------------------------------------------------------

def _agreed(raw: str, norm: str) -> str | None:
    """What stands for both words if they are one but for case and a last mark."""
    if raw[-1] in string.punctuation and raw[:-1].lower() == norm.lower():
        return raw
    if norm[-1] in string.punctuation and norm[:-1].lower() == raw.lower():
        return norm
    return raw if raw.lower() == norm.lower() else None


def _apart(raw: deque) -> tuple[str, bool]:
    """Take a number off the first word: the mark that followed it, and whether the
    word has to be looked at again.  More than one number in a word is an error."""
    mark = ""
    if raw[0][0].isdigit() and not raw[0].isdigit():
        number, rest = re.fullmatch(r"(\d+)(\D+)", raw[0]).groups()
        raw[0] = number
        if rest in string.punctuation:
            mark = rest
        else:
            raw.insert(1, rest)
    if raw[0][-1].isdigit() and not raw[0].isdigit():
        word, number = re.fullmatch(r"(\D+)(\d+)", raw[0]).groups()
        raw[0] = word
        raw.insert(1, number)
        return "", True
    return mark, False


def aligned_text(raw_words: Sequence[str], norm_words: Sequence[str]) -> str:
    """``norm_words`` with the case and marks of ``raw_words``; numbers are taken from
    ``norm_words``, spelled out.  IndexError, AttributeError or ValueError if they part."""
    raw, norm, out = deque([*raw_words, END]), deque([*norm_words, END]), []
    while raw and norm:
        both = _agreed(raw[0], norm[0])
        if both is not None or raw[0] == "¿":
            out.append(both or "¿")
            raw.popleft()
            if both is not None:
                norm.popleft()
            continue
        mark, again = _apart(raw)
        if again:
            continue
        while raw[0].isdigit():
            raw.popleft()
        while norm and _agreed(raw[0], norm[0]) is None:
            out.append(norm.popleft())
        out[-1] += mark
    if norm:
        raise ValueError("normalised words are left")
    return " ".join(out[:-1]).replace("¿ ", "¿")


@F.pandas_udf(T.StringType())
def _aligned(found: pd.Series) -> pd.Series:
    """Of each row the text that the JVM found, else the words (with a blank behind each) aligned here."""
    def one(easy, a, b):
        if easy is not None or a is None or b is None:
            return easy
        try:
            return aligned_text(a.split(" ")[:-1], b.split(" ")[:-1])
        except (IndexError, AttributeError, ValueError):
            return "n/a"

    return pd.Series([None if x is None else one(*x) for x in found], dtype=object)


_aligned = _aligned.asNondeterministic()      # evaluated once, never copied into a filter


def restore_punctuation(raw: Column, norm: Column) -> Column:
    """The normalised text with punctuation and case of the raw one, ``n/a`` where
    they cannot be aligned (a null text cannot).  Texts that agree word by word, the
    usual case, are joined in the JVM; of the others the words go to a helper."""
    def parted(text: Column) -> Column:
        return words(F.replace(text, F.lit("¿"), F.lit(" ¿ ")))

    a = F.transform(parted(raw), lambda w: F.when(w.rlike(_JOINED), F.regexp_replace(w, _JOINED, "$1$2")).otherwise(w))
    b = parted(norm)

    # an inner lambda reads its own argument alone, or Spark does not find the helper's input
    def folded(w: Column) -> Column:
        bare_x, bare_y = F.regexp_replace(w["low_x"], _PUNCTUATION + "$", ""), F.regexp_replace(w["low_y"], _PUNCTUATION + "$", "")
        return (F.when((w["low_x"] == w["low_y"]) | ((w["low_x"] != bare_x) & (bare_x == w["low_y"])), w["x"])
                 .when((w["low_y"] != bare_y) & (bare_y == w["low_x"]), w["y"]))

    def choose(x: Column, y: Column) -> Column:
        pair = F.struct(x.alias("x"), y.alias("y"), F.lower(x).alias("low_x"), F.lower(y).alias("low_y"))
        return F.when(x == y, x).otherwise(once(pair, folded))

    def spaced(w: Column) -> Column:
        return F.array_join(F.concat(w, F.array(F.lit(""))), " ")

    def compared(s: Column) -> Column:
        same = F.when(F.size(s["a"]) == F.size(s["b"]), F.zip_with(s["a"], s["b"], choose))
        return once(F.struct(same.alias("same"), s["a"].alias("a"), s["b"].alias("b")), told)

    def told(s: Column) -> Column:
        easy = F.replace(F.array_join(s["same"], " "), F.lit("¿ "), F.lit("¿"))
        return F.when(~F.exists(s["same"], lambda w: w.isNull()), F.array(easy, F.lit(None), F.lit(None))).otherwise(F.array(F.lit(None), spaced(s["a"]), spaced(s["b"])))

    return F.coalesce(_aligned(once(F.struct(a.alias("a"), b.alias("b")), compared)), F.lit("n/a"))


# --- T21 ---------------------------------------------------------------------

def roman(n: int) -> str:
    """Lower-case Roman numeral of 1 to 3999."""
    out = ""
    for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split()):
        out += sign * (n // value)
        n %= value
    return out


def write_numerals(text: Column, rules: Sequence[tuple[Sequence[str], Mapping[str, str]]]) -> Column:
    """Numerals behind trigger words in writing.  ``rules``: lists of triggers (one
    word each, a regular expression, any case), in order, with their table of lower-case
    numeral -> word.  For each trigger the word behind its first place counts: if the
    table has it, the pair is replaced wherever it stands in that spelling, with a
    capital where the trigger has one.  White space is squeezed."""
    done = F.concat(F.lit(" "), text, F.lit(" "))
    for triggers, table in rules:
        if not triggers or not table:
            continue
        written = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
        done = F.aggregate(F.array(*[F.lit(x) for x in triggers]), done, _numeral_step(written))
    return F.trim(F.regexp_replace(done, r"(?U)\s+", " "))


def _numeral_step(written: Column):
    def step(t: Column, trigger: Column) -> Column:
        found = F.rtrim(F.regexp_substr(t, F.concat(F.lit("(?iu)"), trigger, F.lit(r" \S*\s"))))

        def replaced(m: Column) -> Column:
            parts = F.split(m, " ")
            number = F.try_element_at(written, F.lower(F.get(parts, 1)))
            head = F.substring(m, 1, 1)
            capital = (F.upper(head) == head) & (F.lower(head) != head)
            shown = F.when(capital, F.concat(F.upper(F.substring(number, 1, 1)), F.lower(F.substring(number, F.lit(2), F.length(number))))).otherwise(number)
            return F.when(number.isNotNull() & (F.size(parts) == 2), F.replace(t, m, F.concat(F.get(parts, 0), F.lit(" "), shown)))

        return F.coalesce(F.get(F.transform(F.array(found), replaced), 0), t)

    return step


# --- T26 ---------------------------------------------------------------------

_HOLD = "\u0001"                       # before white space that ends no sentence


def book_sentences(text: Column) -> Column:
    """Sentences of a text.  White space after an end mark parts them, unless the mark
    ends an abbreviation (a capital with or without small letters, or ``x.y.``) or a
    numbering follows.  End marks before a closing quote change places with it."""
    t = F.regexp_replace(text, r"([.?!])([\"'])", "$2$1 ")
    t = F.regexp_replace(t, " +", " ")
    t = F.regexp_replace(t, r"([a-z])\. ([a-z])\.", "$1.$2.")
    t = F.regexp_replace(t, r"(?U)([A-Z][a-z]*\.)(?=\s)", "$1" + _HOLD)
    t = F.regexp_replace(t, r"(?U)(\w\.\w.)(?=\s)", "$1" + _HOLD)
    parts = F.split(t, r"(?U)(?<=\.|\?|!|\.”|\?”!”)\s(?![0-9]+[a-z]*\.)", -1)
    return F.transform(parts, lambda s: F.replace(s, F.lit(_HOLD), F.lit("")))


def packed_sentences(sentences: Column, max_len: int = 7500) -> Column:
    """Sentences joined into blocks that end once they have ``max_len`` characters,
    without digits.  As in the rule, the sentence behind a full block is lost."""
    def strip(block: Column) -> Column:
        return F.regexp_replace(block, r"(?U)^\s+|\s+\z", "")

    start = F.struct(F.lit("").alias("last"), F.array().cast("array<string>").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        room = F.length(acc["last"]) < max_len
        return F.struct(F.when(room, F.concat(acc["last"], F.lit(" "), s)).otherwise(F.lit("")).alias("last"),
                        F.when(room, acc["done"]).otherwise(F.concat(acc["done"], F.array(strip(acc["last"])))).alias("done"))

    def finish(acc: Column) -> Column:
        return F.when(F.length(acc["last"]) > 0, F.concat(acc["done"], F.array(strip(acc["last"])))).otherwise(acc["done"])

    return F.transform(F.aggregate(sentences, start, step, finish), lambda b: F.regexp_replace(b, r"(?U)\d", ""))


def normal_book(text: Column, max_len: int = 7500) -> Column:
    """The blocks of a book's text as one text."""
    return F.array_join(packed_sentences(book_sentences(text), max_len), " ")


# --- T27 ---------------------------------------------------------------------

def write_back(alignment: Column, tokens: Column, word: str = "word") -> Column:
    """The i-th word of ``alignment`` (array of structs) that is not empty takes the
    i-th token; empty ones stay.  Fewer tokens than words is an error."""
    placed = F.transform(alignment, lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    full, empty = F.filter(placed, lambda p: p["w"][word] != ""), F.filter(placed, lambda p: F.coalesce(p["w"][word] == "", F.lit(True)))
    told = F.zip_with(full, F.slice(tokens, F.lit(1), F.greatest(F.size(full), F.lit(0))),
                      lambda p, t: F.struct(p["i"].alias("i"), p["w"].withField(word, t).alias("w")))
    merged = F.transform(F.array_sort(F.concat(told, empty), lambda a, b: a["i"] - b["i"]), lambda p: p["w"])
    short = F.size(tokens) < F.size(full)
    return F.when(short, F.raise_error(F.lit("fewer tokens than words"))).otherwise(merged)

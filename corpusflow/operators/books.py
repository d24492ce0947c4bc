"""Read lines found again in their books.

Lines are brought to their book.  Its words are looked up by the next few of them in
the first words of the lines, and every word of a line is compared with the book's at
its place.
What is left are the places where a line may stand.  Lines are read in order, so of
each book's places a longest chain counts in which a later line begins behind the end
of an earlier one; a line outside the chain is not restored.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word, with apostrophes inside, and what stands before it.
WORD = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"
PIECE = r"[^\p{L}\p{N}]*" + WORD
MISSING = "n/a"


def book_pieces(text: Column) -> Column:
    """The text's words, each with what stands before it."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))


def _normal(piece: Column) -> Column:
    return F.lower(F.regexp_replace(piece, r"[^\p{L}\p{N}]", ""))


def longest_chain(places: list[tuple[int, int, int]]) -> list[int]:
    """Numbers of the places (line, begin, end) of a longest chain: lines rise, and each
    begins at or behind the end of the one before.  Of several, ends as early as possible."""
    ends = sorted({e for _, _, e in places})
    tree = [(0, -1)] * (len(ends) + 1)               # best (length, place) among the first ends
    before = [-1] * len(places)
    order = sorted(range(len(places)), key=lambda k: (places[k][0], places[k][1]))
    best = (0, -1)
    i = 0
    while i < len(order):
        same = i
        found = []
        while same < len(order) and places[order[same]][0] == places[order[i]][0]:
            k = order[same]
            at, top = bisect_right(ends, places[k][1]), (0, -1)
            while at:
                top = max(top, tree[at], key=lambda t: t[0])
                at &= at - 1
            before[k] = top[1]
            found.append((k, top[0] + 1))
            same += 1
        for k, length in found:
            if length > best[0]:
                best = (length, k)
            at = bisect_right(ends, places[k][2])
            while at < len(tree):
                if length > tree[at][0]:
                    tree[at] = (length, k)
                at += at & -at
        i = same
    out, k = [], best[1]
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def places_in_book(book: list[str], lines: list[list[str]], seed_words: int) -> list[tuple[int, int, int]]:
    """(line, begin, end) of every place in the book that has a line's words: the first
    few words of the lines are looked for, then the whole line is compared."""
    seeds: dict[tuple[str, ...], list[int]] = {}
    for k, line in enumerate(lines):
        seeds.setdefault(tuple(line[:seed_words]), []).append(k)
    out = []
    for n in {len(s) for s in seeds}:
        for p, seed in enumerate(zip(*(book[j:] for j in range(n)))):
            out += [(k, p, p + len(lines[k])) for k in seeds.get(seed, ()) if book[p:p + len(lines[k])] == lines[k]]
    return out


def restore_lines(lines: DataFrame, books: DataFrame, book: str = "book", order: str = "seq", text: str = "text",
                  book_text: str = "text", out: str = "restored", seed_words: int = 4) -> DataFrame:
    """``lines`` (unique by ``book`` and ``order``) with ``out``: the stretch of the
    book that has the line's words, with its punctuation and case and with white space
    squeezed, or ``n/a``.  A line without words, or of an unknown book, is ``n/a``; so is
    one whose ``book`` and ``order``, or whose book, comes more than once.

    Books and lines meet once, a book's lines beside its text; words are never rows."""
    @F.pandas_udf("array<struct<k:int,at:int,words:int>>")
    def found(words: pd.Series, asked: pd.Series) -> pd.Series:
        rows = []
        for book_words, texts in zip(words, asked):
            held = places_in_book(book_words.split(" "), [t.split(" ") for t in texts], seed_words)
            rows.append([{"k": held[i][0], "at": held[i][1], "words": held[i][2] - held[i][1]} for i in longest_chain(held)])
        return pd.Series(rows, dtype=object)

    said = F.array_join(F.transform(book_pieces(F.col(text)), _normal), " ")
    asked = (lines.select(F.col(book).alias("_b"), F.col(order).alias("_s"), said.alias("_x")).filter("_x <> '' AND _b IS NOT NULL AND _s IS NOT NULL")
                  .groupBy("_b").agg(F.array_sort(F.collect_list(F.struct("_s", "_x"))).alias("all")))
    single = F.filter("all", lambda z, i: (i == 0) | (z["_s"] != F.get("all", i - 1)["_s"]))
    twice = F.filter("all", lambda z, i: (i > 0) & (z["_s"] == F.get("all", i - 1)["_s"]))
    asked = asked.select("_b", F.when(F.size(twice) == 0, F.col("all")).otherwise(
        F.filter(single, lambda z: ~F.array_contains(F.transform(twice, lambda t: t["_s"]), z["_s"]))).alias("l"))
    shelf = (books.select(F.col(book).alias("_b"), F.col(book_text).alias("_t")).groupBy("_b").agg(F.max("_t").alias("_t"), F.count(F.lit(1)).alias("_n"))
                  .filter("_n = 1 AND _t IS NOT NULL").select("_b", book_pieces(F.col("_t")).alias("raw"),
                                                              F.regexp_extract("_t", r"(?s)[^\p{L}\p{N}]*\z", 0).alias("tail")))
    met = shelf.join(asked, "_b").select("_b", "raw", "tail", "l", found.asNondeterministic()(
        F.array_join(F.transform("raw", _normal), " "), F.transform("l", lambda z: z["_x"])).alias("f"))
    # the book's own spelling: the word before tells what stands at the end, so one piece more is fetched
    stretch = F.transform("f", lambda f: F.struct(F.get("l", f["k"])["_s"].alias("_s"), f["words"].alias("words"),
                                                  F.slice("raw", f["at"] + 1, f["words"] + 1).alias("r"),
                                                  F.when(f["at"] + f["words"] == F.size("raw"), F.col("tail")).alias("tail")))
    got = met.select("_b", F.inline(stretch))
    first = F.regexp_extract(F.get("r", F.lit(0)), r"(?s)\S*" + WORD + r"\z", 0)
    rest = F.array_join(F.slice("r", F.lit(2), F.col("words") - 1), "")
    follows = F.regexp_extract(F.coalesce(F.get("r", F.col("words")), F.lit("")), r"(?s)\A([^\s\p{L}\p{N}]*)(?=\s)", 1)
    end = F.regexp_extract("tail", r"(?s)\A\S*", 0)
    spelled_out = F.trim(F.regexp_replace(F.concat(first, rest, F.coalesce(end, follows)), r"(?U)\s+", " "))
    answers = got.select("_b", "_s", spelled_out.alias(out))
    return (lines.drop(out).join(answers, F.col(book).eqNullSafe(F.col("_b")) & F.col(order).eqNullSafe(F.col("_s")), "left").drop("_b", "_s")
                 .withColumn(out, F.coalesce(out, F.lit(MISSING))))

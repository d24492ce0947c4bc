"""Benchmark decontamination by a broadcast set of test n-grams (native).

The windows of the benchmark items (``words`` consecutive normalised words; an item
of fewer words is one window) are made distinct, hashed and broadcast.  The training
documents are scanned once: every token window is hashed where it stands and probed,
and a hit counts only if its words equal the window's.  No document is shuffled; only
verified hits leave the scan.  Words inside a hit are marked, and hit documents or
their marked spans can be removed.

What is broadcast is measured first: windows of more than ``broadcast_bytes`` are
dealt into as many slices by their hash, and the documents are scanned once for
each slice.  Windows, the items that hold them and the items' identifiers are three
tables, so copies of an item count as one until the identifiers are listed.

Defined results: a null or empty text has no words and no hits; an item without
words marks nothing; an item without identifier marks words but is not listed;
items with one identifier count once; a shorter item has to occur whole; very
long texts are scanned as rows of words, nothing of a document is collected but its
hits; rows repeated with one identifier and text get the same result each; a null
identifier is a document of its own for each text; an empty table of documents
gives an empty result, an empty benchmark no hits; columns named like an output
column are replaced, all others pass unchanged.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.store import stored, without

#: Words in either case; blanks, punctuation and control characters of ASCII part them.
WORD = r"[a-zA-Z0-9\x{80}-\x{10FFFF}]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
OUT = ("n_words", "n_hit", "hit_spans", "item_ids", "contaminated", "clean_text")
_KEY = ["d", "t"]


@dataclass(frozen=True)
class DecontamParams:
    words: int = 10                      # of a window
    broadcast_bytes: int = 64 << 20      # of windows sent to the executors at once


def lower_ascii(word: Column) -> Column:
    """The word with A-Z lowered and nothing else."""
    return (F.when(F.octet_length(word) == F.char_length(word), F.lower(word))
             .otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase)))


def normal_words(text: Column) -> Column:
    """Normalised words of a text (null: none)."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), lower_ascii)


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class ItemWindows:
    windows: DataFrame     # w, n, h, win: distinct windows
    holders: DataFrame     # w, c: windows of each distinct item
    items: DataFrame       # c, item: identifiers of each distinct item


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, params: DecontamParams) -> ItemWindows:
    n = params.words
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), normal_words(F.col(text_col)).alias("x")).filter("size(x) > 0")
    rows = stored(rows.withColumn("c", F.sha2(F.array_join("x", " "), 256)), "items")
    places = F.sequence(F.lit(1), F.greatest(F.size("x") - F.lit(n - 1), F.lit(1)))
    held = (rows.dropDuplicates(["c"])
                .select("c", F.explode(F.transform(places, lambda i: F.slice("x", i, F.lit(n)))).alias("win")).distinct())
    windows = stored(held.select("win").distinct()
                         .select("win", F.size("win").alias("n"), F.xxhash64(F.size("win"), "win").alias("h"),
                                 F.monotonically_increasing_id().alias("w")), "windows")
    return ItemWindows(windows, stored(held.join(windows.select("win", "w"), "win").select("w", "c"), "holders"),
                       rows.filter("item IS NOT NULL").select("c", "item").distinct())


def _probe_hash(n: int) -> Column:
    """Hash of the ``n`` words from position ``p`` on, as :func:`item_windows` has it."""
    return F.xxhash64(F.lit(n), *[F.get("x", F.col("p") + i) for i in range(n)])


def window_hits(docs: DataFrame, found: ItemWindows, id_col: str, text_col: str, params: DecontamParams) -> DataFrame:
    """One scan of the documents: a row with ``head`` for each of them, with its
    ``n_words``, and a row with ``w`` for each verified hit: document key, first
    word ``p`` (from 0), words ``n``, window ``w``.  One row can be both."""
    size = F.sum(F.aggregate("win", F.lit(48), lambda a, x: a + F.octet_length(x) + 16))
    lengths, total = found.windows.agg(F.collect_set("n"), size).first()       # at most ``words`` lengths
    lengths = sorted(lengths) or [params.words]
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("t"), normal_words(text).alias("x")).select(
        "d", "t", "x", F.posexplode_outer("x").alias("p", "word"))             # a text without words: one row, p is null
    if len(lengths) == 1:
        probes = placed.select("d", "t", "x", "p", F.lit(lengths[0]).alias("n"), _probe_hash(lengths[0]).alias("h"))
    else:
        each = F.array(*[F.struct(F.lit(n).alias("n"), _probe_hash(n).alias("h")) for n in lengths])
        probes = placed.select("d", "t", "x", "p", F.inline(each))
    first = (F.coalesce("p", F.lit(0)) == 0) & (F.col("n") == lengths[0])
    slices = max(1, -(-(total or 0) // params.broadcast_bytes))

    def scan(k: int) -> DataFrame:
        part = found.windows if slices == 1 else found.windows.filter(F.pmod("h", F.lit(slices)) == k)
        part = part.select(F.col("h").alias("wh"), F.col("n").alias("wn"), "win", "w")
        same = (F.col("h") == F.col("wh")) & (F.col("n") == F.col("wn")) & (F.slice("x", F.col("p") + 1, F.col("n")) == F.col("win"))
        head = first if k == 0 else F.lit(False)
        return (probes.join(F.broadcast(part), same, "left").withColumn("head", head).filter("head OR w IS NOT NULL")
                      .select("d", "t", "p", "n", "w", "head", F.size("x").cast("long").alias("n_words")))

    return reduce(DataFrame.unionByName, [scan(k) for k in range(slices)])


def _spans(hits: DataFrame) -> DataFrame:
    """Per document with hits: ``n_hit`` and the runs of marked words (``a`` to before ``b``)."""
    on = Window.partitionBy(*_KEY).orderBy("p")
    marks = hits.groupBy(*_KEY, "p").agg((F.col("p") + F.max("n")).alias("e"))        # repeated rows fall together
    reach = F.max("e").over(on.rowsBetween(Window.unboundedPreceding, -1))
    marks = marks.withColumn("run", F.coalesce(F.col("p") > reach, F.lit(True)).cast("int"))
    runs = (marks.withColumn("run", F.sum("run").over(on)).groupBy(*_KEY, "run")
                 .agg(F.min("p").alias("a"), F.max("e").alias("b")))
    return runs.groupBy(*_KEY).agg(F.sum(F.col("b") - F.col("a")).alias("n_hit"),
                                   F.array_sort(F.collect_list(F.struct("a", "b"))).alias("hit_spans"))


def _found(scanned: DataFrame, found: ItemWindows) -> DataFrame:
    """Per document key with hits: ``n_hit``, ``hit_spans``, ``item_ids`` (null: none named)."""
    hits = scanned.filter("w IS NOT NULL")
    items = (hits.select(*_KEY, "w").distinct().join(found.holders, "w").select(*_KEY, "c").distinct()
                 .join(found.items, "c").groupBy(*_KEY).agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    spans, items = _spans(hits).toDF("__d", "__t", "n_hit", "hit_spans"), items.toDF("__e", "__u", "item_ids")
    return spans.join(items, F.col("__d").eqNullSafe(F.col("__e")) & (F.col("__t") == F.col("__u")), "left").drop("__e", "__u")


def _with_found(rows: DataFrame, key: Column, text_key: Column, hits: DataFrame) -> DataFrame:
    out = rows.join(hits, key.eqNullSafe(F.col("__d")) & (text_key == F.col("__t")), "left").drop("__d", "__t")
    return (out.withColumn("n_hit", F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long")))
               .withColumn("hit_spans", F.coalesce("hit_spans", F.array().cast(hits.schema["hit_spans"].dataType)))
               .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
               .withColumn("contaminated", F.col("n_hit") > 0))


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text", params: DecontamParams = DecontamParams()) -> DataFrame:
    """One row for each row of ``docs``: its identifier, ``n_words``, ``n_hit``
    (words inside a hit), ``hit_spans`` (runs of such words, numbered from 0, end
    exclusive), ``item_ids`` (items with a hit, sorted as strings), ``contaminated``.
    The documents are read once."""
    found = item_windows(benchmark, item_col, item_text_col, params)
    scanned = stored(window_hits(docs, found, id_col, text_col, params), "hits")
    heads = scanned.filter("head").select("d", "t", F.greatest("n_words", F.lit(0)).alias("n_words"))
    return _with_found(heads, F.col("d"), F.col("t"), _found(scanned, found)).drop("t").withColumnRenamed("d", id_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", params: DecontamParams = DecontamParams()) -> DataFrame:
    """``docs`` with all its columns and those of :func:`contamination_report`."""
    docs = without(docs, *OUT)
    found = item_windows(benchmark, item_col, item_text_col, params)
    scanned = stored(window_hits(docs, found, id_col, text_col, params), "hits")
    keyed = docs.withColumn("n_words", count_words(F.col(text_col))).withColumn("__k", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return _with_found(keyed, F.col(id_col), F.col("__k"), _found(scanned, found)).drop("__k")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", params: DecontamParams = DecontamParams()) -> DataFrame:
    """:func:`contamination` of ``docs``, with the hit documents removed
    (``remove="documents"``) or with ``clean_text``, the text without its marked
    words and what parts them from the word before (``remove="spans"``)."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove: {remove!r}")
    judged = contamination(docs, benchmark, id_col, text_col, item_col, item_text_col, params)
    if remove == "documents":
        return judged.filter(~F.col("contaminated"))
    text = F.col(text_col)
    pieces = F.regexp_extract_all(text, F.lit(GAP + WORD), F.lit(0))      # each word with the gap before it
    rest = F.regexp_extract(text, GAP + r"\z", 0)
    stays = F.filter(pieces, lambda x, i: ~F.exists("hit_spans", lambda s: (s["a"] <= i) & (i < s["b"])))
    return judged.withColumn("clean_text", F.when(F.col("contaminated"), F.concat(F.array_join(stays, ""), rest)).otherwise(text))

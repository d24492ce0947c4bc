"""Line dedup on a suffix array of line identifiers (native).

Lines with a word become symbols (128 bits of hash); a document is the
sequence of its symbols, and suffixes end with their document.  Distributed
prefix doubling ranks the suffixes: the rank of a suffix by its first ``h``
lines is the number of suffixes that sort before, and the ranks of ``2h`` lines
come from the pairs (rank, rank ``h`` lines on).  A suffix whose prefix occurs
once is settled and leaves, so only repeated lines are carried on; doubling
stops at ``min_lines``.  Suffixes with one rank then are an interval whose
longest common prefix is ``min_lines`` or more.  Its first suffix, by (document,
line), stays; the others' lines are marked, and neighbouring marks join into the
runs that are deleted, with the blank lines inside them.  No longer common prefix
is derived: a run is a union of repeated groups of ``min_lines`` lines, which may
come from different documents, and not always a repeat as a whole.  A repeated line
of ``long_words`` words or more is a run of its own accord, whatever stands around it:
its interval, known from the first ranking, counts beside the others.

Defined results: a null text counts as empty and stays null; lines without a
word are no symbols; of a very long text each line travels as two hashes; rows repeated with one identifier and text count as one
document and get one result; a null identifier sorts first; an empty table
gives an empty result; columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.store import code_point_words, stored, without
from corpusflow.operators.scan import with_prefix_sum

LONG_WORDS = 20          # words from which one repeated line is a run by itself
HAS_WORD = r"[^\x20\x09-\x0D]"
OUT = ("n_lines", "n_removed_lines", "removed_runs", "clean_text")
_DOC = ["d", "t"]


def _line_rows(docs: DataFrame, id_col: str, text_col: str, long_words: int | None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("p"), x.alias("x")))
    rows = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("t"),
                       F.posexplode(F.filter(numbered, lambda s: s["x"].rlike(HAS_WORD))).alias("q", "s"))
    long = [] if long_words is None else [(code_point_words(F.col("s.x")) >= long_words).alias("long")]
    return rows.select("d", "t", "q", F.col("s.p").alias("p"),
                       F.xxhash64("s.x").alias("h1"), F.xxhash64(F.lit(7), F.col("s.x")).alias("h2"), *long)


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur twice or more, with their rank and first suffix."""
    groups = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "t", "q")).alias("first"))
                  .filter("n > 1"))
    return with_prefix_sum(groups, keys, "n", "rank", inclusive=False).select(*keys, "rank", "first")


def _later(cand: DataFrame, n: int, last: str) -> DataFrame:
    """Marks of ``n`` lines, ``q`` to ``e``, for the suffixes that are not their interval's first."""
    return (cand.filter(~F.struct("d", "t", "q").eqNullSafe(F.col("first")))
                .select("d", "t", "q", "p", F.col(last).alias("last"), (F.col("q") + (n - 1)).alias("e")))


def repeated_runs(docs: DataFrame, id_col: str, text_col: str, min_lines: int, long_words: int | None = None) -> DataFrame:
    """Per document with repeats: ``runs``, sorted (first line, last line,
    number of lines with a word), line numbers from 0."""
    lines = stored(_line_rows(docs, id_col, text_col, long_words), "lines")
    on = Window.partitionBy(*_DOC).orderBy("q")
    cand = (lines.join(_ranked(lines, ["h1", "h2"]), ["h1", "h2"])
                 .drop("h1", "h2").dropDuplicates(["d", "t", "q"])
                 .withColumn("last", F.max("p").over(on.rangeBetween(min_lines - 1, min_lines - 1))))
    cand = stored(cand, "suffixes")
    alone = None if long_words is None else _later(cand.filter("long"), 1, "p")
    length = 1
    while length < min_lines:
        step = min(length, min_lines - length)
        pairs = (cand.withColumnRenamed("rank", "r1").drop("first")
                     .withColumn("r2", F.max("r1").over(on.rangeBetween(step, step))).filter("r2 is not null"))
        cand = stored(pairs.join(_ranked(pairs, ["r1", "r2"]), ["r1", "r2"]).drop("r1", "r2"), "suffixes")
        length += step
    later = _later(cand, min_lines, "last")
    if alone is not None:
        later = later.unionByName(alone)
    before = on.rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("q") > F.max("e").over(before) + 1, F.lit(True)).cast("int")
    runs = (later.withColumn("new", new).withColumn("run", F.sum("new").over(on))
                 .groupBy(*_DOC, "run")
                 .agg(F.min("p").alias("a"), F.max("last").alias("b"),
                      (F.max("e") - F.min("q") + 1).alias("lines")))
    return runs.groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("a", "b", "lines"))).alias("runs"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2,
               long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with ``n_lines`` (lines with a word), ``n_removed_lines``,
    ``removed_runs`` (first and last line, lines with a word) and ``clean_text``.
    A run is ``min_lines`` lines or more, or one line of ``long_words`` words or
    more (None: a single line never counts)."""
    docs = without(docs, *OUT)
    runs = repeated_runs(docs, id_col, text_col, min_lines, long_words).toDF("__d", "__h", "__runs")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn("__t", F.xxhash64(text))
    joined = keyed.join(runs, F.col(id_col).eqNullSafe(F.col("__d")) & (F.col("__t") == F.col("__h")), "left").drop("__d", "__h", "__t")
    lines = F.split(text, "\n")

    def piece(k):
        start = F.when(k == 0, F.lit(0)).otherwise(F.get("__runs", k - 1)["b"] + 1)
        stop = F.when(k == F.size("__runs"), F.size(lines)).otherwise(F.get("__runs", k)["a"])
        return F.slice(lines, start + 1, F.greatest(stop - start, F.lit(0)))

    rest = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("__runs")), piece)), "\n")
    return (joined.withColumn("n_lines", F.size(F.filter(lines, lambda x: x.rlike(HAS_WORD))).cast("long"))
                  .withColumn("n_removed_lines", F.coalesce(F.aggregate("__runs", F.lit(0), lambda a, r: a + r["lines"]), F.lit(0)).cast("long"))
                  .withColumn("clean_text", F.when(F.col("__runs").isNull(), F.col(text_col)).otherwise(rest))
                  .withColumn("removed_runs", F.coalesce("__runs", F.array().cast(runs.schema["__runs"].dataType)))
                  .drop("__runs"))

"""Target-distribution importance resampling with segment deduplication.

Documents are weighted by how much likelier their n-gram features are under a
target corpus than under the documents themselves, features hashed into buckets;
Gumbel noise from a hash of the identifier turns the highest scores into a draw
without replacement.

Newlines cut texts into segments (lines).  Corpora repeat lines, so the words and
buckets of a distinct line are made once: bucket totals multiply them by the line's
occurrences, and a document's weight is the sum of its lines' weights.  For runs of
two words or more, the n-grams that reach over a newline belong to no line; they are
made for each document and added separately.

A line that holds more than a quarter of a task's share of all lines is hot; there
are fewer of them than ``4 * partitions``, and their weights are broadcast instead
of joined.  The two bucket tables (``buckets`` rows each, a parameter) are the only
thing that reaches the driver.

Defined results: a null or empty text has no features, weight 0 and no rank; rows
repeated are documents of their own; a null identifier is hashed as ``null`` and
comes after all others among ties; very long texts are cut into lines, and a line
is worked on as a whole; an empty table of documents gives an empty result, an
empty target (or one without words) a gain for the rarest buckets only; no column
but the identifier and the text is read, whatever its name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.decontam import WORD, normal_words
from corpusflow.llm.store import shuffle_partitions, stored

_POS_BITS = 33          # of monotonically_increasing_id, below the partition


@dataclass(frozen=True)
class ResampleParams:
    order: int = 1          # longest run of words that is a feature
    buckets: int = 10000
    min_words: int = 20     # of a document that can be drawn
    percent: int = 10       # of those documents
    seed: int = 2024


def _bucket(feature: Column, p: ResampleParams) -> Column:
    return F.pmod(F.crc32(feature.cast("binary")), F.lit(p.buckets)).cast("int")


def _places(size: Column, k: int) -> Column:
    """Where runs of ``k`` of ``size`` words begin, from 0."""
    return F.when(size >= k, F.sequence(F.lit(0), size - k)).otherwise(F.array().cast("array<int>"))


def line_buckets(words: Column, p: ResampleParams) -> Column:
    """Buckets of all runs of 1 to ``order`` words of one line, repeats kept."""
    def of_size(k: int) -> Column:
        return F.transform(_places(F.size(words), k), lambda i: _bucket(F.array_join(F.slice(words, i + 1, k), " "), p))

    runs = [F.transform(words, lambda w: _bucket(w, p)), *map(of_size, range(2, p.order + 1))]
    return F.concat(*runs) if len(runs) > 1 else runs[0]


def crossing_buckets(text: Column, p: ResampleParams) -> Column:
    """Buckets of the runs of 2 to ``order`` words that lie on several lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    placed = F.flatten(F.transform(lines, lambda x, i: F.transform(normal_words(x), lambda w: F.struct(w.alias("w"), i.alias("i")))))

    def of_size(k: int) -> Column:
        def over(s: Column) -> Column:
            across = F.filter(_places(F.size(s), k), lambda i: F.get(s, i)["i"] != F.get(s, i + (k - 1))["i"])
            return F.transform(across, lambda i: _bucket(F.array_join(F.transform(F.slice(s, i + 1, k), lambda r: r["w"]), " "), p))

        return F.get(F.transform(F.array(placed), over), 0)      # the words are bound once

    return F.concat(*map(of_size, range(2, p.order + 1)))


def _lines(table: DataFrame, text_col: str) -> DataFrame:
    lines = table.select(F.explode_outer(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line"))
    return lines.filter(F.col("line").rlike(WORD))


def segments(table: DataFrame, text_col: str, p: ResampleParams) -> DataFrame:
    """Distinct lines: two hashes, ``occ`` (occurrences), ``n`` (words), ``buckets``."""
    once = _lines(table, text_col).groupBy("line").agg(F.count(F.lit(1)).alias("occ"))
    return stored(once.select("line", "occ", normal_words(F.col("line")).alias("x")).select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), F.col("line")).alias("h2"), "occ",
                                F.size("x").alias("n"), line_buckets(F.col("x"), p).alias("buckets")), "segments")


def bucket_totals(table: DataFrame, lines: DataFrame, text_col: str, p: ResampleParams) -> np.ndarray:
    """Features in each bucket of a table whose distinct lines are ``lines``."""
    inside = lines.select(F.explode("buckets").alias("b"), "occ")
    if p.order > 1:
        across = table.select(F.explode(crossing_buckets(F.col(text_col), p)).alias("b"), F.lit(1).cast("long").alias("occ"))
        inside = inside.unionByName(across)
    totals = np.zeros(p.buckets, np.int64)
    for r in inside.groupBy("b").agg(F.sum("occ").alias("n")).collect():      # ``buckets`` rows at most
        totals[r["b"]] = r["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray, p: ResampleParams) -> np.ndarray:
    """Thousandths of log likelihood ratio that a feature of each bucket brings."""
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + p.buckets) / ((s + 1.0) * (t_all + p.buckets))))
                     for s, t in zip(source.astype(float), target.astype(float))], np.int64)


def _weight(buckets: Column, gain: Column) -> Column:
    return F.aggregate(buckets, F.lit(0).cast("long"), lambda a, b: a + F.get(gain, b))


def importance_weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       target_text_col: str = "text", params: ResampleParams = ResampleParams()) -> DataFrame:
    """One row for each row of ``docs``: ``row``, identifier, ``n_words``,
    ``n_features``, ``weight``."""
    p, parts = params, shuffle_partitions(docs.sparkSession)
    lines = segments(docs, text_col, p)
    gain = F.lit(gains(bucket_totals(docs, lines, text_col, p),
                       bucket_totals(target, segments(target, target_text_col, p), target_text_col, p), p))
    weighed = stored(lines.select("h1", "h2", "occ", F.col("n").cast("long").alias("n_words"),
                                  F.size("buckets").cast("long").alias("n_features"), _weight(F.col("buckets"), gain).alias("weight")), "weights")
    held = F.transform(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(WORD)),
                       lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(7), x).alias("h2")))
    across = crossing_buckets(F.col(text_col), p) if p.order > 1 else F.array().cast("array<int>")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), held.alias("lines"),
                              F.size(across).cast("long").alias("more"), _weight(across, gain).alias("more_weight")), "rows")
    most = max(1, (weighed.agg(F.sum("occ")).first()[0] or 0) // (4 * parts))
    sums = ["n_words", "n_features", "weight"]
    hot = weighed.filter(F.col("occ") > most).select("h1", "h2", *sums)        # fewer than 4 * parts rows
    placed = rows.select("row", F.inline("lines"))
    flagged = placed.join(F.broadcast(hot), ["h1", "h2"], "left")
    rest = (flagged.filter("weight IS NULL").select("row", "h1", "h2")
                   .join(weighed.filter(F.col("occ") <= most).select("h1", "h2", *sums), ["h1", "h2"]))
    by_row = (flagged.filter("weight IS NOT NULL").select("row", *sums).unionByName(rest.select("row", *sums))
                     .groupBy("row").agg(*[F.sum(c).alias(c) for c in sums]))
    zero = F.lit(0).cast("long")
    return (rows.drop("lines").join(by_row, "row", "left")
                .select("row", "id", F.coalesce("n_words", zero).alias("n_words"),
                        (F.coalesce("n_features", zero) + F.col("more")).alias("n_features"),
                        (F.coalesce("weight", zero) + F.col("more_weight")).alias("weight")))


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``row`` and ``rank`` (from 1) in ``order``, a total one: ranges are sorted
    by themselves and shifted by the number of rows in the ranges before."""
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    dealt = stored(dealt.select("row", F.monotonically_increasing_id().alias("at")), "sorted")
    part = F.shiftright("at", _POS_BITS)
    sizes = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))   # one row a range
    shift = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return (dealt.withColumn("part", part).join(F.broadcast(shift), "part")
                 .select("row", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << _POS_BITS) - 1)) + 1).alias("rank")))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        target_text_col: str = "text", params: ResampleParams = ResampleParams()) -> DataFrame:
    """One row for each row of ``docs``: identifier, ``n_features``, ``weight``,
    ``score`` (weight plus noise) and ``rank`` among the drawn (null: not drawn)."""
    p = params
    name = F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    weights = importance_weights(docs, target, id_col, text_col, target_text_col, p)
    scored = stored(weights.withColumn("score", F.col("weight") + noise), "scores")
    able = scored.filter(F.col("n_words") >= p.min_words)
    drawn = able.count() * p.percent // 100
    ranks = _numbered(able, [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("weight").desc(), F.col("row")])
    return (scored.join(ranks.filter(F.col("rank") <= drawn), "row", "left")
                  .select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank"))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              target_text_col: str = "text", params: ResampleParams = ResampleParams()) -> DataFrame:
    """The drawn rows of ``docs``, for identifiers that occur once."""
    drawn = importance_resample(docs, target, id_col, text_col, target_text_col, params)
    wanted = drawn.filter("rank IS NOT NULL").select(F.col(id_col).alias("__id"))
    return docs.join(wanted, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")

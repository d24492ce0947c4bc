"""Mixing sources to target weights.

Sizes are summed per source, the rate ``target / size`` of each source is
derived, and every document is emitted ``floor(rate)`` times plus once more
when a hash of its identifier falls below the fraction of the rate.

Targets: the sources share ``budget`` times all sizes by weight, none above
``max_repeat`` times its own size; what is cut off is shared again by weight
until none is above.  That fixed point is ``least(max_repeat * size, weight *
level)`` for one level, found by passes over the table of sources (a
distributed aggregate each; only sums reach the driver).

Defined results: a null text has size 0 and a document of size 0 is emitted by
the same rule (it adds no words); a null source is a source of its own, last in
the order; rows repeated with one identifier get the same draw; an empty table
gives an empty result; columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.store import code_point_words, stored, without
from corpusflow.operators.scan import with_global_index

#: Sources up to which the table of rates is broadcast; beyond it the join shuffles.
SMALL_SOURCES = 10_000
#: Type of the products that are compared for the level: sizes times weights are beyond 64 bits.
EXACT = "decimal(38,0)"


def unit_draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:key)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sized: DataFrame, weights: Sequence[int], budget: tuple[int, int] = (3, 2),
                   max_repeat: int = 2) -> tuple[DataFrame, int]:
    """Sources with ``source_size``, ``weight`` and ``target`` (and how many
    there are).  ``budget`` is a fraction (numerator, denominator)."""
    per = sized.groupBy("__source").agg(F.sum("size").alias("source_size"))
    per = stored(per.withColumn("__last", F.col("__source").isNull()), "sources")
    indexed = with_global_index(per, ["__last", "__source"], "__i")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    src = stored(indexed.withColumn("weight", F.element_at(turn, (F.col("__i") % len(weights) + 1).cast("int")))
                        .drop("__i", "__last"), "weights")
    n, total = src.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    total = total or 0
    num, den = 0, 1          # the level, as an exact fraction
    while total:
        over = (F.col("weight").cast(EXACT) * F.lit(Decimal(num)).cast(EXACT)
                >= F.col("source_size").cast(EXACT) * F.lit(Decimal(max_repeat * den)).cast(EXACT))
        full, left = src.agg(F.sum(F.when(over, F.col("source_size")).otherwise(0)),
                             F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if not left:
            break
        new = (budget[0] * total - budget[1] * max_repeat * full, budget[1] * left)
        if new == (num, den):
            break
        num, den = new
    level = F.col("weight").cast("double") * F.lit(float(num)) / F.lit(float(den))
    cap = (F.lit(max_repeat) * F.col("source_size")).cast("double")
    target = F.when(F.col("source_size") > 0, F.least(cap, level)).otherwise(F.lit(0.0))
    return src.withColumn("target", target), n


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = (5, 2, 1), budget: tuple[int, int] = (3, 2), max_repeat: int = 2,
                seed: str = "mix", emit: bool = True) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.
    With ``emit`` each document comes ``copies`` times, numbered by
    ``copy_no`` from 1; without it every document comes once."""
    docs = without(docs, "size", "source_size", "target", "copies", "copy_no")
    sized = docs.withColumn("size", code_point_words(F.col(text_col)))
    rates, n = source_targets(sized.select(F.col(source_col).alias("__source"), "size"), weights, budget, max_repeat)
    rates = rates.withColumn("__rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                        .otherwise(F.lit(0.0)))
    rates = rates.select(F.coalesce(F.concat(F.lit("="), "__source"), F.lit("")).alias("__key"),
                         "source_size", "target", "__rate")
    if n <= SMALL_SOURCES:
        rates = F.broadcast(rates)
    whole = F.floor("__rate")
    more = unit_draw(F.col(id_col), seed) < F.col("__rate") - whole
    out = (sized.withColumn("__key", F.coalesce(F.concat(F.lit("="), source_col), F.lit("")))
                .join(rates, "__key")
                .withColumn("copies", (whole + more.cast("long")).cast("int"))
                .drop("__key", "__rate"))
    if not emit:
        return out
    return (out.filter(F.col("copies") > 0)
               .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies")))))

"""Greedy passes over ordered rows as pointers.

A greedy pass ("go on until the limit, then start anew") gives every row one
successor: the row that would start the next group if a group started here.
The successors of all rows come from one prefix sum and one range lookup; which
rows really start a group are the rows that the pointers reach from the first one.
Pointer doubling finds these in log2(groups) joins of narrow rows, so no task
ever walks over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.scan import PID, POS, blocked_cumsum, ordered_blocks, with_prefix_sum
from corpusflow.session import cut_lineage


def reached(pointers: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows ``i`` that the pointers (``i``, ``j``; one for each ``i`` at most, j > i)
    reach from ``starts`` (``i``), these included."""
    levels = []
    jump = cut_lineage(pointers.select("i", "j"))
    while not jump.join(starts, "i", "left_semi").isEmpty():
        levels.append(jump)
        further = jump.select(F.col("i").alias("j"), F.col("j").alias("k"))
        jump = cut_lineage(jump.join(further, "j").select("i", F.col("k").alias("j")))
    found = starts.select("i")
    for level in reversed(levels):                   # places 0, 2^k, 2 * 2^k, ... of the chain so far
        found = cut_lineage(found.union(level.join(found, "i", "left_semi").select("j")).distinct())
    return found


def shard_by_size(df: DataFrame, shard_size: float, size: str, order: Sequence[str], out: str = "shard_id") -> DataFrame:
    """Rows in ``order`` (a total one) fill a shard until the next one would take
    it over ``shard_size``; a shard has one row at least.  ``out`` numbers the shards
    from 0.  A null size counts as 0; a negative one is an error."""
    given = F.coalesce(F.col(size).cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)"))
    narrow = df.select(*order, F.when(given < 0, F.raise_error(F.lit("negative size"))).otherwise(given).alias("_size"))
    blocks = ordered_blocks(narrow, list(order))
    rows = blocked_cumsum(blocks, "_size", "_end")
    rows = cut_lineage(blocked_cumsum(rows.withColumn("_one", F.lit(1).cast("long")), "_one", "_i", inclusive=False).drop("_one"))
    # the first row whose end lies beyond a limit has as its index the number of ends up to there
    limit = (F.col("_end") - F.col("_size") + F.lit(shard_size).cast("decimal(28,6)")).alias("v")
    ends = rows.select(F.col("_end").cast("decimal(38,6)").alias("v"), F.lit(0).alias("ask"), "_i")
    asks = rows.select(limit.cast("decimal(38,6)").alias("v"), F.lit(1).alias("ask"), "_i")
    counted = with_prefix_sum(ends.unionByName(asks), ["v", "ask", "_i"], (1 - F.col("ask")).cast("long"), "upto")
    n = rows.count()
    pointers = (counted.filter("ask = 1").select(F.col("_i").alias("i"), F.greatest(F.col("upto"), F.col("_i") + 1).alias("j"))
                       .filter(F.col("j") < n))
    starts = reached(pointers, rows.filter("_i = 0").select(F.col("_i").alias("i")))
    marked = rows.join(starts.select(F.col("i").alias("_i"), F.lit(1).cast("long").alias("_new")), "_i", "left")
    numbered = blocked_cumsum(marked.withColumn("_new", F.coalesce("_new", F.lit(0).cast("long"))), "_new", "_k")
    shards = numbered.select(*[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], (F.col("_k") - 1).alias(out))
    same = [F.col(c).eqNullSafe(F.col(f"_o{k}")) for k, c in enumerate(order)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return df.drop(out).join(shards, on).drop(*[f"_o{k}" for k in range(len(order))], PID, POS)


def audio_bytes(duration: Column) -> Column:
    """Estimated size of 16-bit audio at 16 kHz, in bytes."""
    return duration * F.lit(16000) * F.lit(2)

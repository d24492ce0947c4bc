"""Distributed ordered scans: global row index, prefix sums and previous-row
values, with or without segment (session) keys.

A single un-partitioned window (``Window.orderBy(x)``) moves every row into
one task.  Instead the rows are range-partitioned on the full order key (ties
are split, because the key ends with a unique column), each range partition
is scanned locally, and the few per-partition totals are carried forward.
The range bounds are sampled, so the sorted frame is checkpointed into the
shared checkpoint folder before it is used twice; both uses then see the
same partitions.

Per-segment variants (a running sum inside each session) carry the totals
per (partition, segment): a hot session that spans many range partitions
is still split across tasks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import cut_lineage

PID, POS = "_pid", "_pos"
_POS_BITS = 33


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def ordered_blocks(df: DataFrame, order: Sequence, num_partitions: int | None = None) -> DataFrame:
    """Range-sort on ``order`` (must be a total order) and tag each row with
    its range partition and position inside it.  Checkpointed."""
    n = num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    srt = df.repartitionByRange(int(n), *_cols(order)).sortWithinPartitions(*_cols(order))
    mid = F.monotonically_increasing_id()
    tagged = srt.withColumn("_mid", mid) \
        .withColumn(PID, F.shiftright(F.col("_mid"), _POS_BITS)) \
        .withColumn(POS, F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))).drop("_mid")
    return cut_lineage(tagged)


def _block_offsets(blocks: DataFrame, value: Column | None, segment: Sequence[str]) -> DataFrame:
    keys = [PID] + list(segment)
    agg = F.count("*") if value is None else F.sum(value)
    totals = blocks.groupBy(*keys).agg(agg.alias("_t"))
    w = Window.partitionBy(*segment).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, F.coalesce(F.sum("_t").over(w), F.lit(0)).alias("_off"))


def with_global_index(df: DataFrame, order: Sequence, out: str = "_idx",
                      num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order``."""
    blocks = ordered_blocks(df, order, num_partitions)
    offsets = _block_offsets(blocks, None, [])
    # one row per range partition: bounded by the partition count; the position
    # inside the partition is already there, so nothing is shuffled again
    return (blocks.join(F.broadcast(offsets), PID)
                  .withColumn(out, (F.col("_off") + F.col(POS)).cast("long"))
                  .drop(PID, POS, "_off"))


def blocked_cumsum(blocks: DataFrame, value, out: str, segment: Sequence[str] = (),
                   inclusive: bool = True) -> DataFrame:
    """Running sum on a frame from :func:`ordered_blocks` (keeps the block
    columns, so several scans can share one checkpoint)."""
    v = F.col(value) if isinstance(value, str) else value
    b = blocks.withColumn("_v", v)
    offsets = _block_offsets(b, F.col("_v"), list(segment))
    frame = (Window.unboundedPreceding, 0) if inclusive else (Window.unboundedPreceding, -1)
    w = Window.partitionBy(PID, *segment).orderBy(POS).rowsBetween(*frame)
    joined = b.withColumn("_loc", F.coalesce(F.sum("_v").over(w), F.lit(0)))
    if segment:
        joined = joined.join(offsets, [PID, *segment])
    else:
        # one row per range partition: bounded by the partition count
        joined = joined.join(F.broadcast(offsets), PID)
    return joined.withColumn(out, F.col("_off") + F.col("_loc")).drop("_loc", "_off", "_v")


def blocked_previous(blocks: DataFrame, value, out: str, segment: Sequence[str] = ()) -> DataFrame:
    """Previous row's ``value`` inside the segment, on a blocked frame."""
    v = F.col(value) if isinstance(value, str) else value
    b = blocks.withColumn("_pv", v)
    keys = [PID, *segment]
    w = Window.partitionBy(*keys).orderBy(POS)
    lasts = b.groupBy(*keys).agg(F.max_by("_pv", POS).alias("_last"))
    carry = lasts.select(*keys, F.lag("_last").over(Window.partitionBy(*segment).orderBy(PID)).alias("_carry"))
    tagged = b.withColumn("_lag", F.lag("_pv").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    joined = tagged.join(carry if segment else F.broadcast(carry), keys)
    return (joined.withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
                  .drop("_lag", "_first", "_carry", "_pv"))


def with_prefix_sum(df: DataFrame, order: Sequence, value, out: str,
                    segment: Sequence[str] = (), inclusive: bool = True,
                    num_partitions: int | None = None) -> DataFrame:
    """Running sum of ``value`` in ``order`` (restarting per ``segment``).
    ``order`` must start with the segment columns when a segment is given."""
    blocks = ordered_blocks(df, order, num_partitions)
    return blocked_cumsum(blocks, value, out, segment, inclusive).drop(PID, POS)


def with_previous(df: DataFrame, order: Sequence, value: str, out: str,
                  segment: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Value of the previous row in ``order`` inside the segment (NULL for
    the first row of a segment)."""
    blocks = ordered_blocks(df, order, num_partitions)
    return blocked_previous(blocks, value, out, segment).drop(PID, POS)

"""Sort, limit, sample and shard assignment.

Row positions are computed with the distributed index of
:mod:`corpusflow.operators.scan`, never with an un-partitioned window, and
"random" orders are seeded hashes so they do not depend on partitioning.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.operators.scan import with_global_index
from corpusflow.sources.manifest import SEQ


def sort_manifest(df: DataFrame, attribute_sort_by: str, descending: bool = True) -> DataFrame:
    """L1: stable sort (ties keep file order).  NULL keys are an error, as
    in the rule."""
    key = F.col(attribute_sort_by)
    checked = df.withColumn(attribute_sort_by,
                            F.when(key.isNull(), F.raise_error(F.lit(f"NULL in sort key {attribute_sort_by}")))
                             .otherwise(key))
    order = [key.desc() if descending else key.asc()]
    if SEQ in df.columns:
        order.append(F.col(SEQ).asc())
    return checked.orderBy(*order)


def limit_entries(df: DataFrame, max_entries: int, order: Sequence | None = None) -> DataFrame:
    """L2: the first ``max_entries`` rows in file order; <= 0 means all."""
    if max_entries <= 0:
        return df
    order = list(order or [SEQ])
    return with_global_index(df, order, "_i").filter(F.col("_i") < max_entries).drop("_i")


def percent_limit(df: DataFrame, percent: float, order: Sequence | None = None) -> DataFrame:
    """L3: first ``percent`` % of rows (at least one)."""
    n = df.count()
    return limit_entries(df, max(1, int(n * percent / 100)), order)


def hash_order(seed: int, key: Column) -> Column:
    """Seeded pseudo-random order that does not depend on partitioning."""
    return F.xxhash64(F.lit(seed), key)


def sample_fraction(df: DataFrame, part: float, random_state: int = 100, key: str = SEQ) -> DataFrame:
    """L4: exactly ``round(n * part)`` rows chosen by a seeded hash order."""
    n = df.count()
    k = int(round(n * part))
    idx = with_global_index(df, [hash_order(random_state, F.col(key)), F.col(key)], "_i")
    return idx.filter(F.col("_i") < k).drop("_i")


def topk_labels(scores: Column, k: int = 1, label: str = "label", prob: str = "label_prob",
                n_labels: int | None = None) -> dict[str, Column]:
    """From ``array<struct<label, prob>>`` the k best as columns: ``label``
    and ``label_prob`` for k=1, else ``label_1``, ``label_prob_1``, ... in order.
    ``k=-1`` takes all ``n_labels`` labels of the model.  Equal probabilities keep
    the order of their labels."""
    if k == -1:
        if n_labels is None:
            raise ValueError("k=-1 needs n_labels, the number of labels of the model")
        k = n_labels
    ranked = F.array_sort(scores, lambda a, b: F.when(a["prob"] > b["prob"], -1).when(a["prob"] < b["prob"], 1)
                          .when(a["label"] < b["label"], -1).when(a["label"] > b["label"], 1).otherwise(0))
    if k == 1:
        return {label: F.get(ranked, F.lit(0))["label"], prob: F.get(ranked, F.lit(0))["prob"]}
    return {f"{name}_{i + 1}": F.get(ranked, F.lit(i))[field]
            for i in range(k) for name, field in ((label, "label"), (prob, "prob"))}


def shard_equal_chunks(df: DataFrame, num_shards: int, shuffle: bool = True, shuffle_seed: int = 42,
                       key: str = SEQ, out: str = "shard_id") -> DataFrame:
    """(seeded) shuffle, then chunks of ``ceil(n / num_shards)`` rows."""
    n = df.count()
    per = max(1, math.ceil(n / num_shards))
    order = [hash_order(shuffle_seed, F.col(key)), F.col(key)] if shuffle else [F.col(key)]
    idx = with_global_index(df, order, "_i")
    return idx.withColumn(out, F.floor(F.col("_i") / per).cast("int")).drop("_i")


def shard_contiguous(df: DataFrame, num_shards: int, shuffle: bool = True, shuffle_seed: int = 42,
                     keep_files_together: bool = False, key: str = SEQ, file_key: str = "audio_filepath",
                     out: str = "shard_id") -> DataFrame:
    """D3: ``n // num_shards`` rows per shard, the remainder is discarded.
    With ``keep_files_together`` rows of one file stay adjacent (ordered by
    the file's hash, then file order)."""
    n = df.count()
    per = n // num_shards
    if shuffle and keep_files_together:
        order = [hash_order(shuffle_seed, F.col(file_key)), F.col(file_key), F.col(key)]
    elif shuffle:
        order = [hash_order(shuffle_seed, F.col(key)), F.col(key)]
    else:
        order = [F.col(key)]
    idx = with_global_index(df, order, "_i")
    return (idx.filter(F.col("_i") < per * num_shards)
               .withColumn(out, (F.floor(F.col("_i") / F.lit(max(per, 1)))).cast("int"))
               .withColumn("_shard_pos", F.col("_i") - F.col(out) * per)
               .drop("_i"))


def duration_bucket(duration: Column, min_duration: float, max_duration: float, buckets_num: int) -> Column:
    """Equal-width buckets over [min, max); the last bucket also takes
    ``max`` (edge + 1e-5); outside -> NULL."""
    width = (max_duration - min_duration) / float(buckets_num)
    b = F.floor((duration - F.lit(min_duration)) / F.lit(width)).cast("int")
    last_edge = min_duration + (buckets_num - 1) * width + width + 1e-5
    return (F.when((duration >= min_duration) & (b < buckets_num), b)
             .when((duration >= min_duration) & (duration < last_edge), F.lit(buckets_num - 1)))


def round_robin(df: DataFrame, num_shards: int, seed: int = 42, key: str = SEQ, out: str = "shard_id") -> DataFrame:
    """D5 (sessions may split): shuffled rows dealt round-robin."""
    idx = with_global_index(df, [hash_order(seed, F.col(key)), F.col(key)], "_i")
    return idx.withColumn(out, F.pmod(F.col("_i"), F.lit(num_shards)).cast("int")).drop("_i")


def append_shards(base: DataFrame, new: DataFrame, num_shards: int, shuffle: bool = True,
                  shuffle_seed: int = 42, key: str = SEQ, out: str = "shard_id") -> DataFrame:
    """New rows are cut into full shards of the base shard size
    (remainder discarded), numbered after the base's last shard.  A base without a
    full shard gives no shard size; that is an error if there are new rows."""
    agg = base.agg(F.max(out).alias("m"), F.count("*").alias("n")).first()
    base_shards = (agg["m"] + 1) if agg["m"] is not None else 0
    per = agg["n"] // base_shards if base_shards else 0
    n_new = new.count()
    if per == 0 and n_new:
        raise ValueError("the base has no full shard to take the shard size from")
    if per == 0:
        return base
    order = [hash_order(shuffle_seed, F.col(key)), F.col(key)] if shuffle else [F.col(key)]
    idx = with_global_index(new, order, "_i")
    full = (n_new // per) * per
    added = (idx.filter(F.col("_i") < full)
                .withColumn(out, (F.floor(F.col("_i") / per) + base_shards).cast("int")).drop("_i"))
    return base.unionByName(added, allowMissingColumns=True)


def sample_names(df: DataFrame, shard_col: str = "shard_id", path_key: str = "audio_filepath",
                 offset_key: str = "offset", duration_key: str = "duration", order: Sequence[str] = (SEQ,)) -> DataFrame:
    """Names inside a shard, in ``path_key`` (the old path goes to
    ``abs_audio_filepath``).  ``/`` and ``.`` of the path become ``_``, its extension
    stays.  Without an offset column the n-th repeat of a name in its shard gets
    ``-sub{n}`` (n >= 1); with one the name carries offset and duration, dots as
    ``_`` and a whole number with ``_0``, and the offset becomes ``source_audio_offset``."""
    path = F.col(path_key)
    ext = F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]*)$", 1)
    base = F.translate(F.substring(path, F.lit(1), F.length(path) - F.length(ext)), "/.", "__")

    def number(c: str) -> Column:
        t = F.col(c).cast("string")
        parts = F.split(t, r"\.")
        bad = F.raise_error(F.concat(F.lit(f"{c} is not a number: "), t))
        return F.when(F.size(parts) == 1, F.concat(t, F.lit("_0"))).when(F.size(parts) == 2, F.array_join(parts, "_")).otherwise(bad)

    if offset_key in df.columns:
        name = F.concat(base, F.lit("_"), number(offset_key), F.lit("_"), number(duration_key), ext)
        out = df.withColumn("_name", name).withColumnRenamed(offset_key, "source_audio_offset")
    else:
        named = df.withColumn("_base", base).withColumn("_ext", ext)
        nth = F.row_number().over(Window.partitionBy(shard_col, "_base", "_ext").orderBy(*order)) - 1
        sub = F.when(nth > 0, F.concat(F.lit("-sub"), nth.cast("string"))).otherwise(F.lit(""))
        out = named.withColumn("_name", F.concat("_base", sub, "_ext")).drop("_base", "_ext")
    return out.withColumn("abs_audio_filepath", path).withColumn(path_key, F.col("_name")).drop("_name")


def split_fixed_duration(df: DataFrame, segment_duration: float, drop_last: bool = True,
                         drop_text: bool = True, duration_key: str = "duration") -> DataFrame:
    """``floor(d / L)`` pieces of length L with their offsets; with
    ``drop_last=False`` the remainder becomes one more piece."""
    d = F.col(duration_key)
    full = F.floor(d / segment_duration).cast("int")
    rem = d - full * F.lit(segment_duration)
    n = full if drop_last else F.when(rem > 0, full + 1).otherwise(full)
    pieces = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i < n)
    out = (df.withColumn("_i", F.explode(pieces))
             .withColumn("offset", F.col("_i") * F.lit(segment_duration))
             .withColumn(duration_key, F.when(F.col("_i") < full, F.lit(segment_duration)).otherwise(rem))
             .drop("_i"))
    return out.drop("text") if drop_text and "text" in df.columns else out

"""Joins (J1-J16).

Equi-joins are left to Catalyst/AQE (sort-merge by default, broadcast when
a side is small at run time, skewed partitions split).  ``broadcast`` is only
forced on sides whose size is bounded by construction (parameter tables).

Interval joins never pair every row of a session with every other: both
sides are exploded into the fixed-width time buckets they touch, joined on
(session, bucket), and each overlapping pair is kept once, in the bucket that
holds the start of the overlap.  A session with a third of all rows is
therefore spread over its buckets.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.sources.manifest import SEQ


def inner_join(left: DataFrame, right: DataFrame, column_id: str | Sequence[str] | None = None) -> DataFrame:
    """Inner join on the given key(s), or on every common column when
    None; other columns present on both sides get ``_x`` / ``_y``.  Keys
    match NULL with NULL (pandas semantics)."""
    lcols = [c for c in left.columns if c != SEQ]
    rcols = [c for c in right.columns if c != SEQ]
    if column_id is None:
        keys = [c for c in lcols if c in rcols]
    else:
        keys = [column_id] if isinstance(column_id, str) else list(column_id)
    common = [c for c in lcols if c in rcols and c not in keys]
    l2 = left.select(*[F.col(c).alias(c + "_x" if c in common else c) for c in lcols]).alias("l")
    r2 = right.select(*[F.col(c).alias(c + "_y" if c in common else c) for c in rcols]).alias("r")
    cond = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    out_cols = [F.col(f"l.{c}_x" if c in common else f"l.{c}") for c in lcols]
    out_cols += [F.col(f"r.{c}_y" if c in common else f"r.{c}") for c in rcols if c not in keys]
    return l2.join(r2, cond, "inner").select(*out_cols)


def pair_key(session: Column, offset: Column, duration: Column) -> Column:
    """J2 key: ``{session}_{offset:.2f}_{duration:.2f}``."""
    return F.format_string("%s_%.2f_%.2f", session, offset, duration)


def dedup_last(df: DataFrame, key: str, order: str = SEQ) -> DataFrame:
    """Last row per key in file order (partial aggregation, skew-safe)."""
    others = [c for c in df.columns if c not in (key,)]
    packed = F.struct(F.col(order).alias("_o"), *[F.col(c) for c in others if c != order])
    agg = df.groupBy(key).agg(F.max(packed).alias("_r"))
    return agg.select(key, *[F.col("_r")[c].alias(c) for c in others if c != order],
                      F.col("_r._o").alias(order))


def overlap_ratio(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Overlap length / the shorter duration (0 when disjoint or empty)."""
    ov = F.least(e1, e2) - F.greatest(s1, s2)
    mn = F.least(e1 - s1, e2 - s2)
    return F.when((ov > 0) & (mn > 0), ov / mn).otherwise(F.lit(0.0))


def _buckets(start: Column, end: Column, width: float) -> Column:
    return F.sequence(F.floor(start / width).cast("long"), F.floor(end / width).cast("long"))


def interval_pairs(left: DataFrame, right: DataFrame, session: str, l_start: str, l_end: str,
                   r_start: str, r_end: str, bucket_width: float, tolerance: float = 0.0) -> DataFrame:
    """All (left, right) pairs of one session whose intervals overlap
    (left widened by ``tolerance`` on both sides).  Right columns must
    already be prefixed so names do not clash; ``session`` is the left name
    and ``"r_" + session`` the right one."""
    ls = F.col(l_start) - tolerance
    le = F.col(l_end) + tolerance
    lb = left.withColumn("_b", F.explode(_buckets(ls, le, bucket_width)))
    rb = right.withColumn("_b", F.explode(_buckets(F.col(r_start), F.col(r_end), bucket_width)))
    j = lb.join(rb, (lb[session] == rb["r_" + session]) & (lb["_b"] == rb["_b"]), "inner")
    # keep each pair once: in the bucket holding the start of the overlap
    ov_start = F.greatest(ls, F.col(r_start))
    keep = (F.least(le, F.col(r_end)) > ov_start) & (lb["_b"] == F.floor(ov_start / bucket_width))
    return j.filter(keep).drop(rb["_b"]).drop(lb["_b"])


def first_overlapping(left: DataFrame, right: DataFrame, session: str, start: str, duration: str,
                      left_key: Sequence[str], right_key: Sequence[str], min_overlap: float = 0.5,
                      bucket_width: float = 30.0, tolerance: float = 0.0, share_of: str = "shorter",
                      right_order: Sequence[str] | None = None, right_prefix: str = "r_") -> DataFrame:
    """For each left row the first right row, by ``right_order`` and then
    ``right_key``, of the same session whose overlap with the left interval,
    widened by ``tolerance``, exceeds ``min_overlap``.  ``share_of``: the overlap
    is a share of the "shorter" interval (J3) or of the "left" duration, not
    widened (J5).  Left rows without a partner keep NULL right columns.

    Only keys and times are spread over time buckets; the partner's columns are
    fetched by its key afterwards.  The keys identify rows; nothing depends on
    how the frames are partitioned."""
    lk = {f"_l{i}": F.col(c) for i, c in enumerate(left_key)}
    rk = {f"_r{i}": F.col(c) for i, c in enumerate(right_key)}
    ro = {f"_o{i}": F.col(c) for i, c in enumerate(right_order or ())}
    lnarrow = left.select(*[v.alias(k) for k, v in lk.items()], F.col(session).alias("_s"),
                          F.col(start).alias("_ls"), (F.col(start) + F.col(duration)).alias("_le"),
                          F.col(duration).alias("_ld"))
    rnarrow = right.select(*[v.alias(k) for k, v in (ro | rk).items()], F.col(session).alias("r__s"),
                           F.col(start).alias("_rs"), (F.col(start) + F.col(duration)).alias("_re"))
    pairs = interval_pairs(lnarrow, rnarrow, "_s", "_ls", "_le", "_rs", "_re", bucket_width, tolerance)
    ls, le = F.col("_ls") - tolerance, F.col("_le") + tolerance
    if share_of == "left":
        ratio = (F.least(le, F.col("_re")) - F.greatest(ls, F.col("_rs"))) / F.col("_ld")
    else:
        ratio = overlap_ratio(ls, le, F.col("_rs"), F.col("_re"))
    best = (pairs.filter(ratio > min_overlap).groupBy(*lk)
                 .agg(F.min(F.struct(*ro, *rk)).alias("_best"))
                 .select(*lk, *[F.col("_best")[k].alias(k) for k in rk]))
    found = left.join(best, reduce(lambda a, b: a & b, [v.eqNullSafe(F.col(k)) for k, v in lk.items()]), "left")
    payload = right.select(*[F.col(c).alias(right_prefix + c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(f"_r{i}") == F.col(right_prefix + c) for i, c in enumerate(right_key)])
    out = found.join(payload, same, "left")
    return out.select(*[F.col(c) for c in left.columns],
                      *[F.col(right_prefix + c) for c in right.columns if c != session])


def exact_pair(left: DataFrame, right: DataFrame, session: str = "session_id", offset: str = "offset",
               duration: str = "duration", right_prefix: str = "p_") -> DataFrame:
    """Left join on the formatted pair key; duplicate right keys keep
    the last one in file order."""
    rk = right.withColumn("_pk", pair_key(F.col(session), F.col(offset), F.col(duration)))
    rk = dedup_last(rk, "_pk")
    rk = rk.select("_pk", *[F.col(c).alias(right_prefix + c) for c in right.columns])
    lk = left.withColumn("_pk", pair_key(F.col(session), F.col(offset), F.col(duration)))
    return lk.join(rk, "_pk", "left").drop("_pk")


def metadata_lookup(df: DataFrame, meta: DataFrame, keys: Sequence[str], value: str, out: str,
                    default: Column | None = None, order: Sequence[Column | str] | None = None) -> DataFrame:
    """``(keys) -> value`` lookup with a default (the id itself).  Of several
    rows with one key the last by ``order`` counts (by the value where no order is
    given), as when a table is read into a map row by row."""
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in (order or ())], F.col(value))
    m = meta.groupBy(*keys).agg(F.max_by(F.col(value), by).alias("_mv"))
    res = df.join(m, list(keys), "left")
    return res.withColumn(out, F.coalesce(F.col("_mv"), default if default is not None else F.lit(None))) \
              .drop("_mv")


def left_metadata(df: DataFrame, meta: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Metadata subset made distinct, then left-joined (non-unique
    keys multiply rows, as a relational join does)."""
    m = meta.select(*on, *[c for c in columns if c not in on]).distinct()
    return df.join(m, list(on), "left")


def alignment_merge(df: DataFrame, results: DataFrame, key: str = "audio_filepath",
                    alignment: str = "alignment") -> DataFrame:
    """Attach alignments by path; missing -> empty alignment and
    duration 0; duration = last end - first start rounded to 3 places."""
    r = results.select(key, F.col(alignment).alias("_al"))
    out = df.join(r, key, "left")
    al = F.coalesce(F.col("_al"), F.array().cast(results.schema[alignment].dataType))
    dur = F.when(F.size(al) > 0, F.bround(F.element_at(al, -1)["end"] - F.element_at(al, 1)["start"], 3)) \
        .otherwise(F.lit(0.0))
    return out.withColumn(alignment, al).withColumn("alignment_duration", dur).drop("_al")


def upsert_predictions(base: DataFrame, preds: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
                       order: str = SEQ, only_wav: bool = True, path_key: str = "audio_filepath") -> DataFrame:
    """Replace the manifest's values by the latest prediction with the
    same key; rows without one keep theirs."""
    p = preds
    if only_wav:
        p = p.filter(F.col(path_key).endswith(".wav"))
    packed = F.struct(F.col(order).alias("_o"), *[F.col(v).alias(v) for v in value_cols])
    last = p.groupBy(*keys).agg(F.max(packed).alias("_p"))
    out = base.join(last, list(keys), "left")
    for v in value_cols:
        out = out.withColumn(v, F.when(F.col("_p").isNotNull(), F.col("_p")[v]).otherwise(F.col(v)))
    out = out.drop("_p")
    return out.filter(F.col(path_key).endswith(".wav")) if only_wav else out


def split_reuse(df: DataFrame, cache: DataFrame, key_cols: Sequence[str], result_cols: Sequence[str],
                ok_col: str = "ok", order: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has a successful cached result (reused, result
    columns taken from the cache) and rows still to be scored.  Of several cached
    results the last by ``order`` counts (by the results where no order is given)."""
    packed = F.struct(*[F.col(c).alias(c) for c in result_cols])
    by = F.struct(*[F.col(o) for o in (order or ())], *[F.col(c) for c in result_cols])
    good = (cache.filter(F.col(ok_col)).groupBy(*key_cols).agg(F.max_by(packed, by).alias("_p"))
                 .select(*key_cols, *[F.col("_p")[c].alias(c) for c in result_cols]))
    reused = df.drop(*[c for c in result_cols if c in df.columns]).join(good, list(key_cols), "inner")
    todo = df.join(good.select(*key_cols), list(key_cols), "left_anti")
    return reused, todo


def turn_overlaps(turn_start: Column, turn_end: Column, overlaps: Column, parity: bool = False) -> Column:
    """Does the turn overlap any interval of ``overlaps``
    (``array<struct<start,end>>``)?  ``parity=True`` reproduces the rule's
    check, which misses an interval that covers the whole turn."""
    if parity:
        def hit(o):
            s_in = (o["start"] >= turn_start) & (o["start"] <= turn_end)
            e_in = (o["end"] >= turn_start) & (o["end"] <= turn_end)
            return s_in | e_in
    else:
        def hit(o):
            return (o["start"] < turn_end) & (o["end"] > turn_start)
    return F.exists(overlaps, hit)


#: Rows of a character-set table up to which it is broadcast; beyond it the join shuffles.
SMALL_CHARSETS = 10_000


def language_charsets(df: DataFrame, charsets: DataFrame, lang_col: str = "lang") -> DataFrame:
    """Language -> character set.  The table is broadcast when it has one row
    for each of a bounded number of languages; a language without a set fails the
    job, as in the rule."""
    small = charsets.limit(SMALL_CHARSETS + 1).count() <= SMALL_CHARSETS
    j = df.join(F.broadcast(charsets) if small else charsets, lang_col, "left")
    return j.withColumn("charset", F.when(F.col("charset").isNull(),
                                          F.raise_error(F.concat(F.lit("no character set for language "),
                                                                 F.col(lang_col))))
                        .otherwise(F.col("charset")))


def rejoin_split_parts(parents: DataFrame, parts: DataFrame, key: str = "audio_filepath",
                       split_paths: str = "split_filepaths", split_offsets: str = "split_offsets") -> DataFrame:
    """A parent row listing ``split_filepaths`` gathers its parts by
    path, shifts their word times by the part offset and concatenates text
    and alignment in part order."""
    pos = parents.select(key, F.posexplode(F.arrays_zip(F.col(split_paths).alias("p"),
                                                         F.col(split_offsets).alias("o"))).alias("_i", "_z"))
    pos = pos.select(key, "_i", F.col("_z.p").alias("_part"), F.col("_z.o").alias("_off"))
    pr = parts.select(F.col(key).alias("_part"), F.col("text").alias("_t"), F.col("alignment").alias("_al"))
    j = pos.join(pr, "_part", "inner")
    shifted = F.transform("_al", lambda w: w.withField("start", F.bround(w["start"] + F.col("_off"), 3))
                          .withField("end", F.bround(w["end"] + F.col("_off"), 3)))
    per = j.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_i", F.col("_t"), shifted.alias("_al"))))
                             .alias("_parts"))
    merged = per.select(key,
                        F.array_join(F.transform("_parts", lambda x: x["_t"]), " ").alias("text"),
                        F.flatten(F.transform("_parts", lambda x: x["_al"])).alias("alignment"))
    base = parents.drop("text", "alignment")
    return base.join(merged, key, "left")

"""Aggregations (A1-A19).  All are ``groupBy``/``agg`` plans with map-side
partial aggregation; none collects a group into one task."""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators.scan import with_global_index
from corpusflow.sources.manifest import SEQ


def manifest_totals(df: DataFrame, duration_key: str = "duration") -> DataFrame:
    """A1: rows and total hours."""
    return df.agg(F.count("*").alias("num_entries"),
                  (F.coalesce(F.sum(F.col(duration_key)), F.lit(0.0)) / 3600.0).alias("total_hours"))


def observe_totals(df: DataFrame, name: str = "totals", duration_key: str = "duration"):
    """A1 without an extra job: counters filled in when ``df`` is written."""
    from pyspark.sql import Observation
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("num_entries"),
                     F.coalesce(F.sum(F.col(duration_key)), F.lit(0.0)).alias("total_duration"))
    return out, obs


def merge_counters(df: DataFrame, counter_col: str, key: str = "key", value: str = "count") -> DataFrame:
    """A2: sum of per-row ``map<string, long>`` counters."""
    return (df.select(F.explode(counter_col).alias(key, "_v"))
              .groupBy(key).agg(F.sum("_v").alias(value)))


def manifest_stats(df: DataFrame, channel: str = "audio_type") -> DataFrame:
    """A4: distinct devices, sessions, dates and files per channel."""
    return df.groupBy(channel).agg(
        F.countDistinct("device_id").alias("devices"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("date").alias("dates"),
        F.count("*").alias("files"))


def score_histogram(df: DataFrame, score: str, bins: int = 10) -> DataFrame:
    """A5: ten equal bins over [0, 1], last bin closed; scores outside are
    ignored."""
    s = F.col(score)
    b = F.least(F.floor(s * bins), F.lit(bins - 1)).cast("int")
    return (df.filter((s >= 0) & (s <= 1)).groupBy(b.alias("bin")).agg(F.count("*").alias("n")))


# --- A6 bootstrap ------------------------------------------------------------
# Every (row, replicate) pair gets a Poisson(ratio) weight derived from a
# seeded hash of the row key and the replicate number, so the resamples do
# not depend on partitioning.  Each task sums weights and weighted metrics
# into B-long arrays; only those arrays (one row per task) are shuffled.

_M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (public domain constants), vectorised."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)) & _M64
        x = ((x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)) & _M64
        x = ((x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)) & _M64
        return x ^ (x >> np.uint64(31))


def poisson_weights(row_hash: np.ndarray, replicates: int, ratio: float) -> np.ndarray:
    """(rows x replicates) Poisson(ratio) counts from row hashes."""
    h = row_hash.astype(np.int64).view(np.uint64)[:, None]
    b = np.arange(replicates, dtype=np.uint64)[None, :]
    with np.errstate(over="ignore"):
        u = _mix64(h ^ (b * np.uint64(0xD1B54A32D192ED03)))
    uni = (u >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    kmax = int(ratio * 10 + 20)
    pmf = np.empty(kmax + 1)
    pmf[0] = np.exp(-ratio)
    for k in range(1, kmax + 1):
        pmf[k] = pmf[k - 1] * ratio / k
    cdf = np.cumsum(pmf)
    return np.searchsorted(cdf, uni, side="right").astype(np.float64)


def bootstrap_ci(df: DataFrame, metric_cols: Sequence[str], key: str = SEQ, num_bootstraps: int = 1000,
                 bootstrap_sample_ratio: float = 1.0, seed: int = 42, ci_lower: float = 2.5,
                 ci_upper: float = 97.5, pairwise: bool = True) -> DataFrame:
    """Bootstrap confidence interval of the mean of each per-row metric
    column (one column per system, rows already aligned by key), and for
    each pair of systems the replicate differences' interval and the
    probability of improvement P(delta > 0)."""
    B = num_bootstraps
    k = len(metric_cols)
    src = df.select(F.xxhash64(F.lit(seed), F.col(key)).alias("_h"),
                    *[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(metric_cols)])
    out_schema = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("w", T.DoubleType()),
                               *[T.StructField(f"s{i}", T.DoubleType()) for i in range(k)]])

    def partial(it):
        w_sum = np.zeros(B)
        s_sum = np.zeros((k, B))
        for pdf in it:
            if len(pdf) == 0:
                continue
            w = poisson_weights(pdf["_h"].to_numpy(), B, bootstrap_sample_ratio)
            w_sum += w.sum(axis=0)
            for i in range(k):
                s_sum[i] += pdf[f"_m{i}"].to_numpy() @ w
        yield pd.DataFrame({"b": np.arange(B), "w": w_sum} | {f"s{i}": s_sum[i] for i in range(k)})

    # one row for each task and replicate, added up in the shuffle
    total = src.mapInPandas(partial, out_schema).groupBy("b").agg(F.sum("w").alias("w"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(k)])
    reps = total.select("b", *[(F.col(f"s{i}") / F.col("w")).alias(f"mean{i}") for i in range(k)])
    return _intervals(reps, metric_cols, ci_lower, ci_upper, pairwise)


def _intervals(reps: DataFrame, metric_cols: Sequence[str], ci_lower: float, ci_upper: float, pairwise: bool) -> DataFrame:
    """Mean and percentiles over the replicates (``b``, ``mean0``, ...) of each system and each pair."""
    k = len(metric_cols)
    one = [F.struct(F.lit(metric_cols[i]).alias("system"), F.lit(None).cast("string").alias("versus"), F.col(f"mean{i}").alias("v")) for i in range(k)]
    two = [F.struct(F.lit(metric_cols[i]).alias("system"), F.lit(metric_cols[j]).alias("versus"), (F.col(f"mean{i}") - F.col(f"mean{j}")).alias("v"))
           for i in range(k) for j in range(i + 1, k)]
    return reps.select(F.inline(F.array(*one, *(two if pairwise else [])))).groupBy("system", "versus").agg(
        F.avg("v").alias("mean"),
        F.percentile("v", ci_lower / 100.0).alias("ci_lower"),
        F.percentile("v", ci_upper / 100.0).alias("ci_upper"),
        F.avg((F.col("v") > 0).cast("double")).alias("poi"))


def bootstrap_exact(df: DataFrame, metric_cols: Sequence[str], order: Sequence[str], num_bootstraps: int = 1000,
                    bootstrap_sample_ratio: float = 1.0, seed: int = 42, ci_lower: float = 2.5, ci_upper: float = 97.5,
                    pairwise: bool = True, indices: DataFrame | None = None) -> DataFrame:
    """A6 with resamples of exactly ``int(n * ratio)`` rows, drawn with replacement:
    :func:`bootstrap_ci` by index join.  Rows are numbered in ``order`` (a total one);
    draw ``k`` of replicate ``b`` is row ``hash(seed, b, k) mod n``, or, with
    ``indices`` (``b``, ``i``, from 0), what that says.  Work is replicates times rows."""
    rows = with_global_index(df.select(*order, *[F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(metric_cols)]), list(order), "i")
    rows = rows.select("i", *[f"m{i}" for i in range(len(metric_cols))])
    if indices is None:
        n = rows.count()
        size = int(n * bootstrap_sample_ratio)
        draw = df.sparkSession.range(num_bootstraps * size)
        b = F.floor(F.col("id") / F.lit(max(size, 1)))
        indices = draw.select(b.alias("b"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(n, 1))).alias("i"))
    drawn = indices.groupBy("b", "i").agg(F.count(F.lit(1)).alias("times"))
    total = drawn.join(rows, "i").groupBy("b").agg(F.sum("times").alias("w"), *[F.sum(F.col("times") * F.col(f"m{i}")).alias(f"s{i}") for i in range(len(metric_cols))])
    reps = total.select("b", *[(F.col(f"s{i}") / F.col("w")).alias(f"mean{i}") for i in range(len(metric_cols))])
    return _intervals(reps, metric_cols, ci_lower, ci_upper, pairwise)


def session_totals(df: DataFrame, session: str = "session_id", duration_key: str = "duration",
                   min_duration: float | None = None, max_duration: float | None = None) -> DataFrame:
    """Per session, total duration and segment count after the
    duration filter."""
    d = F.col(duration_key)
    if min_duration is not None:
        df = df.filter(d >= min_duration)
    if max_duration is not None:
        df = df.filter(d <= max_duration)
    return df.groupBy(session).agg(F.sum(d).alias("session_duration"), F.count("*").alias("segments"))


def accepted_assignments(df: DataFrame, threshold: float = 75.0, min_rows: int = 3,
                         status_col: str = "status", wer_col: str = "wer",
                         assignment: str = "assignment_id") -> DataFrame:
    """Submitted rows with ``wer < t``; assignments with >= 3 of them."""
    ok = df.filter((F.col(status_col) == "SUBMITTED") & (F.col(wer_col) < threshold))
    return ok.groupBy(assignment).agg(F.count("*").alias("n_ok")).filter(F.col("n_ok") >= min_rows)


def banned_assignments(df: DataFrame, banned: DataFrame, user_col: str = "user_id",
                       status_col: str = "status", assignment: str = "assignment_id") -> DataFrame:
    """Distinct submitted assignments of banned users."""
    sub = df.filter(F.col(status_col) == "SUBMITTED")
    return sub.join(banned.select(user_col).distinct(), user_col, "left_semi").select(assignment).distinct()


def shard_stats(df: DataFrame, shard_col: str = "shard_id", duration_key: str = "duration",
                size_col: str | None = None) -> DataFrame:
    """Samples, duration, max duration (and bytes) per shard."""
    aggs = [F.count("*").alias("samples"), F.sum(duration_key).alias("total_duration"),
            F.max(duration_key).alias("max_duration")]
    if size_col:
        aggs.append(F.sum(size_col).alias("total_bytes"))
    return df.groupBy(shard_col).agg(*aggs)


def restored_report(df: DataFrame, keys: Sequence[str] = ("book_id", "reader_id"),
                    restored_col: str = "restored_text", na: str = "n/a",
                    duration_key: str = "duration") -> DataFrame:
    """Restored and lost hours per group and the share restored."""
    ok = F.col(restored_col) != na
    d = F.col(duration_key)
    return df.groupBy(*keys).agg(
        (F.sum(F.when(ok, d).otherwise(0.0)) / 3600).alias("restored_hours"),
        (F.sum(F.when(~ok, d).otherwise(0.0)) / 3600).alias("lost_hours"),
        (F.avg(ok.cast("double")) * 100).alias("restored_pct"))


def decision_stats(df: DataFrame, decision: str) -> DataFrame:
    """A13 / A14 counts: rows per decision and their share."""
    tot = df.count()
    return df.groupBy(decision).agg(F.count("*").alias("n"),
                                    (F.count("*") / F.lit(max(tot, 1))).alias("rate"))


def top_counts(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k most frequent values (ties by value)."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(key)).limit(k)


def extension_counts(df: DataFrame, path_key: str = "audio_filepath") -> DataFrame:
    """Files per extension."""
    ext = F.regexp_extract(F.col(path_key), r"\.([^./]+)$", 1)
    return df.groupBy(ext.alias("extension")).agg(F.count("*").alias("files"))


def dynamic_bucket_bins(df: DataFrame, num_buckets: int = 30, duration_key: str = "duration") -> DataFrame:
    """Bin edges with equal total duration: for k = 1..n-1 the first
    duration (ascending) at which the running total reaches k/n of the sum.
    The running total is the distributed prefix sum."""
    from corpusflow.operators.scan import with_prefix_sum
    total = df.agg(F.sum(duration_key)).first()[0] or 0.0
    d = df.select(F.col(duration_key).alias("d"), F.monotonically_increasing_id().alias("_u"))
    cum = with_prefix_sum(d, [F.col("d"), F.col("_u")], "d", "_cum")
    ks = F.floor(F.col("_cum") * num_buckets / F.lit(total))
    prev = F.floor((F.col("_cum") - F.col("d")) * num_buckets / F.lit(total))
    crossed = cum.filter(ks > prev).select("d", F.explode(F.sequence(prev + 1, ks)).alias("k"))
    return crossed.filter((F.col("k") >= 1) & (F.col("k") < num_buckets)) \
                  .groupBy("k").agg(F.min("d").alias("edge"))


def count_rows(spark, path_glob: str) -> int:
    """Rows of a manifest or of all its shard manifests."""
    return spark.read.text(path_glob).count()

"""Row filters (F1-F24).  Thresholds keep the boundary: a row is dropped only
when strictly above the high or below the low threshold.

Each filter is lazy; the drop counters of the rules are separate aggregate
frames (``*_counts``) or ``observe`` metrics, so no filter forces an action.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import metrics as M
from corpusflow.functions import text as TX
from corpusflow.functions.regex import to_java_pattern
from corpusflow.sources.manifest import SEQ

_OPS = {
    "lt": lambda a, b: a < b, "le": lambda a, b: a <= b, "eq": lambda a, b: a == b,
    "ne": lambda a, b: ~a.eqNullSafe(b), "ge": lambda a, b: a >= b, "gt": lambda a, b: a > b,
}


def preserve_by_value(df: DataFrame, input_value_key: str, target_value, operator: str = "eq") -> DataFrame:
    """keep rows where ``value <op> target``."""
    if operator not in _OPS:
        raise ValueError(f"operator must be one of {sorted(_OPS)}, got {operator!r}")
    return df.filter(_OPS[operator](F.col(input_value_key), F.lit(target_value)))


def _range_keep(value: Column, low, high) -> Column:
    return (value >= F.lit(low)) & (value <= F.lit(high))


def drop_high_low_charrate(df: DataFrame, high_charrate_threshold: float, low_charrate_threshold: float,
                           text_key: str = "text", duration_key: str = "duration") -> DataFrame:
    """F2."""
    return df.filter(_range_keep(M.charrate(text_key, duration_key), low_charrate_threshold,
                                 high_charrate_threshold))


def drop_high_low_wordrate(df: DataFrame, high_wordrate_threshold: float, low_wordrate_threshold: float,
                           text_key: str = "text", duration_key: str = "duration") -> DataFrame:
    """F3."""
    return df.filter(_range_keep(M.wordrate(text_key, duration_key), low_wordrate_threshold,
                                 high_wordrate_threshold))


def drop_high_low_duration(df: DataFrame, high_duration_threshold: float, low_duration_threshold: float,
                           duration_key: str = "duration") -> DataFrame:
    """F4."""
    return df.filter(_range_keep(F.col(duration_key), low_duration_threshold, high_duration_threshold))


def high_low_counts(df: DataFrame, value: Column, low, high) -> DataFrame:
    """A3: rows that a range filter drops, split by side."""
    return df.agg(F.count_if(value < F.lit(low)).alias("dropped_low"),
                  F.count_if(value > F.lit(high)).alias("dropped_high"))


def _any_match(text: Column, patterns: Sequence[str]) -> Column:
    """Does one of the patterns match?  The text is made once for all of them."""
    return F.exists(F.array(text), lambda t: reduce(lambda a, b: a | b, [t.rlike(to_java_pattern(p)) for p in patterns]))


def drop_if_none_of_regex_match(df: DataFrame, regex_patterns: Sequence[str], text_key: str = "text") -> DataFrame:
    """keep rows where one of the patterns matches the padded text;
    survivors' text is space-normalised."""
    padded = TX.add_start_end_spaces(F.col(text_key))
    return (df.filter(_any_match(padded, regex_patterns))
              .withColumn(text_key, TX.remove_extra_spaces(F.col(text_key))))


def drop_if_regex_match(df: DataFrame, regex_patterns: Sequence[str], text_key: str = "text") -> DataFrame:
    """drop rows where any pattern matches the padded text; survivors'
    text is space-normalised."""
    padded = TX.add_start_end_spaces(F.col(text_key))
    return (df.filter(~_any_match(padded, regex_patterns))
              .withColumn(text_key, TX.remove_extra_spaces(F.col(text_key))))


def regex_match_counts(df: DataFrame, regex_patterns: Sequence[str], text_key: str = "text") -> DataFrame:
    """F12 counter (A2): per pattern, the number of matches in the rows it
    dropped; a row counts only for the first pattern that matches it."""
    def found(padded: Column) -> Column:
        hit = F.lit(None).cast("struct<i:int,n:long>")
        for i in reversed(range(len(regex_patterns))):
            p = to_java_pattern(regex_patterns[i])
            hit = F.when(padded.rlike(p), F.struct(F.lit(i).alias("i"), F.regexp_count(padded, F.lit(p)).cast("long").alias("n"))).otherwise(hit)
        return hit

    pats = F.array(*[F.lit(p) for p in regex_patterns])
    hits = F.filter(F.transform(F.array(TX.add_start_end_spaces(F.col(text_key))), found), lambda h: h.isNotNull())
    return (df.select(F.inline_outer(hits).alias("_i", "_n"))
              .filter(F.col("_i").isNotNull())
              .groupBy("_i").agg(F.sum("_n").alias("matches"))
              .select(F.element_at(pats, F.col("_i") + 1).alias("pattern"), "matches"))


def drop_non_alphabet(df: DataFrame, alphabet: str, text_key: str = "text") -> DataFrame:
    """drop rows with a character outside ``alphabet`` (empty text kept)."""
    return df.filter(F.length(F.translate(F.col(text_key), alphabet, "")) == 0)


def non_alphabet_counts(df: DataFrame, alphabet: str, text_key: str = "text") -> DataFrame:
    """F6 counter (A2): offending characters summed over dropped rows, most
    frequent first."""
    chars = F.split(F.translate(F.col(text_key), alphabet, ""), "")
    return (df.select(F.explode(F.filter(chars, lambda c: c != F.lit(""))).alias("character"))
              .groupBy("character").agg(F.count("*").alias("n")))


def _metric_filter(df: DataFrame, metric: Column, keep, out_col: str | None) -> DataFrame:
    # the metric is materialised once as a column, then filtered on
    col = out_col or "_metric"
    res = df.withColumn(col, metric).filter(keep(F.col(col)))
    return res if out_col else res.drop(col)


def drop_high_cer(df: DataFrame, cer_threshold: float, text_key: str = "text",
                  pred_text_key: str = "pred_text", out_col: str | None = None, on_zero: str = "fail") -> DataFrame:
    """F9 (``out_col`` keeps the computed CER).  With ``on_zero="null"`` a row without a
    reference has no rate and is dropped."""
    return _metric_filter(df, M.cer(text_key, pred_text_key, on_zero), lambda c: c <= cer_threshold, out_col)


def drop_high_wer(df: DataFrame, wer_threshold: float, text_key: str = "text",
                  pred_text_key: str = "pred_text", out_col: str | None = None) -> DataFrame:
    """F10."""
    return _metric_filter(df, M.wer(text_key, pred_text_key), lambda c: c <= wer_threshold, out_col)


def drop_low_word_match_rate(df: DataFrame, wmr_threshold: float, text_key: str = "text",
                             pred_text_key: str = "pred_text", out_col: str | None = None, on_zero: str = "fail") -> DataFrame:
    """F11 (``on_zero`` as in F9)."""
    return _metric_filter(df, M.wmr(text_key, pred_text_key, on_zero), lambda c: c >= wmr_threshold, out_col)


def drop_on_attribute(df: DataFrame, key: str, drop_if_false: bool = False) -> DataFrame:
    """keep rows whose flag is exactly ``drop_if_false``; NULL dropped."""
    return df.filter(F.col(key).eqNullSafe(F.lit(drop_if_false)))


def drop_repeated_fields(df: DataFrame, others: Sequence[DataFrame], text_key: str = "text",
                         punctuations: str | None = None, other_text_key: str | None = None) -> DataFrame:
    """Anti-join on the (optionally punctuation-free) text seen in
    other manifests."""
    other_text_key = other_text_key or text_key

    def norm(c: Column) -> Column:
        return F.translate(c, punctuations, "") if punctuations else c

    seen = reduce(lambda a, b: a.unionByName(b),
                  [o.select(norm(F.col(other_text_key)).alias("_k")) for o in others]).distinct()
    return (df.withColumn("_k", norm(F.col(text_key)))
              .join(seen, "_k", "left_anti").drop("_k"))


def remove_failed_chapters(df: DataFrame, failed: DataFrame, key: str = "audio_filepath",
                           utterances: str = "utterances") -> DataFrame:
    """F16: drop utterances whose path is listed under a failed chapter."""
    bad = failed.select(F.explode(utterances).alias("_u")).select(F.col("_u")[key].alias(key))
    return df.join(bad, key, "left_anti")


def drop_duplicates(df: DataFrame, drop_key: str = "text", order_col: str = SEQ) -> DataFrame:
    """One row per key, the first in file order; NULL is one key.

    Written as ``min_by(row, order)`` per key rather than a window: the
    aggregate is partial on the map side, so a key that holds a third of all
    rows is reduced to one candidate per task before the shuffle.
    """
    # min_by compares the order only, so columns of any type (maps too) may ride along
    row = F.struct(*[F.col(c) for c in df.columns if c != drop_key])
    first = df.groupBy(drop_key).agg(F.min_by(row, F.col(order_col)).alias("_r"))
    return first.select(*[F.col("_r")[c].alias(c) if c != drop_key else F.col(c) for c in df.columns])


def split_membership(df: DataFrame, split_table: DataFrame, key_expr: Column, split_key: str = "file_prefix",
                     data_split: str | None = None, split_col: str = "split") -> DataFrame:
    """keep rows whose key belongs to ``data_split`` in a user split
    table (semi join)."""
    st = split_table if data_split is None else split_table.filter(F.col(split_col) == data_split)
    return df.withColumn("_k", key_expr).join(st.select(F.col(split_key).alias("_k")).distinct(),
                                              "_k", "left_semi").drop("_k")


def duration_window(df: DataFrame, min_duration: float, max_duration: float,
                    duration_key: str = "duration") -> DataFrame:
    """``min <= d < max`` (upper bound strict)."""
    d = F.col(duration_key)
    return df.filter((d >= min_duration) & (d < max_duration))


def duration_window_dropped(df: DataFrame, min_duration: float, max_duration: float,
                            duration_key: str = "duration") -> DataFrame:
    d = F.col(duration_key)
    out = ~((d >= min_duration) & (d < max_duration))
    return df.agg(F.count_if(out).alias("dropped"),
                  F.coalesce(F.sum(F.when(out, d)), F.lit(0.0)).alias("dropped_duration"))


def split_readable(df: DataFrame, ok_col: str = "duration") -> tuple[DataFrame, DataFrame]:
    """F20 re-aimed: rows whose media probe succeeded, and the quarantine
    list (probe value -1.0).  Files are not moved."""
    bad = F.col(ok_col) < 0
    return df.filter(~bad), df.filter(bad)


PAUSE_PATTERN = r"\(pause \d+(\.\d+)?\)"


def drop_pauses(df: DataFrame, text_key: str = "text") -> DataFrame:
    """F21."""
    return df.filter(~F.col(text_key).rlike(PAUSE_PATTERN))


def length_ratio_gate(df: DataFrame, a: str, b: str, max_ratio: float) -> DataFrame:
    """both sides longer than one word and ``max(a/b, b/a) < r``."""
    na, nb = F.col(a).cast("double"), F.col(b).cast("double")
    return df.filter((na > 1) & (nb > 1) & (F.greatest(na / nb, nb / na) < max_ratio))


def probability_gate(df: DataFrame, prob_key: str, threshold: float) -> DataFrame:
    """F23."""
    return df.filter(F.col(prob_key) >= threshold)


HALL_FLAGS = ("hall_repeated_ngrams", "hall_long_word", "hall_frequent_single_word")


def hallucination_gate(df: DataFrame, flags: Sequence[str] = HALL_FLAGS) -> DataFrame:
    """none of the flags set."""
    return df.filter(~reduce(lambda a, b: a | b, [F.col(f) for f in flags]))


def hallucination_features(df: DataFrame, phrases: DataFrame, text_field: str = "text",
                           phrase_col: str = "phrase", **thresholds) -> DataFrame:
    """Three flag columns.  The phrase list is a table; the third flag
    is a left join against its distinct phrases (build side small, so AQE
    broadcasts it; no size is assumed here)."""
    flags = TX.hallucination_flags(F.col(text_field), **thresholds)
    keyed = df.withColumns(flags).withColumn("_hk", TX.hallucination_clean(F.col(text_field)))
    ph = phrases.select(F.col(phrase_col).alias("_hk")).distinct().withColumn("_hit", F.lit(True))
    return (keyed.join(ph, "_hk", "left")
                 .withColumn("hall_frequent_single_word", F.coalesce(F.col("_hit"), F.lit(False)))
                 .drop("_hk", "_hit"))

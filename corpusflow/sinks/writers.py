"""Manifest sinks (K1, K2, K7, K8)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusflow.sources.manifest import SEQ


def write_manifest(df: DataFrame, path: str, duration_key: str = "duration", mode: str = "overwrite") -> dict:
    """K1 / A1: JSON lines (NULL fields omitted), rows in file order inside
    each output file; returns the entry count and total hours, gathered by
    ``observe`` during the write (no second job)."""
    obs = Observation("manifest")
    d = F.col(duration_key) if duration_key in df.columns else F.lit(0.0)
    out = df.observe(obs, F.count(F.lit(1)).alias("num_entries"),
                     F.coalesce(F.sum(d), F.lit(0.0)).alias("total_duration"))
    if SEQ in df.columns:
        out = out.sortWithinPartitions(SEQ).drop(SEQ)
    out.write.mode(mode).option("ignoreNullFields", "true").json(path)
    m = obs.get
    return {"num_entries": m["num_entries"], "total_hours": m["total_duration"] / 3600.0}


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2."""
    df.drop(SEQ).write.mode(mode).option("sep", "\t").option("header", "true").csv(path)


def write_structured(df: DataFrame, path: str, keys: Sequence[str] = ("device_id", "session_id"),
                     mode: str = "overwrite") -> None:
    """K7: one folder per device/session; ``segment_index`` numbers the
    segments of a session from 0 in file order."""
    from corpusflow.operators.scan import ordered_blocks, blocked_cumsum, PID, POS
    b = ordered_blocks(df, [*keys, SEQ] if SEQ in df.columns else list(keys))
    idx = blocked_cumsum(b, F.lit(1), "segment_index", list(keys), inclusive=False).drop(PID, POS)
    idx.drop(SEQ).write.mode(mode).partitionBy(*keys).json(path)


def json_payload(df: DataFrame, text_key: str = "text", aliases: dict | None = None) -> DataFrame:
    """K8: per-sample JSON document: every field, ``text`` duplicated as
    ``transcription``, optional key aliases; NULL fields omitted."""
    cols = [F.col(c) for c in df.columns if c != SEQ]
    if text_key in df.columns:
        cols.append(F.col(text_key).alias("transcription"))
    for src, tgt in (aliases or {}).items():
        cols.append(F.col(src).alias(tgt))
    return df.withColumn("json", F.to_json(F.struct(*cols), {"ignoreNullFields": "true"}))

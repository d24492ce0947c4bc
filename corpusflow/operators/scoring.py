"""Model scoring hosted as Spark jobs.

``score_batches`` runs a user-supplied model over Arrow batches; the model is
built once per Python worker.  ``train_trigram_lid`` / ``score_trigram_lid``
are a small text language identifier written as joins and aggregations of the
trigrams that a helper counts in each text (used for tests and as a stand-in model).
"""

from __future__ import annotations

import logging
import uuid
from typing import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusflow.session import cut_lineage

PIECE = 1 << 18             # characters of a text, or counted trigrams, worked on at once
BROADCAST_ROWS = 2_000_000  # of a profile that every executor gets; results do not depend on it

_MODELS: dict = {}


def score_batches(df: DataFrame, make_model: Callable, in_cols: Sequence[str], out_schema: T.StructType,
                  batch_size: int = 64, sort_by: str | None = None, on_error: str = "null") -> DataFrame:
    """``make_model()`` returns a callable mapping a pandas frame of
    ``in_cols`` to a pandas frame of ``out_schema`` columns.  When a batch fails
    its error is logged and its rows are kept with null scores
    (``on_error='null'``) or dropped (``'drop'``); ``'raise'`` fails the job.  The last
    partial batch is scored too."""
    src = df.sortWithinPartitions(sort_by) if sort_by else df
    out_fields = [f.name for f in out_schema.fields]
    schema = T.StructType(list(df.schema.fields) + list(out_schema.fields))
    key = uuid.uuid4().hex            # one model for each call and worker

    def run(it):
        model = _MODELS.get(key)
        if model is None:
            model = _MODELS[key] = make_model()
        for pdf in it:
            for i in range(0, len(pdf), batch_size):
                chunk = pdf.iloc[i:i + batch_size].reset_index(drop=True)
                try:
                    res = model(chunk[list(in_cols)]).reset_index(drop=True)
                except Exception:  # noqa: BLE001 - a failed batch is a scoring result
                    if on_error == "raise":
                        raise
                    logging.getLogger(__name__).exception("a batch of %d rows could not be scored", len(chunk))
                    if on_error == "drop":
                        continue
                    res = pd.DataFrame({c: [None] * len(chunk) for c in out_fields})
                yield pd.concat([chunk, res[out_fields]], axis=1)

    return src.mapInPandas(run, schema)


def pred_text_from_segments(segments: Column) -> Column:
    """Prediction text = segment texts joined by a space, trimmed."""
    return F.trim(F.array_join(F.transform(segments, lambda s: s["text"]), " "))


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a padded text, three code points of 21 bits in a long, and how
    often each occurs; a long text is worked on in pieces."""
    found = []
    for i in range(0, len(text) - 2, PIECE):
        c = np.frombuffer(text[i:i + PIECE + 2].encode("utf-32-le"), "<u4").astype(np.int64)
        found.append(np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:], return_counts=True))
        if len(found) == 16:
            found = [_added(found)]
    return _added(found)


def _added(counts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(counts) == 1:
        return counts[0]
    tri, at = np.unique(np.concatenate([t for t, _ in counts]), return_inverse=True)
    n = np.zeros(len(tri), np.int64)
    np.add.at(n, at, np.concatenate([c for _, c in counts]))
    return tri, n


def _padded(text: str) -> Column:
    return F.concat(F.lit("  "), F.lower(F.col(text)), F.lit("  "))


def _count_by_label(df: DataFrame, text: str, label: str) -> DataFrame:
    """Rows (label, ``tri``, ``n``): the trigrams of the texts with a label, counted for each
    batch, so that what is shuffled grows with the distinct ones.  A null text counts as one
    null trigram."""
    def run(batches):
        for batch in batches:
            found, held, nulls = {}, {}, {}
            for who, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t is None:
                    nulls[who] = nulls.get(who, 0) + 1
                    continue
                found.setdefault(who, []).append(_trigrams(t))
                held[who] = held.get(who, 0) + len(found[who][-1][0])
                if held[who] > PIECE:
                    found[who], held[who] = [_added(found[who])], 0
            for who, counts in found.items():
                tri, n = _added(counts)
                yield _batch([pa.array([who], kind).take(pa.array(np.zeros(len(tri), np.int64))), pa.array(tri), pa.array(n)], names)
            for who, n in nulls.items():
                yield _batch([pa.array([who], kind), pa.array([None], pa.int64()), pa.array([n], pa.int64())], names)

    rows = df.select(F.col(label), _padded(text).alias("_text"))
    schema = T.StructType([rows.schema[label], T.StructField("tri", T.LongType()), T.StructField("n", T.LongType())])
    kind, names = to_arrow_type(rows.schema[label].dataType), [label, "tri", "n"]
    return rows.mapInArrow(run, schema).groupBy(label, "tri").agg(F.sum("n").alias("n"))


def _count_by_row(df: DataFrame, text: str, key: str) -> DataFrame:
    """Rows (key, ``tri``, ``c``, ``sq``): the trigrams of each row with their counts and, without a
    trigram, the sum of the squares of these counts (a null text: one null trigram)."""
    def run(batches):
        for batch in batches:
            at, tris, counts, squares = [], [], [], np.ones(batch.num_rows, np.int64)

            def rows():
                each = pa.array(np.repeat(np.array([i for i, _ in at], np.int64), np.array([n for _, n in at], np.int64)))
                tri, c = np.concatenate([e, *tris]), np.concatenate([e, *counts])
                return _batch([batch.column(0).take(each), pa.array(tri), pa.array(c), pa.nulls(len(tri), pa.int64())], names)

            e, held = np.zeros(0, np.int64), 0
            for i, t in enumerate(batch.column(1).to_pylist()):
                if t is None:
                    continue
                tri, c = _trigrams(t)
                squares[i] = np.dot(c, c)
                at.append((i, len(tri)))
                tris.append(tri)
                counts.append(c)
                held += len(tri)
                if held > PIECE:
                    yield rows()
                    at, tris, counts, held = [], [], [], 0
            yield rows()
            yield _batch([batch.column(0), *[pa.nulls(batch.num_rows, pa.int64())] * 2, pa.array(squares)], names)

    rows_in = df.select(F.col(key), _padded(text).alias("_text"))
    names = [key, "tri", "c", "sq"]
    schema = T.StructType([rows_in.schema[key], *[T.StructField(x, T.LongType()) for x in names[1:]]])
    return rows_in.mapInArrow(run, schema)


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=names)


def train_trigram_lid(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per-language trigram profile (relative frequency, L2-normalised): ``lang``, ``tri``
    (the trigram's three code points, 21 bits each) and ``w``."""
    counts = _count_by_label(labelled, text, lang)
    norms = counts.groupBy(lang).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return counts.join(norms, lang).select(lang, "tri", (F.col("n") / F.col("norm")).alias("w"))


def score_trigram_lid(df: DataFrame, profile: DataFrame, key: str, text: str = "text",
                      lang: str = "lang", out: str = "label") -> DataFrame:
    """Cosine of each text's trigram counts with every profile; writes
    ``label`` and ``label_prob`` (the best cosine).  Rows with one key count as one text,
    rows without a key get no label.

    A product is a sum over trigrams and rows, so the counts of a row meet the profile
    where they are made, as long as it has at most ``BROADCAST_ROWS`` rows (it is counted
    before; a larger one is joined by shuffle).  The length of a vector is its rows' own
    unless keys repeat; the trigrams of such keys are added up first."""
    profile = cut_lineage(profile)
    keyed = df.filter(F.col(key).isNotNull())
    weights = profile.filter("tri IS NOT NULL").select(lang, "tri", "w")
    if weights.count() <= BROADCAST_ROWS:
        weights = F.broadcast(weights)
    met = _count_by_row(keyed, text, key).join(weights, "tri", "left").filter("w IS NOT NULL OR sq IS NOT NULL")
    found = (met.groupBy(key, lang).agg(F.sum(F.col("c") * F.col("w")).alias("dot"), F.sum("sq").alias("sq"))
                .groupBy(key).agg(F.sum("sq").alias("sq"), F.collect_list(F.when(F.col("dot").isNotNull(), F.struct("dot", lang))).alias("dots")))
    often = keyed.groupBy(key).count().filter("count > 1").select(key)
    if not often.isEmpty():
        again = _count_by_row(keyed.join(often, key, "left_semi"), text, key)
        nulls = keyed.filter(F.col(text).isNull()).join(often, key, "left_semi").select(key, F.lit(None).cast("long").alias("tri"), F.lit(1).cast("long").alias("c"))
        whole = (again.filter("tri IS NOT NULL").select(key, "tri", "c").unionByName(nulls).groupBy(key, "tri").agg(F.sum("c").alias("c"))
                      .groupBy(key).agg(F.sum(F.col("c") * F.col("c")).alias("_sq")))
        found = found.join(whole, key, "left").withColumn("sq", F.coalesce("_sq", "sq")).drop("_sq")
    best = F.array_max(F.transform("dots", lambda d: F.struct((d["dot"] / F.sqrt("sq")).alias("cos"), d[lang].alias(lang))))
    best = found.select(key, best.alias("_b")).select(key, F.col("_b")[lang].alias(out), F.col("_b.cos").alias(f"{out}_prob"))
    return df.join(best, key, "left")

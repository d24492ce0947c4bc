"""Blocked Bloom filter over a distributed long column.

One 512-bit block per key, eight bits set in it, so that a probe reads one
block.  The number of bits is bounded by a parameter, whatever the number of
keys: what is broadcast has a fixed size at most, and a filter that is too small
for its keys only lets more rows through to the exact join behind it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.store import SMALL, looked_up

BITS_PER_KEY = 16
BLOCK_WORDS = 8          # 64-bit words of a block
PROBES = 8
MAX_BITS = 1 << 27       # 16 MB


def _probe(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each 64-bit hash, and its mask of BLOCK_WORDS words."""
    x = h.view(np.uint64).copy()
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    block = (x >> np.uint64(32)) % np.uint64(blocks)
    mask = np.zeros((len(x), BLOCK_WORDS), np.uint64)
    rows = np.arange(len(x))
    for _ in range(PROBES):
        x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
        bit = x >> np.uint64(55)
        mask[rows, (bit >> np.uint64(6)).astype(np.int64)] |= np.uint64(1) << (bit & np.uint64(63))
    return block.astype(np.int64), mask


def bloom_words(keys: DataFrame, key_col: str, n_keys: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """The filter of a long column: tasks build masks, masks of one block are
    or-ed in the shuffle, and ``max_bits`` bits at most reach the driver."""
    blocks = max(1, math.ceil(min(max(n_keys, 1) * BITS_PER_KEY, max_bits) / (64 * BLOCK_WORDS)))
    cols = [f"w{i}" for i in range(BLOCK_WORDS)]

    def masks(batches):
        for pdf in batches:
            block, mask = _probe(pdf["h"].to_numpy(np.int64), blocks)
            uniq, at = np.unique(block, return_inverse=True)
            merged = np.zeros((len(uniq), BLOCK_WORDS), np.uint64)
            np.bitwise_or.at(merged, at, mask)
            yield pd.DataFrame({"block": uniq} | {c: merged[:, i].view(np.int64) for i, c in enumerate(cols)})

    rows = (keys.select(F.col(key_col).alias("h")).filter("h is not null")
                .mapInPandas(masks, "block long, " + ", ".join(f"{c} long" for c in cols))
                .groupBy("block").agg(*[F.bit_or(c).alias(c) for c in cols]).toPandas())
    words = np.zeros((blocks, BLOCK_WORDS), np.uint64)
    if len(rows):
        words[rows["block"].to_numpy(np.int64)] = rows[cols].to_numpy(np.int64).view(np.uint64)
    return words


def contains(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    block, mask = _probe(np.ascontiguousarray(h).view(np.int64), len(words))
    return ((words[block] & mask) == mask).all(axis=1)


def may_contain(spark, words: np.ndarray):
    """Boolean column function: may the long be among the filter's keys?"""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        known = h.notna()
        return pd.Series(contains(h.fillna(0).to_numpy(np.int64), shared.value)) & known.to_numpy()

    return hit


def rows_with_ids(docs: DataFrame, id_col: str, ids: DataFrame, n_ids: int | None = None) -> DataFrame:
    """Rows of ``docs`` whose identifier is in the one-column frame ``ids``
    (a stored table, of ``n_ids`` rows if that is known).  Few identifiers go to the rows;
    of more, the filter keeps most other rows out of the shuffle and an exact semi join
    decides."""
    n, wanted = _counted(ids, n_ids)
    if n > SMALL:
        docs = docs.filter(may_contain(docs.sparkSession, bloom_words(wanted, "__id", n))(F.col(id_col)))
    return docs.join(looked_up(wanted, n), F.col(id_col) == F.col("__id"), "left_semi")


def rows_without_ids(docs: DataFrame, id_col: str, ids: DataFrame, n_ids: int | None = None) -> DataFrame:
    """Rows of ``docs`` whose identifier is not in ``ids`` (a null one is
    not); only possible hits are shuffled, and none if the identifiers are few."""
    n, gone = _counted(ids, n_ids)
    if n <= SMALL:
        return docs.join(looked_up(gone, n), F.col(id_col) == F.col("__id"), "left_anti")
    flagged = docs.withColumn("__may", may_contain(docs.sparkSession, bloom_words(gone, "__id", n))(F.col(id_col)))
    rest = flagged.filter(F.col("__may")).join(gone, F.col(id_col) == F.col("__id"), "left_anti")
    return flagged.filter(~F.col("__may")).unionByName(rest).drop("__may")


def _counted(ids: DataFrame, n_ids: int | None) -> tuple[int, DataFrame]:
    return ids.count() if n_ids is None else n_ids, ids.select(F.col(ids.columns[0]).alias("__id"))

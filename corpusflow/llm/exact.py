"""Exact de-duplication by content sort (native).

Rows are range-partitioned by Spark's sampled splitters on the text's first
bytes, its 64-bit hash and a salt, sorted inside the partitions by these and
the whole text, and neighbouring rows are compared on the whole text: the
window's groups are runs of equal neighbours.  One shuffle carries the texts.

A text that holds many rows is cut into sub-runs by a salt taken from the
identifier.  Which texts need it is counted exactly (a hash with more than
``rows / (4 * partitions)`` copies, hence fewer than ``4 * partitions`` of
them), and the few sub-run leaders are merged by the SHA-256 of the text.

Defined results: a null text counts as empty; rows with a null identifier
come after all others; of rows repeated with one identifier and text a single
one stays; an empty table gives an empty result; columns named like an output
column are replaced, all others pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.store import shuffle_partitions, without

SPLITTER_BYTES = 64
OUT = ("keep_id", "group_size", "kept", "text_sha256")


def _copies_cut(docs: DataFrame, text: Column, parts: int) -> dict[int, int]:
    """Hash of each text with too many rows for one task -> number of sub-runs."""
    most = max(1, docs.count() // (4 * parts))
    hot = (docs.groupBy(F.xxhash64(text).alias("h")).count()
               .filter(F.col("count") > most)
               .select("h", F.ceil(F.col("count") / most).cast("int").alias("n")))
    return {r["h"]: r["n"] for r in hot.collect()}  # fewer than 4 * parts rows


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                partitions: int | None = None, keep: str = "largest") -> DataFrame:
    """``docs`` with ``keep_id`` (identifier of the row that stays),
    ``group_size``, ``kept`` and ``text_sha256`` for every row, dropped ones
    too.  ``keep``: which identifier of a group stays, "largest" or "smallest"."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep: {keep!r}")
    spark = docs.sparkSession
    parts = partitions or shuffle_partitions(spark)
    docs = without(docs, *OUT)
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = _copies_cut(docs, text, parts)

    tagged = (docs.withColumn("__body", text)
                  .withColumn("__front", F.substring(F.col("__body").cast("binary"), 1, SPLITTER_BYTES))
                  .withColumn("__hash", F.xxhash64("__body")))
    order = ["__front", "__hash"]
    if cut:
        pieces = F.create_map(*[F.lit(x) for kv in cut.items() for x in kv])
        salt = F.pmod(F.xxhash64(F.lit(1), F.col(id_col)), pieces[F.col("__hash")])
        tagged = tagged.withColumn("__salt", F.coalesce(salt, F.lit(0)).cast("int"))
        order.append("__salt")
    dealt = tagged.repartitionByRange(parts, *order)
    run = Window.partitionBy(*order, "__body")    # the range partitioning serves: no further shuffle
    first = F.col(id_col).desc_nulls_last() if keep == "largest" else F.col(id_col).asc_nulls_last()
    best = F.max if keep == "largest" else F.min
    out = (dealt.withColumn("__rank", F.row_number().over(run.orderBy(first)))
                .withColumn("keep_id", best(id_col).over(run))
                .withColumn("group_size", F.count(F.lit(1)).over(run))
                .withColumn("text_sha256", F.sha2("__body", 256)))
    if cut:
        # leaders of sub-runs: fewer than 8 * parts rows in all
        merged = (out.filter((F.col("__rank") == 1) & F.col("__hash").isin(list(cut)))
                     .groupBy(F.col("text_sha256").alias("__sha"))
                     .agg(best("keep_id").alias("__keep"), F.sum("group_size").alias("__size")))
        merged = spark.createDataFrame(merged.collect(), merged.schema)
        out = (out.join(F.broadcast(merged), out["text_sha256"] == merged["__sha"], "left")
                  .withColumn("keep_id", F.when(F.col("__sha").isNotNull(), F.col("__keep")).otherwise(F.col("keep_id")))
                  .withColumn("group_size", F.coalesce("__size", "group_size"))
                  .drop("__sha", "__keep", "__size"))
    # rows without an identifier in a cut group: sub-run 0 holds them all
    stays = (F.col("__rank") == 1) & F.col(id_col).eqNullSafe(F.col("keep_id"))
    return out.withColumn("kept", stays).drop("__body", "__front", "__hash", "__salt", "__rank")

"""The training-data pipeline: quality rules, line dedup, near-duplicates, mixing,
tokenising.

Each stage is a function of (session, documents, folder of the tables); its result
is written as Parquet into the shared folder and read back as the documents of
the next one.  All but the last return the columns of ``documents``; where a stage
changes the text, ``n_chars`` follows.

Defined results: the quality stage drops null and empty texts, so no later stage of
a run sees one (given one by itself, line dedup and near dedup keep it, mixing gives
it no words and the tokeniser no ids); repeated rows of one identifier and text are
judged alike, and near dedup keeps them together; rows without an identifier are kept
by both dedup stages; ties fall by identifier; further columns pass unchanged; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import linededup, minhash, mixing, pieces, quality
from corpusflow.llm.store import stored


ROWS_PER_BATCH = 2000     # that go to a Python worker at once
BYTES_PER_BATCH = 4 << 20 # the same, in bytes; a longer row goes alone
KEPT_CUTS = 100_000       # encoded cuts that a worker remembers
PART_BYTES = 1 << 18      # of texts that a worker encodes at once


def _small_batches(spark: SparkSession) -> None:
    """Stages follow each other in the same executors, whose Python workers live on:
    the session's batches get smaller, so that their buffers stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")}
    return docs.select(*[new[c].alias(c) if c in new else F.col(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines."""
    _small_batches(spark)
    return quality.cleaned(docs, "text", "n_chars" if "n_chars" in docs.columns else None)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; so do documents that lose all lines."""
    done = linededup.line_dedup(docs)
    left = done.filter("n_removed_lines = 0 OR n_removed_lines < n_lines")
    return _with_text(left, docs.columns, "clean_text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group of near-duplicates."""
    _small_batches(spark)
    return minhash.drop_near_duplicates(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says."""
    return mixing.mix_sources(docs).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids instead of the text."""
    _small_batches(spark)
    ids = pieces.encode(docs, pieces.default_model(), out="ids", check_col="round_trip", keep_text=False,
                        part_bytes=PART_BYTES, kept_cuts=KEPT_CUTS)
    return ids.select("doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                      "round_trip", "ids")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("minhash_near_dedup", near_dedup),
          ("mix_sources", mix), ("sentencepiece", tokenise)]

#: SQL cannot express the last stage; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Manifest sources (S1-S4) and the driver tables.

Row order matters to several curation rules (keep-first dedup, limit,
splits), and Spark has no row order.  Every source therefore adds ``_seq``:
a struct that sorts in file order -- (file path, split start, id inside the
split) for text formats and (file path, row index) for Parquet.  Tables with a
natural key use the key instead.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQ = "_seq"
MAX_NAMED_FILES = 10_000


def with_text_seq(df: DataFrame) -> DataFrame:
    """File-order key for line-based formats (JSON lines, CSV, text)."""
    return df.withColumn(SEQ, F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i")))


def with_parquet_seq(df: DataFrame) -> DataFrame:
    return df.withColumn(SEQ, F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.row_index").alias("i")))


def read_manifest(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                  mode: str = "FAILFAST", ordered: bool = True) -> DataFrame:
    """JSON-lines manifest with a declared schema.  A missing input gives
    an empty frame (not an error); a malformed line fails the job unless
    ``mode="DROPMALFORMED"``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    paths = [path] if isinstance(path, str) else list(path)
    existing = [p for p in paths if _exists(spark, p)]
    if not existing:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(SEQ, F.struct(F.lit("").alias("f"), F.lit(0).cast("long").alias("b"),
                                              F.lit(0).cast("long").alias("i"))) if ordered else empty
    df = spark.read.schema(schema).option("mode", mode).json(existing)
    return with_text_seq(df) if ordered else df


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    globbed = fs.globStatus(hpath)
    return globbed is not None and len(globbed) > 0


def list_files(spark: SparkSession, root: str, extension: str, key: str = "audio_filepath") -> DataFrame:
    """Every file below ``root`` with the extension, recursively.  Only
    the path column is read (the content column is pruned by the scan)."""
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", f"*.{extension}")
          .load(root)
          .select(F.regexp_replace("path", "^file:", "").alias(key), "length"))
    return df.select(key)


def combine_manifests(frames: Sequence[DataFrame]) -> DataFrame:
    """Union in list order; columns missing on one side are NULL.
    The order key becomes (source number, original order)."""
    tagged = [f.withColumn(SEQ, F.struct(F.lit(i).alias("src"), F.col(SEQ).alias("s")))
              if SEQ in f.columns else f.withColumn(SEQ, F.struct(F.lit(i).alias("src")))
              for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_text_lines(spark: SparkSession, manifest: DataFrame, input_file_key: str,
                    text_key: str, root: str | None = None, glob: str = "*") -> DataFrame:
    """One row per non-blank stripped line of the file named in each
    manifest row; the row's other fields are copied.

    With ``root`` all files below it (matching ``glob``) are scanned and joined with
    the manifest on the path, so no list of paths passes the driver.  Without it the
    manifest's paths are named to the scan, ``MAX_NAMED_FILES`` at most.
    """
    if root is not None:
        files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root)
    else:
        paths = [r[0] for r in manifest.select(input_file_key).distinct().limit(MAX_NAMED_FILES + 1).collect()]
        if len(paths) > MAX_NAMED_FILES:
            raise ValueError(f"more than {MAX_NAMED_FILES} files: give the folder that holds them as root")
        if not paths:
            return manifest.withColumn(text_key, F.lit(None).cast("string")).limit(0)
        files = spark.read.text(paths)
    lines = (files
             .select(F.regexp_replace(F.col("_metadata.file_path"), "^file:", "").alias("_path"),
                     F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_i"),
                     F.trim(F.col("value")).alias(text_key))
             .filter(F.col(text_key) != ""))
    base = manifest.drop(text_key) if text_key in manifest.columns else manifest
    norm = F.regexp_replace(F.col(input_file_key), "^file:", "")
    out = base.join(lines, norm == lines["_path"], "inner")
    if SEQ in out.columns:
        out = out.withColumn(SEQ, F.struct(F.col(SEQ).alias("p"), F.col("_b"), F.col("_i")))
    return out.drop("_path", "_b", "_i")


# --- driver tables -----------------------------------------------------------

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as a speech manifest: a path, the text, a
    duration derived from the text length, the language and ``_seq``."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("audio_filepath"),
        "doc_id", "text", "lang", "source",
        doc_duration(F.col("doc_id"), F.col("n_chars")).alias("duration"),
        F.col("doc_id").alias(SEQ))


def doc_duration(doc_id, n_chars):
    """Deterministic pseudo duration in seconds: about 14 characters per
    second, spread by the id so that rates vary between rows."""
    return n_chars.cast("double") / (F.lit(8.0) + (doc_id % 13)) + (doc_id % 7) * F.lit(0.5)


DOC_DURATION_SQL = "(CAST(n_chars AS DOUBLE) / (8.0 + (doc_id % 13)) + (doc_id % 7) * 0.5)"

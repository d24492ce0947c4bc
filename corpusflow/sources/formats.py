"""Transcript and metadata readers.

Each reader is a distributed scan plus column expressions; malformed lines
either fail the job (``raise_error``) or are dropped, as the matching rule
does.  File order is kept in ``_seq``.
"""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.sources.manifest import SEQ, with_text_seq

WS = r"(?U)\s+"


def _path() -> F.Column:
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:", "")


def read_text_lines_raw(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """Lines of text files with file path, order key and line number inside
    the file (the number is a per-file window over a small projection)."""
    r = spark.read
    if glob:
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    df = with_text_seq(r.text(path)).withColumn("file", _path())
    from pyspark.sql import Window
    return df.withColumn("line_no", F.row_number().over(Window.partitionBy("file").orderBy(SEQ)) - 1)


def skip_first_data_row(df: DataFrame, file_col: str = "file") -> DataFrame:
    """The ``next(reader)`` quirk: drop the first data row of every file."""
    first = df.groupBy(file_col).agg(F.min(SEQ).alias(SEQ))
    return df.join(first, [file_col, SEQ], "left_anti")


def read_tsv(spark: SparkSession, path, schema: str | T.StructType, header: bool = True,
             skip_first: bool = False, sep: str = "\t") -> DataFrame:
    """Delimited file with header and a declared schema."""
    df = (spark.read.schema(schema).option("sep", sep).option("header", header).option("quote", '"')
          .option("mode", "FAILFAST").csv(path))
    df = with_text_seq(df).withColumn("file", _path())
    return skip_first_data_row(df) if skip_first else df


def read_utterance_tab(spark: SparkSession, path) -> DataFrame:
    """``utt_id<TAB>text`` lines; any other field count fails the job.
    The nested path is built from the first two ``_`` parts of the id."""
    df = read_text_lines_raw(spark, path)
    parts = F.split("value", "\t")
    checked = F.when(F.size(parts) != 2, F.raise_error(F.concat(F.lit("bad line: "), F.col("value")))) \
        .otherwise(parts)
    out = df.withColumn("_p", checked)
    ids = F.split(F.col("_p")[0], "_")
    return out.select(F.col("_p")[0].alias("utt_id"), F.col("_p")[1].alias("text"),
                      F.concat_ws("/", ids[0], ids[1], F.col("_p")[0]).alias("rel_path"), SEQ)


def read_min_fields(spark: SparkSession, path, sep: str = "\t", min_fields: int = 2) -> DataFrame:
    """Split lines, skip those with fewer than ``min_fields`` fields."""
    df = read_text_lines_raw(spark, path).withColumn("fields", F.split("value", sep))
    return df.filter(F.size("fields") >= min_fields).select("fields", "file", SEQ)


def read_exact_fields(spark: SparkSession, path, sep: str = ", ", n: int = 3) -> DataFrame:
    """Exactly ``n`` fields per line, else the job fails."""
    df = read_text_lines_raw(spark, path)
    parts = F.split("value", sep)
    return df.select(F.when(F.size(parts) != n, F.raise_error(F.concat(F.lit("bad line: "), F.col("value"))))
                     .otherwise(parts).alias("fields"), "file", SEQ)


def read_trans_tree(spark: SparkSession, root: str, glob: str = "*.trans.txt") -> DataFrame:
    """``id words...`` lines of every matching file below ``root``."""
    df = read_text_lines_raw(spark, root, glob)
    return df.select(F.regexp_extract("value", r"^(\S+) (.*)$", 1).alias("utt_id"),
                     F.regexp_extract("value", r"^(\S+) (.*)$", 2).alias("text"), "file", SEQ)


def read_whole_texts(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """One row per file with its full text and stem."""
    r = spark.read
    if glob:
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    df = r.text(path, wholetext=True).withColumn("file", _path())
    return df.select("file", F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1).alias("stem"),
                     F.col("value").alias("text"))


def pair_audio_text(spark: SparkSession, root: str, audio_ext: str = "flac", text_ext: str = "txt",
                    fallback_ext: str | None = None) -> DataFrame:
    """Audio files paired with same-stem text files in the same
    folder; unpaired audio is dropped (inner join), or matched against a
    fallback extension first."""
    from corpusflow.sources.manifest import list_files
    audio = list_files(spark, root, audio_ext, "audio_filepath") \
        .withColumn("key", F.regexp_replace("audio_filepath", r"\.[^./]+$", ""))
    texts = read_whole_texts(spark, root, f"*.{text_ext}") \
        .withColumn("key", F.regexp_replace("file", r"\.[^./]+$", ""))
    out = audio.join(texts.select("key", F.trim("text").alias("text")), "key", "left")
    if fallback_ext:
        fb = read_whole_texts(spark, root, f"*.{fallback_ext}") \
            .withColumn("key", F.regexp_replace("file", r"\.[^./]+(\.[^./]+)?$", ""))
        out = out.join(fb.select("key", F.trim("text").alias("_fb")), "key", "left") \
                 .withColumn("text", F.coalesce("text", "_fb")).drop("_fb")
    return out.filter(F.col("text").isNotNull()).drop("key")


def read_ctm(spark: SparkSession, path) -> DataFrame:
    """``utt chan start dur word`` with at least five fields;
    end = start + dur, rounded to three places."""
    df = read_text_lines_raw(spark, path)
    f = F.split(F.trim("value"), WS)
    return df.withColumn("_f", f).filter(F.size("_f") >= 5).select(
        F.col("_f")[0].alias("utt_id"), F.col("_f")[1].alias("channel"),
        F.bround(F.col("_f")[2].cast("double"), 3).alias("start"),
        F.bround(F.col("_f")[2].cast("double") + F.col("_f")[3].cast("double"), 3).alias("end"),
        F.col("_f")[4].alias("word"), "file", SEQ)


def read_rttm_starts(spark: SparkSession, path) -> DataFrame:
    """Segment start = fourth space-separated field, per file."""
    df = read_text_lines_raw(spark, path)
    return df.select("file", F.split("value", " ")[3].cast("double").alias("start"), SEQ)


def read_token_table(spark: SparkSession, path, columns=("token", "speaker", "punctuation", "tags",
                                                          "wer_tags")) -> DataFrame:
    """Pipe-delimited token table with a header; rows of another width
    are dropped; JSON in ``tags``/``wer_tags`` parsed to arrays."""
    df = read_text_lines_raw(spark, path).filter(F.col("line_no") > 0)
    f = F.split("value", r"\|")
    df = df.withColumn("_f", f).filter(F.size("_f") == len(columns))
    out = df.select(*[F.col("_f")[i].alias(c) for i, c in enumerate(columns)], "file", "line_no", SEQ)
    for c in ("tags", "wer_tags"):
        if c in columns:
            out = out.withColumn(c, F.from_json(c, "array<string>"))
    return out


def caption_time(c) -> F.Column:
    """``[HH:]MM:SS.mmm`` -> seconds; hours above 23 are kept as hours."""
    parts = F.split(c, ":")
    n = F.size(parts)
    h = F.when(n == 3, parts[0].cast("double")).otherwise(F.lit(0.0))
    m = F.element_at(parts, -2).cast("double")
    s = F.element_at(parts, -1).cast("double")
    return h * 3600 + m * 60 + s


_CUE = r"(?s)^(?:([^\n]*)\n)?([0-9:.]+)\s*-->\s*([0-9:.]+)[^\n]*\n(.*)$"


def read_vtt(spark: SparkSession, path) -> DataFrame:
    """WebVTT files -> one row per file with
    ``segments array<struct<segment_id,start_time,end_time,text>>``;
    multi-line cue text joined by a space."""
    df = read_whole_texts(spark, path)
    blocks = F.filter(F.split(F.regexp_replace("text", "\r\n", "\n"), r"\n\s*\n"),
                      lambda b: b.rlike(r"-->"))

    def cue(b):
        return F.struct(F.regexp_extract(b, _CUE, 2).alias("_s"), F.regexp_extract(b, _CUE, 3).alias("_e"),
                        F.trim(F.regexp_replace(F.regexp_extract(b, _CUE, 4), r"\s*\n\s*", " ")).alias("t"))

    cues = F.transform(blocks, cue)
    segs = F.transform(cues, lambda c, i: F.struct(i.cast("long").alias("segment_id"),
                                                   caption_time(c["_s"]).alias("start_time"),
                                                   caption_time(c["_e"]).alias("end_time"),
                                                   c["t"].alias("text")))
    return df.select("file", "stem", segs.alias("segments"))


def read_json_array(spark: SparkSession, path, schema: str | T.StructType) -> DataFrame:
    """Whole-file JSON arrays (BOM tolerated)."""
    return spark.read.schema(schema).option("multiLine", "true").option("encoding", "UTF-8").json(path)


_DUR_SCHEMA = T.StructType([T.StructField("audio_filepath", T.StringType()),
                            T.StructField("duration", T.DoubleType())])


def audio_durations(spark: SparkSession, root: str, extension: str = "wav") -> DataFrame:
    """duration = frames / rate from the WAV header; unreadable
    files get -1.0.  Runs over the binary file source in Arrow batches."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", f"*.{extension}").load(root)
             .select(F.regexp_replace("path", "^file:", "").alias("audio_filepath"), "content"))

    def probe(it):
        import wave
        for pdf in it:
            out = []
            for p, b in zip(pdf["audio_filepath"], pdf["content"]):
                try:
                    with wave.open(io.BytesIO(b)) as w:
                        out.append(w.getnframes() / float(w.getframerate()))
                except Exception:  # noqa: BLE001 - any unreadable header
                    out.append(-1.0)
            yield pd.DataFrame({"audio_filepath": pdf["audio_filepath"], "duration": out})

    return files.mapInPandas(probe, _DUR_SCHEMA)

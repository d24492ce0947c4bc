"""Manifests from tables of ids, paired folders, nested chapters and transcript
tables (S20, S21, S23, S24)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.sources.formats import read_text_lines_raw
from corpusflow.sources.manifest import list_files

# Names of the splits; the first three are short for the clean ones.
SPLITS = {"train": "clean_train", "dev": "clean_dev", "test": "clean_test"}
_ALL_SPLITS = (*SPLITS.values(), "noisy_train", "noisy_dev", "noisy_test")


def split_name(data_split: str) -> str:
    """``train``, ``dev`` and ``test`` mean the clean splits."""
    name = SPLITS.get(data_split, data_split)
    if name not in _ALL_SPLITS:
        raise ValueError(f"data split value must be from {[*SPLITS, *_ALL_SPLITS]}, {data_split!r} was given")
    return name


def video_manifest(videos: DataFrame, audio_files: DataFrame, caption_files: DataFrame, audio_dir: str, caption_dir: str, language: str,
                   id_col: str = "video_id", sample_id: str = "sample_id", captions: str = "vtt_filepath", audio: str = "audio_filepath",
                   path_col: str = "audio_filepath") -> DataFrame:
    """Rows of a table of video ids that have both an audio file and a caption
    file (listings as :func:`list_files` gives them), with both paths; the id column
    becomes ``sample_id``."""
    wav = F.concat(F.lit(audio_dir.rstrip("/") + "/"), F.col(id_col), F.lit(".wav"))
    vtt = F.concat(F.lit(caption_dir.rstrip("/") + "/"), F.col(id_col), F.lit(f".{language}.vtt"))
    tagged = videos.withColumn(captions, vtt).withColumn(audio, wav)
    have_audio = audio_files.select(F.col(path_col).alias(audio)).distinct()
    have_captions = caption_files.select(F.col(path_col).alias(captions)).distinct()
    out = tagged.join(have_audio, audio, "left_semi").join(have_captions, captions, "left_semi")
    return out.withColumnRenamed(id_col, sample_id)


def paired_captions(spark: SparkSession, data_dir: str, language: str, extension: str = "*") -> DataFrame:
    """Every audio file below ``data_dir/wav`` with the path of its caption file in
    ``data_dir/vtt``: the name up to its first dot and the language.  That the caption
    exists is not checked."""
    root = data_dir.rstrip("/")
    files = list_files(spark, f"{root}/wav", extension)
    name = F.substring_index(F.element_at(F.split("audio_filepath", "/"), -1), ".", 1)
    folder = F.regexp_replace("audio_filepath", r"/wav/[^/]*$", "/vtt/")
    return files.withColumn("vtt_filepath", F.concat(folder, name, F.lit(f".{language}.vtt")))


def chapter_utterances(chapters: DataFrame, utterances: str = "utterances", error: str = "error") -> tuple[DataFrame, DataFrame]:
    """One row for each utterance of the chapters without an error (fields of the
    utterance override the chapter's), and the failed chapters as they are."""
    failed = F.col(error).isNotNull() if error in chapters.columns else F.lit(False)
    inner = chapters.schema[utterances].dataType.elementType.names
    rows = chapters.filter(~failed).withColumn("_u", F.explode(utterances))
    keep = [c for c in chapters.columns if c not in (utterances, error, *inner)]
    return rows.select(*keep, *[F.col("_u")[c].alias(c) for c in inner]), chapters.filter(failed)


_TDF = ("file_id", "channel", "start", "end", "speaker", "speaker_type", "speaker_dialect", "text", "section", "turn", "segment")


def read_tdf(spark: SparkSession, path: str, audio_dir: str, glob: str = "*.tdf", min_duration: float = 0.2) -> DataFrame:
    """Tab transcripts with three header lines.  The line number counts from 0
    after them; further columns are joined by a comma; empty texts and turns shorter
    than ``min_duration`` go."""
    lines = read_text_lines_raw(spark, path, glob)
    cells = F.split(F.trim("value"), "\t")
    rows = lines.withColumn("_line", F.col("line_no") - 3).filter("_line >= 0").withColumn("_c", cells).filter(F.size("_c") >= len(_TDF))
    named = rows.select("_line", *[F.get("_c", F.lit(i)).alias(n) for i, n in enumerate(_TDF)],
                        F.array_join(F.slice("_c", len(_TDF) + 1, 1 << 20), ",").alias("other_info"))
    base = F.substring_index("file_id", ".sph", 1)
    name = F.concat(F.lit(audio_dir.rstrip("/") + "/"), base, F.lit("_line"), F.col("_line"), F.lit("_channel"), F.col("channel"),
                    F.lit("_"), F.col("section"), F.lit("_"), F.col("turn"), F.lit("_"), F.col("segment"), F.lit(".wav"))
    long_enough = F.col("end").cast("double") - F.col("start").cast("double") >= min_duration
    return (named.filter((F.length("text") > 0) & long_enough).withColumn("audio_filepath", name)
                 .withColumn("duration", F.col("end").cast("double") - F.col("start").cast("double")).drop("_line", "file_id"))

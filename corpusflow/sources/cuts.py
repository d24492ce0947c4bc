"""Cut manifests (S30) and tab transcripts with speaker metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.filters import drop_pauses
from corpusflow.operators.folds import merge_runs_by_duration
from corpusflow.operators.joins import left_metadata
from corpusflow.sources.manifest import SEQ, with_text_seq

_CUT = ("id string, duration double, type string, "
        "recording struct<sources: array<struct<type: string, source: string, channels: array<int>>>, channel_ids: array<int>>, "
        "supervisions array<struct<text: string, speaker: string, gender: string, language: string{custom}>>")


def _require(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Fail the job at the first row that breaks a check."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce("id", F.lit("?")))))
              for what, ok in checks.items()]
    return df.filter(F.coalesce(*broken, F.lit("")) == "")


def read_cuts(spark: SparkSession, path: str, custom_schema: str = "") -> DataFrame:
    """JSON-lines cut manifest (plain or gzip).  Every cut has to be a mono cut
    with one file source of one channel and one supervision, else the job fails.
    ``custom_schema`` declares the supervisions' custom fields; they override the
    others where they are set."""
    custom = f", custom: struct<{custom_schema}>" if custom_schema else ""
    cuts = with_text_seq(spark.read.schema(_CUT.replace("{custom}", custom)).json(path))
    src, sup = F.col("recording.sources"), F.col("supervisions")
    channels = F.coalesce(F.size("recording.channel_ids"), F.size(F.get(src, F.lit(0))["channels"]))
    ok = _require(cuts, {
        "only mono cuts are supported": F.col("type") == "MonoCut",
        "the cut has no recording": F.col("recording").isNotNull(),
        "only one audio source is supported": F.size(src) == 1,
        "only sources of type file are supported": F.get(src, F.lit(0))["type"] == "file",
        "only one channel is supported": F.when(channels > 0, channels).otherwise(1) == 1,
        "only one supervision is supported": F.size(sup) == 1})
    s = F.get(sup, F.lit(0))
    fields = {"audio_filepath": F.get(src, F.lit(0))["source"], "duration": F.col("duration"), "cut_id": F.col("id")}
    fields |= {m: s[m] for m in ("text", "speaker", "gender", "language")}
    if custom_schema:
        declared = cuts.schema["supervisions"].dataType.elementType["custom"].dataType.names
        fields |= {c: F.coalesce(s["custom"][c], fields[c]) if c in fields else s["custom"][c] for c in declared}
    return ok.select(SEQ, *[v.alias(k) for k, v in fields.items()])


def read_transcripts_with_speakers(spark: SparkSession, transcripts: str, metadata: str, without_pauses: bool = True,
                                   group_duration_threshold: float = 20.0) -> DataFrame:
    """Tab transcripts (``Spkr``, ``StTime``, ``Content``, ``EnTime``), one file a
    recording.  Pause lines go, neighbouring segments of a speaker are merged up to the
    threshold (0: not merged), and gender, age, education and occupation come from
    the speaker metadata, made distinct first."""
    wanted = ["Spkr", "StTime", "Content", "EnTime"]
    raw = spark.read.option("sep", "\t").option("header", True).csv(transcripts)
    rows = with_text_seq(raw).select(F.regexp_extract("_metadata.file_path", r"([^/]+)\.[^./]*$", 1).alias("original_file"), SEQ,
                                     *[F.col(c) for c in wanted])
    rows = rows.withColumns({"StTime": F.col("StTime").cast("double"), "EnTime": F.col("EnTime").cast("double")})
    if without_pauses:
        rows = drop_pauses(rows, "Content")
    if group_duration_threshold > 0:
        rows = merge_runs_by_duration(rows, "original_file", [SEQ], "Spkr", "StTime", "EnTime", "Content", group_duration_threshold)
    meta = spark.read.option("sep", "\t").option("header", True).csv(metadata)
    meta = meta.select(F.col("`CORAAL.Spkr`").alias("Spkr"), "Gender", "Age", "Education", "Occupation")
    out = left_metadata(rows, meta, ["Spkr"], ["Gender", "Age", "Education", "Occupation"])
    return out.select("original_file", F.col("StTime").alias("offset"), (F.col("EnTime") - F.col("StTime")).alias("duration"),
                      F.trim("Content").alias("text"), F.col("Spkr").alias("speaker"),
                      F.col("original_file").contains(F.col("Spkr")).alias("is_interviewee"),
                      *[F.col(c).alias(c.lower()) for c in ("Gender", "Age", "Education", "Occupation")])

"""Projections and column edits (P1-P16).  All are plain ``select`` /
``withColumn`` rewrites, so Catalyst prunes the columns they drop all the
way down to the scan."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.sources.manifest import SEQ


def _keep_seq(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return list(cols) + ([SEQ] if SEQ in df.columns and SEQ not in cols else [])


def keep_only_fields(df: DataFrame, fields_to_keep: Sequence[str]) -> DataFrame:
    """Missing field -> error at plan time."""
    missing = [f for f in fields_to_keep if f not in df.columns]
    if missing:
        raise KeyError(f"fields not in manifest: {missing}")
    return df.select(*_keep_seq(df, fields_to_keep))


def flexible_keep_fields(df: DataFrame, fields_to_keep: Sequence[str]) -> DataFrame:
    """Keep the listed fields that exist."""
    return df.select(*_keep_seq(df, [f for f in fields_to_keep if f in df.columns]))


def missing_field_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """P2 report: per listed field, rows where it is missing (absent column
    = every row)."""
    n = F.count("*")
    return df.agg(*[(F.count_if(F.col(f).isNull()) if f in df.columns else n).alias(f) for f in fields])


def drop_fields(df: DataFrame, fields_to_drop: Sequence[str]) -> DataFrame:
    """Absent names are ignored."""
    return df.drop(*fields_to_drop)


def rename_fields(df: DataFrame, rename: Mapping[str, str]) -> DataFrame:
    """Renames applied one after another in mapping order; an existing
    target column is replaced."""
    for src, tgt in rename.items():
        if src not in df.columns:
            raise KeyError(f"field {src!r} not in manifest")
        if tgt != src and tgt in df.columns:
            df = df.drop(tgt)
        df = df.withColumnRenamed(src, tgt)
    return df


def duplicate_fields(df: DataFrame, duplicate: Mapping[str, str]) -> DataFrame:
    """P5: ``{source: new}``."""
    for src in duplicate:
        if src not in df.columns:
            raise KeyError(f"field {src!r} not in manifest")
    return df.withColumns({tgt: F.col(src) for src, tgt in duplicate.items()})


def add_constant_fields(df: DataFrame, fields: Mapping[str, object]) -> DataFrame:
    """P6."""
    return df.withColumns({k: F.lit(v) for k, v in fields.items()})


def combine_sources(df: DataFrame, sources: Sequence[Mapping[str, str]], target: str,
                    na_indicator: str = "n/a") -> DataFrame:
    """First available source (not NULL, not ``na_indicator``) into
    ``target`` and its label into ``<target>_origin``; none -> both n/a."""
    picks = []
    for s in sources:
        if s["field"] not in df.columns:
            continue
        c = F.col(s["field"])
        picks.append(F.when(c.isNotNull() & (c.cast("string") != na_indicator),
                            F.struct(c.cast("string").alias("v"), F.lit(s["origin_label"]).alias("o"))))
    na = F.struct(F.lit(na_indicator).alias("v"), F.lit(na_indicator).alias("o"))
    chosen = F.coalesce(*picks, na)
    return df.withColumn("_cs", chosen).withColumn(target, F.col("_cs.v")) \
             .withColumn(f"{target}_origin", F.col("_cs.o")).drop("_cs")


def relative_path(path: Column, base_dir: str) -> Column:
    """``os.path.relpath(path, base)`` for absolute normalised paths."""
    base_parts = [p for p in base_dir.rstrip("/").split("/") if p]
    parts = F.filter(F.split(path, "/"), lambda x: x != F.lit(""))
    base = F.array(*[F.lit(p) for p in base_parts]) if base_parts else F.array().cast("array<string>")
    n = F.least(F.size(parts), F.lit(len(base_parts)))
    idx = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    same = F.filter(idx, lambda i: (i <= n) & (F.element_at(parts, i) == F.element_at(base, i)))
    # common prefix = count of leading equal parts
    common = F.aggregate(same, F.struct(F.lit(0).alias("k"), F.lit(True).alias("run")),
                         lambda acc, i: F.struct(
                             F.when(acc["run"] & (i == acc["k"] + 1), acc["k"] + 1).otherwise(acc["k"]).alias("k"),
                             (acc["run"] & (i == acc["k"] + 1)).alias("run")))["k"]
    ups = F.array_repeat(F.lit(".."), F.lit(len(base_parts)) - common)
    rest = F.slice(parts, common + 1, F.size(parts) + 1)
    joined = F.array_join(F.concat(ups, rest), "/")
    return F.when(joined == "", F.lit(".")).otherwise(joined)


def change_to_relative_path(df: DataFrame, base_dir: str, key: str = "audio_filepath") -> DataFrame:
    return df.withColumn(key, relative_path(F.col(key), base_dir))


def file_stem(path: Column) -> Column:
    """Last path part without its extension."""
    last = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(last, r"(?<=.)\.[^.]*$", "")


def source_book_name(df: DataFrame, source_file_key: str, source_key: str) -> DataFrame:
    return df.withColumn(source_key, file_stem(F.col(source_file_key)))


def segment_meta_from_name(path: Column) -> Column:
    """``device`` = first two ``_`` parts and ``session`` = last part
    of the stem when it has at least four parts; else ``unknown_device`` and
    the stem."""
    stem = file_stem(path)
    parts = F.split(stem, "_")
    ok = F.size(parts) >= 4
    return F.struct(
        F.when(ok, F.concat_ws("_", F.element_at(parts, 1), F.element_at(parts, 2)))
         .otherwise(F.lit("unknown_device")).alias("device_id"),
        F.when(ok, F.element_at(parts, -1)).otherwise(stem).alias("session_id"))


PATH_TAIL_FIELDS = ("session_id", "hour", "day", "month", "year", "device_id", "location", "country")


def path_tail_fields(df: DataFrame, key: str = "audio_filepath") -> DataFrame:
    """With at least nine path parts, the parts counted from the end
    before the file name become session/hour/day/month/year/device/location/
    country (only where the row does not carry them already)."""
    parts = F.split(F.col(key), "/")
    ok = F.size(parts) >= 9
    out = df
    for k, name in enumerate(PATH_TAIL_FIELDS, start=2):
        val = F.when(ok, F.element_at(parts, -k))
        out = out.withColumn(name, F.coalesce(F.col(name), val) if name in df.columns else val)
    return out


def structured_name(path: Column, fmt: str = "wav") -> Column:
    """``{device}_{yyyymmdd}_{hour}_{session}.{fmt}`` for paths with at
    least nine parts, else the original file stem."""
    parts = F.split(path, "/")
    ok = F.size(parts) >= 9
    name = F.concat(F.element_at(parts, -7), F.lit("_"),
                    F.element_at(parts, -6), F.element_at(parts, -5), F.element_at(parts, -4), F.lit("_"),
                    F.element_at(parts, -3), F.lit("_"), F.element_at(parts, -2), F.lit("." + fmt))
    return F.when(ok, name).otherwise(F.concat(file_stem(path), F.lit("." + fmt)))


def promote_predictions(df: DataFrame, only_wav: bool = True, key: str = "audio_filepath") -> DataFrame:
    """``text`` -> ``orig_text``, ``pred_text`` -> ``text``."""
    out = df.withColumnsRenamed({"text": "orig_text"}).withColumnsRenamed({"pred_text": "text"})
    return out.filter(F.col(key).endswith(".wav")) if only_wav else out


def chat_prompt(template: Mapping[str, str]) -> Column:
    """``array<struct<role, content>>`` from ``{role: template}``, the
    template's ``{field}`` parts filled from the row (literal pieces stay
    JVM-side constants)."""
    import string

    msgs = []
    for role, tmpl in template.items():
        pieces = []
        for lit, field, _spec, _conv in string.Formatter().parse(tmpl):
            if lit:
                pieces.append(F.lit(lit))
            if field is not None:
                pieces.append(F.col(field).cast("string"))
        msgs.append(F.struct(F.lit(role).alias("role"),
                             (F.concat(*pieces) if pieces else F.lit("")).alias("content")))
    return F.array(*msgs)


def entity_types(tags: Column) -> Column:
    """Distinct entity types (text after ``:``), first-seen order."""
    typed = F.filter(tags, lambda t: t.contains(":"))
    return F.array_distinct(F.transform(typed, lambda t: F.trim(F.substring_index(t, ":", -1))))

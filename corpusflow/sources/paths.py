"""Manifests from the folder structure of audio paths.

The input is a frame with one path column, as :func:`list_files` gives it; all
fields are column expressions over the parts of the path, so nothing is read
from the driver and a listing of any size stays distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = {"mic": "customer", "spk": "employee"}


def _parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != F.lit(""))


def nine_part_manifest(files: DataFrame, data_dir: str, audio_type: str = "both", preserve_structure: bool = False,
                       key: str = "audio_filepath") -> DataFrame:
    """Files whose path below ``data_dir`` has exactly the nine parts country,
    location, device, year, month, day, hour, session, ``mic.wav`` or ``spk.wav``.
    ``audio_type`` "mic" or "spk" keeps one channel.  Sorted by device, time,
    session and channel."""
    if audio_type not in (*ROLES, "both"):
        raise ValueError(f"audio_type: {audio_type!r}")
    root = data_dir.rstrip("/") + "/"
    below = files.filter(F.col(key).startswith(root)).withColumn("_rel", F.substring(F.col(key), len(root) + 1, 1 << 30))
    p = below.withColumn("_p", _parts(F.col("_rel"))).filter((F.size("_p") == 9) & F.get("_p", F.lit(8)).isin("mic.wav", "spk.wav"))
    names = ["country", "location", "device_id", "year", "month", "day", "hour", "session_id"]
    cols = {n: F.get("_p", F.lit(i)) for i, n in enumerate(names)}
    out = p.select(F.col(key).alias("source_audio_filepath"), cols["country"].alias("country"), cols["location"].alias("location"),
                   cols["device_id"].alias("device_id"),
                   F.concat(cols["year"], F.lit("-"), cols["month"], F.lit("-"), cols["day"], F.lit("T"), cols["hour"], F.lit(":00:00")).alias("timestamp"),
                   cols["session_id"].alias("session_id"), F.substring(F.get("_p", F.lit(8)), 1, 3).alias("channel"),
                   *[cols[n].alias(n) for n in ("year", "month", "day", "hour")],
                   *([F.col("_rel").alias("relative_path"), F.array_join(F.slice("_p", 1, 8), "/").alias("hierarchy")] if preserve_structure else []))
    if audio_type != "both":
        out = out.filter(F.col("channel") == audio_type)
    return out.orderBy("device_id", "timestamp", "session_id", "channel", "source_audio_filepath")


def _entry(key: str, device: Column, stamp: Column, session: Column, brand: str, country: str, role: str) -> list[Column]:
    return [F.col(key).alias("audio_filepath"), F.lit("").alias("text"), session.alias("session_id"), device.alias("device_id"),
            stamp.alias("timestamp"), F.lit(brand).alias("brand"), F.lit(country).alias("country"),
            F.lit(f"{brand} {country}").alias("dataset_tag"), F.lit(role).alias("audio_type")]


def country_folder_manifest(files: DataFrame, brand_code: str, country_code: str, brand_name: str, country_name: str,
                            audio_type: str = "mic", raw_data_dir: str = "", key: str = "audio_filepath") -> DataFrame:
    """Files named ``<audio_type>.wav`` below ``raw_data_dir/brand_code/country_code``;
    device, year, month, day, hour and session follow the first folder named like the
    country.  Sorted by path."""
    if audio_type not in ROLES:
        raise ValueError(f"audio_type must be 'mic' or 'spk', got {audio_type!r}")
    root = "/".join(x for x in (raw_data_dir.rstrip("/"), brand_code, country_code) if x) + "/"
    folder = F.slice("_p", F.lit(1), F.size("_p") - 1)
    p = (files.filter(F.col(key).startswith(root) & F.col(key).endswith(f"/{audio_type}.wav"))
              .withColumn("_p", _parts(F.col(key))).withColumn("_p", folder)
              .withColumn("_at", F.array_position("_p", country_code).cast("int"))
              .filter((F.col("_at") > 0) & (F.col("_at") + 6 <= F.size("_p"))))

    def part(i: int) -> Column:
        return F.get("_p", F.col("_at") + i)

    stamp = F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit("T"), part(4), F.lit(":00:00"))
    return p.select(*_entry(key, part(0), stamp, part(5), brand_name, country_name, ROLES[audio_type])).orderBy("audio_filepath")


def anchored_manifest(files: DataFrame, anchor: str, brand_name: str, country_name: str, audio_type: str = "customer",
                      key: str = "audio_filepath") -> DataFrame:
    """Device, year, month, day and hour follow the first folder whose name
    contains ``anchor``; the session is the file's stem, and month, day and hour are
    padded to two digits.  Sorted by path."""
    p = (files.filter(F.col(key).endswith(".wav")).withColumn("_all", _parts(F.col(key)))
              .withColumn("_p", F.slice("_all", F.lit(1), F.size("_all") - 1))
              .withColumn("_at", F.array_position(F.transform("_p", lambda x: x.contains(anchor)), True).cast("int"))
              .filter((F.col("_at") > 0) & (F.col("_at") + 5 <= F.size("_p"))))

    def part(i: int) -> Column:
        return F.get("_p", F.col("_at") + i)

    def two(c: Column) -> Column:
        return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)

    stamp = F.concat(part(1), F.lit("-"), two(part(2)), F.lit("-"), two(part(3)), F.lit("T"), two(part(4)), F.lit(":00:00"))
    session = F.regexp_replace(F.element_at("_all", -1), r"(?<=.)\.wav$", "")
    return p.select(*_entry(key, part(0), stamp, session, brand_name, country_name, audio_type)).orderBy("audio_filepath")

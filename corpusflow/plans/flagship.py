"""The text half of the flagship curation chain as one lazy plan:

scan -> junk/secret regex gate (text normalised) -> word count, char rate ->
duration range -> char-rate range -> keep-first dedup on text -> stable sort.

Only built-in column expressions are used, so the whole chain up to the dedup
shuffle is one whole-stage-codegen span over a pruned Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import metrics as M
from corpusflow.functions import text as TX
from corpusflow.operators import filters as FL
from corpusflow.operators import shards as SH
from corpusflow.sources.manifest import SEQ, documents_manifest

# Patterns of the gate (secrets, personal data, markup junk).
# Written with ASCII classes so the same text is valid for RE2 and Java.
GATE_PATTERNS = [
    r"(?i)(api[_-]?key|secret|password|passwd|token)[ ]*[:=]",
    r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    r"(?i)lorem ipsum",
]

GATE_PARAMS = dict(min_duration=1.0, max_duration=900.0, low_charrate=6.0, high_charrate=20.0)


def text_gate(manifest: DataFrame, min_duration: float, max_duration: float,
              low_charrate: float, high_charrate: float) -> DataFrame:
    m = FL.drop_if_regex_match(manifest, GATE_PATTERNS, text_key="text")
    m = m.withColumns({
        "num_words": TX.count_words(F.col("text")),
        "char_rate": M.charrate("text", "duration"),
    })
    m = FL.drop_high_low_duration(m, max_duration, min_duration)
    m = m.filter(F.exists(F.array("char_rate"), lambda rate: (rate >= low_charrate) & (rate <= high_charrate)))
    m = FL.drop_duplicates(m, "text")
    return SH.sort_manifest(m, "duration", descending=True)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = documents_manifest(spark, sf_dir)
    out = text_gate(m, **GATE_PARAMS)
    return out.select("audio_filepath", "doc_id", "text", "duration", "num_words", "char_rate")

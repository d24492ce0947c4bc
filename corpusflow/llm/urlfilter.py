"""URL filter: host and path rules, then a list of canonical URLs behind a
blocked Bloom filter.

The longest rule that fits a URL decides.  A URL that no rule fits is blocked
when its canonical form is listed: a blocked Bloom filter (one 512-bit block
per key, eight bits set in it) passes the possible hits, and an exact hash join
with the list removes the false ones.  The filter has a fixed number of bits at most
(``max_filter_bits``), whatever the list's length; a longer list only lets more
rows through to the exact join, which decides alone.

Defined results: a null URL, or one without "://", has an empty host and path,
fits no rule, is never listed, and is allowed; repeated rows are judged alike;
an empty list blocks nothing; an empty table gives an empty result; columns
named like an output column are replaced, others pass unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.bloom import MAX_BITS, bloom_words, may_contain
from corpusflow.llm.store import stored, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str          # "allow" or "block"
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without "www.", path without an index page, an extension
    ".html" or closing slashes; no scheme, query or fragment."""
    bare = F.regexp_replace(host, r"^www\.", "")
    short = F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html$", ""), r"/+$", "")
    return F.concat(bare, short)


def rule_column(host: Column, path: Column, rules: Sequence[Rule], part: str) -> Column:
    """Name or verdict of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):   # the longest ends outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name if part == "name" else r.verdict)).otherwise(out)
    return out


def url_filter(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url_col: str = "url",
               listed_col: str = "canonical", max_filter_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``.
    ``listed``: a table of canonical URLs, repeats allowed."""
    spark = pages.sparkSession
    pages = without(pages, "host", "path", "rule", "listed", "verdict")
    keys = stored(listed.select(F.col(listed_col).alias("__canon")).filter(F.col("__canon").isNotNull()).distinct()
                        .withColumn("__h", F.xxhash64("__canon")), "listed")
    may = may_contain(spark, bloom_words(keys, "__h", keys.count(), max_filter_bits))

    url = F.col(url_col)
    judged = (pages.withColumn("host", host_of(url)).withColumn("path", path_of(url))
                   .withColumn("rule", rule_column(F.col("host"), F.col("path"), rules, "name"))
                   .withColumn("__verdict", rule_column(F.col("host"), F.col("path"), rules, "verdict"))
                   .withColumn("__canon", canonical(F.col("host"), F.col("path")))
                   .withColumn("__h", F.xxhash64("__canon"))
                   .withColumn("__may", F.col("__verdict").isNull() & (F.col("host") != "") & may(F.col("__h"))))
    # only possible hits carry a key; the rest pass the join unmatched, spread by their own hash
    judged = judged.withColumn("__key", F.when(F.col("__may"), F.col("__canon")))
    exact = keys.select(F.col("__canon").alias("__key"), F.lit(True).alias("__in"))
    hits = judged.filter("__may").join(exact, "__key", "left")
    rest = judged.filter(~F.col("__may")).withColumn("__in", F.lit(None).cast("boolean"))
    out = hits.select(*judged.columns, "__in").unionByName(rest)
    return (out.withColumn("listed", F.coalesce("__in", F.lit(False)))
               .withColumn("verdict", F.coalesce("__verdict", F.when(F.col("listed"), "block").otherwise("allow")))
               .drop("__verdict", "__canon", "__h", "__may", "__key", "__in"))

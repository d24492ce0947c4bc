"""Lineage cuts and small shared helpers of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


SMALL = 1 << 17          # rows of a narrow table that goes whole to the tasks of a join; a larger one is shuffled


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Only a session inside one
    process (``local[n]``) may leave it unset and gets a private one; executors of a
    cluster could not see that, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusflow-ckpt-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the
    lineage ends there, and the loss of an executor repeats nothing before it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def summed(df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, tuple]:
    """``stored`` with the number of rows, and the aggregates ``more``, taken while
    they are written: no job of its own reads the table again for them."""
    seen = Observation()
    aggs = [c.alias(f"v{i}") for i, c in enumerate((F.count(F.lit(1)), *more))]
    table = stored(df.observe(seen, *aggs), name)
    found = seen.get
    return table, tuple(found[f"v{i}"] for i in range(len(aggs)))


def looked_up(table: DataFrame, n: int) -> DataFrame:
    """``table``, of ``n`` rows of a few numbers, for a join: a small one is broadcast, so
    that the other side stays where it is."""
    return F.broadcast(table) if n <= SMALL else table


class Grown:
    """A table in the shared folder that rows are added to: it is one scan of ``n`` rows,
    however often something was added."""

    def __init__(self, spark: SparkSession, schema: str, name: str):
        self.spark, self.schema, self.name = spark, schema, name
        self.folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.parts: list[str] = []
        self.n = 0

    def add(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The rows added now, and their number."""
        seen = Observation()
        path = f"{self.folder}/{len(self.parts)}"
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(path)
        self.parts.append(path)
        n = seen.get["n"]
        self.n += n
        return self.spark.read.schema(self.schema).parquet(path), n

    def rows(self) -> DataFrame:
        if not self.parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*self.parts)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to write (case-insensitive, as
    Spark resolves names)."""
    taken = {n.lower() for n in names}
    return df.select([df[c] for c in df.columns if c.lower() not in taken])


def code_point_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def key_columns(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]

"""Extension points: a user's own row function (X1) and inline cases."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_rows(df: DataFrame, fn: Callable[[dict], Iterable[Mapping]], schema: T.StructType | str) -> DataFrame:
    """``fn`` takes a row as a dict and gives any number of rows.  It runs on Arrow
    batches in the tasks that hold the rows; prefer column expressions where they do."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = schema.names

    def run(batches):
        for pdf in batches:
            out = [[new.get(c) for c in names] for row in pdf.to_dict("records") for new in fn(row)]
            yield pd.DataFrame(out, columns=names, dtype=object)

    return df.mapInPandas(run, schema)


def check_cases(op: Callable[[DataFrame], DataFrame], cases: Sequence[Mapping], spark, schema: T.StructType | str,
                output_schema: T.StructType | str | None = None) -> None:
    """Each case has an ``input`` row and an ``output`` (a row, or null where the
    row is dropped); ``op`` has to give exactly the outputs, else AssertionError.  All
    cases run as one frame; ``op`` must keep the ``_case`` column."""
    given = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    numbered = T.StructType([T.StructField("_case", T.IntegerType()), *given.fields])
    df = spark.createDataFrame([(i, *[c["input"].get(f) for f in given.names]) for i, c in enumerate(cases)], numbered)
    got: dict[int, list[dict]] = {}
    for r in op(df).collect():
        row = r.asDict(recursive=True)
        got.setdefault(row.pop("_case"), []).append(row)
    for i, c in enumerate(cases):
        want = [] if c["output"] is None else [dict(c["output"])]
        if got.get(i, []) != want:
            raise AssertionError(f"case {i}: {c['input']} gave {got.get(i, [])}, not {want}")


def sub_caption_texts(segments: Column, params: Sequence[Mapping]) -> Column:
    """The regex replacements on the text of every caption of a caption file."""
    from corpusflow.functions.text import sub_regex

    return F.transform(segments, lambda s: s.withField("text", sub_regex(s["text"], params)))

"""Array columns (E1 and the per-row array edits)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_to_entries(df: DataFrame, field_with_list: str, output_field: str | None = None,
                    on_empty: str = "drop") -> DataFrame:
    """One row per list item.  Struct items are merged into the row and
    their fields override the row's; scalar items go to ``output_field``.
    The list column itself is removed.  An empty list drops the row
    (``on_empty="error"`` fails instead, as the rule does)."""
    dt = df.schema[field_with_list].dataType
    if not isinstance(dt, T.ArrayType):
        raise TypeError(f"{field_with_list} is not a list column")
    src = df
    if on_empty == "error":
        src = df.withColumn(field_with_list, F.when(F.size(field_with_list) == 0,
                                                    F.raise_error(F.lit(f"empty list in {field_with_list}")))
                            .otherwise(F.col(field_with_list)))
    item = "_item"
    exploded = src.withColumn(item, F.explode(field_with_list)).drop(field_with_list)
    if isinstance(dt.elementType, T.StructType):
        inner = [f.name for f in dt.elementType.fields]
        keep = [c for c in exploded.columns if c != item and c not in inner]
        return exploded.select(*keep, *[F.col(item)[n].alias(n) for n in inner])
    if not output_field:
        raise ValueError("output_field is required for lists of scalars")
    return exploded.withColumnRenamed(item, output_field)

"""Records as JSON text and as (key, type, value) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_json_record(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns))


def from_json_record(column: str | Column, schema: T.StructType | str) -> Column:
    return F.from_json(column, schema)


def unpivot_record(df: DataFrame, ids: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row (ids, key, type, value) per field of each record; values as text."""
    types = dict(df.dtypes)
    names = [c for c in (columns or df.columns) if c not in ids]
    fields = F.array(
        *[
            F.struct(F.lit(c).alias("key"), F.lit(types[c]).alias("type"), F.col(c).cast("string").alias("value"))
            for c in names
        ]
    )
    return df.select(*ids, F.inline(fields))

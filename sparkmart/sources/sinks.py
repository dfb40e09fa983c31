"""Writers: staging files, delimited text, format conversion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.text import escape_null
from sparkmart.sources.files import SEPARATORS, read_delimited, read_ndjson, read_parquet, separator_for

_QUOTING = {"quote": '"', "escape": '"', "quoteAll": True, "emptyValue": ""}


def write_staging(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> str:
    df.write.mode("overwrite").options(header=header, sep=sep, **_QUOTING).csv(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str | None = None, psv: str | None = None) -> str:
    """Delimited text that keeps NULL, the empty text and the text 'NULL' apart."""
    escaped = df.select([escape_null(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return write_csv(escaped, path, sep=sep or separator_for(path, psv))


def write_ndjson(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def _format_of(path: str) -> str:
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower()
    return {"json": "ndjson", "jsonl": "ndjson"}.get(ext, ext)


def convert(spark: SparkSession, source: str, target: str, schema=None) -> str:
    """Copy a table from one file format to another; the extensions say which."""
    kind = _format_of(source)
    readers: dict[str, Callable[[], DataFrame]] = {
        "parquet": lambda: read_parquet(spark, source),
        "ndjson": lambda: read_ndjson(spark, source, schema),
        **{ext: lambda: read_delimited(spark, source, schema) for ext in SEPARATORS},
    }
    df = readers[kind]()
    writers: dict[str, Callable[[], str]] = {
        "parquet": lambda: write_staging(df, target),
        "ndjson": lambda: write_ndjson(df, target),
        **{ext: lambda: write_delimited(df, target) for ext in SEPARATORS},
    }
    return writers[_format_of(target)]()

"""Readers for landed files."""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.text import unescape_null
from sparkmart.sources import records

# fixed values: field separator by file extension
SEPARATORS = {"csv": ",", "tsv": "\t", "ssv": ";"}
# quoted fields may hold doubled quotes
_QUOTING = {"quote": '"', "escape": '"'}


def _options(sep: str, header: bool, multi_line: bool) -> dict:
    return {"header": header, "sep": sep, "multiLine": multi_line, **_QUOTING}


def _names(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Column names of the header row; only the beginning of a file is read."""
    return spark.read.options(**_options(sep, True, True)).csv(path).columns


def _fields(spark: SparkSession, path: str, sep: str, schema: T.StructType, header: bool) -> DataFrame:
    """Columns of files with line breaks in quoted fields, by ``schema``."""
    found = records.records(spark, path, sep)
    rows = found.where("NOT first") if header else found
    # the records are cut already; the option only keeps line breaks as they are
    options = {k: str(v) for k, v in {"sep": sep, "multiLine": "true", **_QUOTING}.items()}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("value", ddl, options).alias("r")).select("r.*")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",",
             multi_line: bool = False) -> DataFrame:
    """CSV with a header row. Give the schema; without one the whole input is read twice to infer it.

    Quoted fields may hold line breaks; files are read in splits all the same, see :mod:`sparkmart.sources.records`.
    Before, one scan looks for lines with an odd number of quotes; ``multi_line`` leaves it out and reads each file in
    one task. That is for many small files.
    """
    options = _options(sep, True, multi_line)
    if multi_line or not records.may_have_breaks(spark, path):
        reader = spark.read.options(**options)
        return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
    if schema is None:
        strings = read_csv_strings(spark, path, sep)
        schema = _inferred(strings)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return _fields(spark, path, sep, schema, True)


def _inferred(strings: DataFrame) -> T.StructType:
    """The first type of long, double, timestamp and text that fits all texts of a column; blank ones fit every type."""
    kinds = ("bigint", "double", "timestamp")
    fits = [
        F.bool_and((F.col(f"`{c}`") == "") | F.expr(f"try_cast(`{c}` AS {kind})").isNotNull()).alias(f"{i}_{kind}")
        for i, c in enumerate(strings.columns) for kind in kinds
    ]
    found = strings.agg(*fits).first()
    types = [next((k for k in kinds if found[f"{i}_{k}"]), "string") for i in range(len(strings.columns))]
    return T.StructType([T.StructField(c, T.DataType.fromDDL(t)) for c, t in zip(strings.columns, types)])


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def read_csv_strings(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """CSV with a header row, every column text; an empty field is the empty text, not NULL."""
    if multi_line or not records.may_have_breaks(spark, path):
        raw = spark.read.options(**_options(sep, True, multi_line)).csv(path)
    else:
        names = _names(spark, path, sep)
        plain = _fields(spark, path, sep, _texts([f"c{i}" for i in range(len(names))]), True)
        raw = plain.toDF(*names)
    return raw.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])


def read_csv_raw(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """CSV as one array of texts per record; the header is a row like the others."""
    if multi_line or not records.may_have_breaks(spark, path):
        raw = spark.read.options(**_options(sep, False, multi_line)).csv(path)
    else:
        raw = _fields(spark, path, sep, _texts([f"c{i}" for i in range(len(_names(spark, path, sep)))]), False)
    return raw.select(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in raw.columns]).alias("fields"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array of objects. One file is one task; land big inputs as NDJSON."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON object per line; without a schema the columns are the union of the fields of all lines."""
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(path)


def separator_for(path: str, psv: str | None = None) -> str:
    ext = PurePath(path.rstrip("/")).suffix.lstrip(".").lower()
    if ext == "psv" and psv is not None:
        return psv
    if ext not in SEPARATORS:
        raise ValueError(f"no field separator known for {path!r}")
    return SEPARATORS[ext]


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str | None = None, psv: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text written by :func:`sparkmart.sources.sinks.write_delimited`.

    The separator follows the file extension. The literal NULL is a null and ``_NULL`` the text
    ``NULL``. With ``schema`` the columns are cast to it.
    """
    raw = read_csv_strings(spark, path, sep or separator_for(path, psv), multi_line)
    return restore_nulls(raw, schema)


def restore_nulls(raw: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    columns: list[Column] = []
    for name in raw.columns:
        value = unescape_null(F.col(f"`{name}`"))
        if schema is not None:
            value = value.cast(schema[name].dataType)
        columns.append(value.alias(name))
    return raw.select(columns)


def query_file(spark: SparkSession, path: str, args: dict | None = None) -> DataFrame:
    """Run the SQL query stored in a file, with named parameters, over the registered tables."""
    found = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{path!r} holds {'several SQL files' if found else 'no SQL file'}; one was expected")
    return spark.sql(found[0].value.strip().rstrip(";"), args=args or {})

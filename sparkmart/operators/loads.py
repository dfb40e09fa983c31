"""Load modes for catalog tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.quality import Rule, require
from sparkmart.sources.sinks import write_staging


@dataclass(frozen=True)
class LoadResult:
    table: str
    mode: str
    last_id: object | None


def replace_table(df: DataFrame, table: str) -> LoadResult:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return LoadResult(table, "replace", None)


def append_table(df: DataFrame, table: str) -> LoadResult:
    df.write.mode("append").format("parquet").saveAsTable(table)
    return LoadResult(table, "append", None)


def last_id(spark: SparkSession, table: str, key: str = "id"):
    """High watermark of a table; None when it is empty."""
    return spark.table(table).agg(F.max(key)).first()[0]


def extract(source: DataFrame, ingest_type: str, key: str, watermark) -> DataFrame:
    """The rows to load: all of them, or those above the watermark."""
    if ingest_type not in ("full", "incremental"):
        raise ValueError(f"unknown ingest type {ingest_type!r}")
    if ingest_type == "incremental" and watermark is not None:
        return source.filter(F.col(key) > F.lit(watermark))
    return source


def _watermark(spark: SparkSession, table: str, ingest_type: str, key: str):
    if ingest_type == "incremental" and spark.catalog.tableExists(table):
        return last_id(spark, table, key)
    return None


def load(source: DataFrame, table: str, ingest_type: str = "full", key: str = "id") -> LoadResult:
    """Full load replaces the table; an incremental one appends the rows above its highest key.

    An incremental load into an empty or missing table is a full one.
    """
    watermark = _watermark(source.sparkSession, table, ingest_type, key)
    rows = extract(source, ingest_type, key, watermark)
    done = append_table(rows, table) if watermark is not None else replace_table(rows, table)
    return LoadResult(table, done.mode, watermark)


def load_staged(source: DataFrame, table: str, staging_dir: str, ingest_type: str = "full", key: str = "id") -> LoadResult:
    """As :func:`load`, with the extracted rows first written to a named staging file."""
    spark = source.sparkSession
    watermark = _watermark(spark, table, ingest_type, key)
    name = f"staging_{table.split('.')[-1]}_{ingest_type}_{watermark}"
    path = write_staging(extract(source, ingest_type, key, watermark), f"{staging_dir}/{name}.parquet")
    staged = spark.read.parquet(path)
    done = append_table(staged, table) if watermark is not None else replace_table(staged, table)
    return LoadResult(table, done.mode, watermark)


def load_constrained(df: DataFrame, table: str, rules: list[Rule], checked: DataFrame | None = None) -> LoadResult:
    """Create the table if absent and append, after checking that no row breaks a rule.

    ``checked`` has the same rows, and the columns of the rules, where those are cheaper to read than ``df``.
    """
    require(df if checked is None else checked, rules)
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    return append_table(df.select(spark.table(table).columns), table)


def create_as(df: DataFrame, table: str) -> LoadResult:
    """Drop the table if it is there and create it from a query."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.format("parquet").saveAsTable(table)
    return LoadResult(table, "create", None)

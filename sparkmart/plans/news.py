"""News flows: cleaning, heading ETL and ELT, and the cleaned flat table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.text import strip_punctuation, upper_case
from sparkmart.operators.impute import handle_nulls
from sparkmart.operators.loads import LoadResult, create_as, load_constrained, replace_table
from sparkmart.operators.quality import Rule, drop_duplicates, validate
from sparkmart.operators.warehouse import Star, assign_keys, load_star_tables, star_extract
from sparkmart.runtime import materialize
from sparkmart.sources.files import read_csv, read_parquet
from sparkmart.sources.markup import headings
from sparkmart.sources.sinks import write_staging


def clean(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], threshold: float = 25.0) -> DataFrame:
    """Remove duplicates by key if there are full-row copies, then drop or fill the columns with nulls.

    The deduplicated table is written once, since several passes over its columns follow.
    """
    deduplicated = drop_duplicates(df, keys, order_by)
    if deduplicated is not df:
        deduplicated = materialize(deduplicated, "deduplicated")
    return handle_nulls(deduplicated, threshold, order_by)


def clean_and_validate(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], types: dict[str, str],
                       ranges: dict[str, tuple[float, float]], name: str, threshold: float = 25.0) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and its validation report; the report informs and does not stop the load."""
    cleaned = clean(df, keys, order_by, threshold)
    return cleaned, validate({name: cleaned}, types, ranges)


def load_news(spark: SparkSession, source: str, schema: str, staging: str, database: str) -> Star:
    """The whole flow: CSV to a staging file, cleaned, loaded into the star of a database.

    The rows need a ``seq`` column with their order of arrival.
    """
    write_staging(read_csv(spark, source, schema, multi_line=True), staging)  # texts hold line breaks
    cleaned = clean(read_parquet(spark, staging), ["url"], ["seq"])
    return load_star_tables(materialize(cleaned, "cleaned"), database)


def etl_headings(pages: DataFrame, table: str, tag: str, keep: Sequence[str] = ()) -> LoadResult:
    """Extract headings, transform them in flight, load the result."""
    titles = headings(pages, tag=tag, keep=keep)
    return replace_table(titles.withColumn("title", upper_case("title")), table)


def elt_headings(pages: DataFrame, raw_table: str, table: str, tag: str, keep: Sequence[str] = ()) -> LoadResult:
    """Load the raw headings first, then transform them with SQL inside the warehouse."""
    spark = pages.sparkSession
    replace_table(headings(pages, tag=tag, keep=keep), raw_table)
    columns = ", ".join([*keep, "upper(title) AS title"])
    return create_as(spark.sql(f"SELECT {columns} FROM {raw_table}"), table)


# fixed values: limits of the cleaned table
CLEANED_RULES = (
    Rule("title", max_length=255),
    Rule("category", max_length=100),
    Rule("publication_date"),
    Rule("url", max_length=255),
    Rule("summary"),
    Rule("processed_date"),
)


def cleaned_rows(star: Star, processed_at: Column | datetime | None = None, threshold: float = 25.0) -> DataFrame:
    """Star extract, cleaned, with punctuation removed and the processing time added.

    ``processed_at`` fixes the time for repeatable runs; it defaults to now.
    """
    extracted = materialize(star_extract(star), "extract")  # several passes follow
    cleaned = clean(extracted, ["url"], ["url", "publication_date", "category"], threshold)
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    return cleaned.select(
        strip_punctuation("title").alias("title"),
        "category",
        F.col("publication_date").cast("timestamp_ntz").alias("publication_date"),
        "url",
        strip_punctuation("summary").alias("summary"),
        stamp.cast("timestamp_ntz").alias("processed_date"),
    )


def load_cleaned(rows: DataFrame, table: str, on_rerun: str = "skip_existing") -> LoadResult:
    """Number the rows and append them to the cleaned table, after checking its constraints.

    On a rerun ``skip_existing`` leaves urls alone that are loaded already, ``append`` adds them again.
    """
    if on_rerun not in ("append", "skip_existing"):
        raise ValueError(f"unknown rerun mode {on_rerun!r}")
    spark: SparkSession = rows.sparkSession
    highest = 0
    if spark.catalog.tableExists(table):
        loaded = spark.table(table)
        highest = loaded.agg(F.max("cleaned_id")).first()[0] or 0
        if on_rerun == "skip_existing":
            # the urls alone are compared, and written, so that Spark knows how few they are
            absent = rows.select(F.col("url").alias("__url")).distinct().join(loaded, F.col("__url") == loaded["url"], "left_anti")
            absent = materialize(absent, "absent-urls")
            rows = materialize(rows.join(absent, F.col("url").eqNullSafe(F.col("__url")), "left_semi"), "absent")
    numbered = assign_keys(rows, None, "cleaned_id", ["url", "publication_date", "category"], wide=True)
    shifted = numbered.withColumn("cleaned_id", F.col("cleaned_id") + highest)
    return load_constrained(shifted, table, list(CLEANED_RULES), checked=rows)

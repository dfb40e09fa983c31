"""Tables out of landed web pages, JSON documents, workbooks and block reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the entities decoded in extracted texts, the ampersand last
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

# fixed values: layout of the review report
REPORT_RULE = "-" * 50
REPORT_FIELDS = {"title": "Judul", "status": "Status", "note": "Catatan"}
REPORT_PASS, REPORT_FAIL = "LULUS", "TIDAK LULUS"


def element_texts(html: Column, tag: str) -> Column:
    """Array with the text of every ``tag`` element: inner tags removed, entities decoded."""
    inner = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1))
    return F.transform(inner, _plain_text)


def _plain_text(markup: Column) -> Column:
    text = F.regexp_replace(markup, r"(?s)<!--.*?-->|<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def headings(pages: DataFrame, html: str = "html", tag: str = "h2", keep: Sequence[str] = ()) -> DataFrame:
    """One row per heading of each page, in column ``title``."""
    return pages.select(*keep, F.explode(element_texts(F.col(html), tag)).alias("title"))


def flatten_json(df: DataFrame, column: str, schema: T.StructType | str, paths: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text column and select nested ``paths`` as flat columns (name -> path)."""
    parsed = df.select(*keep, F.from_json(column, schema).alias("doc"))
    return parsed.select(*keep, *[F.col(f"doc.{path}").alias(name) for name, path in paths.items()])


def explode_json(df: DataFrame, column: str, schema: T.StructType | str, items: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array ``items`` inside a JSON text column; element fields become columns."""
    parsed = df.select(*keep, F.explode(F.from_json(column, schema)[items]).alias("item"))
    return parsed.select(*keep, "item.*")


def read_workbook(spark: SparkSession, path: str, tables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Tables of JSON files shaped ``{name: {columns: [...], rows: [...]}}``, one document per file.

    Rows are arrays in column order or objects. A multi-table document has ``names`` and holds its
    tables under ``tables``. All values come as text.
    """
    documents = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("doc"))
    body = F.coalesce(F.try_variant_get("doc", "$.tables", "variant"), F.col("doc"))
    entries = documents.select(body.alias("body")).selectExpr(
        "explode(map_entries(CAST(body AS MAP<STRING, VARIANT>))) AS entry"
    )
    sheets = entries.selectExpr(
        "entry.key AS name",
        "try_variant_get(entry.value, '$.columns', 'array<string>') AS columns",
        "try_variant_get(entry.value, '$.rows', 'array<variant>') AS rows",
    )
    broken = sheets.filter("columns IS NULL OR rows IS NULL").select("name").first()
    if broken is not None:
        raise ValueError(f"table {broken['name']!r} has no columns or no rows")
    wanted = set(tables) if tables is not None else None
    found = sheets.groupBy("name").agg(F.min("columns").alias("first"), F.collect_set("columns").alias("all"))
    headers = {
        row["name"]: list(dict.fromkeys([*row["first"], *(c for columns in sorted(row["all"]) for c in columns)]))
        for row in found.collect()  # one row per table, with its different headers
        if wanted is None or row["name"] in wanted
    }
    out = {}
    for name, columns in headers.items():
        rows = sheets.filter(F.col("name") == name).selectExpr("columns", "posexplode(rows) AS (__pos, cell)")
        cells = rows.select("columns", "cell", F.try_variant_get("cell", "$", "array<string>").alias("cells"))
        out[name] = cells.select(*[_workbook_cell(column).alias(column) for column in columns])
    return out


def _workbook_cell(column: str) -> Column:
    """The cell of a row under ``column``, by the header of the row's own file."""
    by_position = F.get("cells", (F.array_position("columns", column) - 1).cast("int"))
    by_name = F.try_variant_get("cell", f"$['{column}']", "string")
    return F.coalesce(by_position, by_name)


def read_block_report(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(section, title, status, note, passed)`` of a review report cut by 50-dash lines."""
    return parse_blocks(spark.read.text(path, lineSep=REPORT_RULE + "\n"), "value")


def parse_blocks(blocks: DataFrame, column: str) -> DataFrame:
    """Fields of report blocks held in a text column."""
    text = F.col(column)
    section = F.regexp_extract(text, r"(?m)^Section (\d+):", 1)
    title = F.regexp_extract(text, rf"(?m)^{REPORT_FIELDS['title']}:[ \t]*(.*)$", 1)
    status = F.regexp_extract(text, rf"(?m)^{REPORT_FIELDS['status']}:[ \t]*(.*)$", 1)
    note = F.regexp_extract(text, rf"(?s)\n{REPORT_FIELDS['note']}:[ \t]*(.*?)\s*(?:-+\s*)?$", 1)
    return (
        blocks.select(section.alias("section"), title.alias("title"), status.alias("raw_status"), note.alias("note"))
        .filter(F.col("section") != "")
        .select(
            F.col("section").cast("int").alias("section"),
            F.trim("title").alias("title"),
            F.when(F.col("raw_status").startswith(REPORT_FAIL), REPORT_FAIL)
            .when(F.col("raw_status").startswith(REPORT_PASS), REPORT_PASS)
            .alias("status"),
            "note",
        )
        .withColumn("passed", F.col("status") == REPORT_PASS)
    )

"""Sources and sinks: every query writes a given table in some format and reads it back."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.queries.registry import query, table
from sparkmart.runtime import scratch_path
from sparkmart.sources import files, markup, sinks


@query("src_csv", "SELECT * FROM part")
def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = sinks.write_csv(part, scratch_path(spark, "csv"))
    return files.read_csv(spark, path, part.schema)


@query(
    "src_csv_strings",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def src_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_csv_strings(spark, sinks.write_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "csv")))


@query(
    "src_csv_raw",
    """
    SELECT 's_suppkey|s_name|s_nationkey|s_acctbal' AS line, 4 AS fields
    UNION ALL
    SELECT concat_ws('|', s_suppkey, s_name, s_nationkey, s_acctbal), 4 FROM supplier, (SELECT unnest([1, 2]))
    """,
)
def src_csv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with every supplier twice; its header is a row like the others, and repeated lines stay."""
    supplier = table(spark, sf_dir, "supplier")
    path = sinks.write_csv(supplier.unionAll(supplier).coalesce(1), scratch_path(spark, "csv"))
    raw = files.read_csv_raw(spark, path)
    return raw.select(F.array_join("fields", "|").alias("line"), F.size("fields").alias("fields"))


def _json_documents(df: DataFrame, key: str, rows_per_file: int) -> DataFrame:
    """Rows (bucket, JSON array text) with at most ``rows_per_file`` objects each."""
    bucket = F.floor(F.col(key) / rows_per_file).alias("bucket")
    return df.groupBy(bucket).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))


@query("src_json_array", "SELECT * FROM customer")
def src_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "json")
    _json_documents(customer, "c_custkey", 5000).write.partitionBy("bucket").text(path)
    return files.read_json_array(spark, path, customer.schema).select(customer.columns)


@query(
    "src_json_nested",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS kind
    FROM events
    """,
)
def src_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    body = F.struct(F.from_json("props", "k long").alias("props"), F.struct(F.col("event_type").alias("kind")).alias("meta"))
    landed = events.select("event_id", F.to_json(body).alias("document"))
    schema = "props struct<k: long>, meta struct<kind: string>"
    return markup.flatten_json(landed, "document", schema, {"k": "props.k", "kind": "meta.kind"}, ["event_id"])


@query("src_json_items", "SELECT conv_id, turn, role, text FROM conversations")
def src_json_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    item = F.struct("turn", "role", "text")
    landed = turns.select("conv_id", F.to_json(F.struct(F.array(item).alias("items"))).alias("document"))
    schema = "items array<struct<turn: long, role: string, text: string>>"
    return markup.explode_json(landed, "document", schema, "items", ["conv_id"])


@query(
    "src_sql_file",
    """
    SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders WHERE o_totalprice >= 1000 GROUP BY o_orderpriority
    """,
)
def src_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_source")
    text = (Path(__file__).parent / "sql" / "priority_totals.sql").read_text()
    path = scratch_path(spark, "sql")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return files.query_file(spark, path, {"min_price": 1000.0})


HEADING_SQL = r"""
    SELECT page_id,
           replace(replace(replace(replace(replace(replace(
             regexp_replace(unnest(regexp_extract_all(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1)),
                            '(?s)<!--.*?-->|<[^>]*>', '', 'g'),
             '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS title
    FROM pages
"""


@query("src_html_headings", HEADING_SQL)
def src_html_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.headings(table(spark, sf_dir, "pages"), tag="h1", keep=["page_id"])


@query(
    "src_ndjson",
    """
    SELECT CAST(NULL AS BIGINT) AS conv_id, event_id, event_type, props, CAST(NULL AS VARCHAR) AS role, CAST(NULL AS VARCHAR) AS text,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, CAST(NULL AS BIGINT) AS turn, user_id, value
    FROM events
    UNION ALL
    SELECT conv_id, NULL, NULL, NULL, role, text, NULL, turn, NULL, NULL FROM conversations
    """,
)
def src_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of lines in one folder; the columns are the union of their fields."""
    path = scratch_path(spark, "ndjson")
    events = table(spark, sf_dir, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    sinks.write_ndjson(events, f"{path}/kind=a")
    sinks.write_ndjson(table(spark, sf_dir, "conversations"), f"{path}/kind=b")
    return files.read_ndjson(spark, path).drop("kind")


@query(
    "src_delimited",
    """
    SELECT 'tsv' AS kind, * FROM part UNION ALL SELECT 'ssv', * FROM part
    UNION ALL SELECT 'psv', * FROM part UNION ALL SELECT 'csv', * FROM part
    """,
)
def src_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    out = None
    for kind in ("tsv", "ssv", "psv", "csv"):
        path = sinks.write_delimited(part, f"{scratch_path(spark, 'text')}.{kind}", psv="|")
        back = files.read_delimited(spark, path, part.schema, psv="|").select(F.lit(kind).alias("kind"), "*")
        out = back if out is None else out.unionByName(back)
    return out


_NULL_VIEW = """
    SELECT event_id,
           CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'NULL' WHEN 2 THEN '_NULL' WHEN 3 THEN '' ELSE event_type END
             AS label,
           CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value
    FROM {events}
"""


@query("src_null_literal", _NULL_VIEW.format(events="events"))
def src_null_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(_NULL_VIEW, events=table(spark, sf_dir, "events"))
    path = sinks.write_delimited(df, f"{scratch_path(spark, 'nulls')}.csv")
    return files.read_delimited(spark, path, df.schema)


@query(
    "src_workbook",
    """
    SELECT 'suppliers' AS sheet, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier
    UNION ALL SELECT 'parts', CAST(p_partkey AS VARCHAR), p_name FROM part
    """,
)
def src_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook documents of bounded size; suppliers as arrays, parts as objects."""
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    path = scratch_path(spark, "workbook")
    per_file = 5000
    rows = {
        "suppliers": (supplier, "s_suppkey", F.array(F.col("s_suppkey").cast("string"), "s_name"), "s"),
        "parts": (part, "p_partkey", F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), "p"),
    }
    for sheet, (df, key, row, prefix) in rows.items():
        bucket = F.concat(F.lit(prefix), F.floor(F.col(key) / per_file).cast("string")).alias("bucket")
        body = F.struct(F.array(F.lit("id"), F.lit("name")).alias("columns"), F.collect_list(row).alias("rows"))
        document = F.to_json(F.struct(F.struct(body.alias(sheet)).alias("tables"), F.array(F.lit(sheet)).alias("names")))
        df.groupBy(bucket).agg(document.alias("value")).write.mode("append").partitionBy("bucket").text(path)
    sheets = markup.read_workbook(spark, path)
    out = [df.select(F.lit(name).alias("sheet"), "id", "name") for name, df in sorted(sheets.items())]
    return out[0].unionByName(out[1])


@query(
    "src_block_report",
    """
    SELECT CAST(doc_id AS INTEGER) AS section, concat('Document ', doc_id) AS title,
           CASE WHEN quality = 1 THEN 'LULUS' ELSE 'TIDAK LULUS' END AS status,
           concat('toxic=', toxic, chr(10), chr(10), 'second line') AS note, quality = 1 AS passed
    FROM labels
    """,
)
def src_block_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = markup.REPORT_FIELDS
    status = F.when(F.col("quality") == 1, markup.REPORT_PASS).otherwise(markup.REPORT_FAIL + " [CATATAN] see note")
    block = F.concat(
        F.lit("Section "), "doc_id", F.lit(f":\n{f['title']}: Document "), "doc_id", F.lit(f"\n{f['status']}: "), status,
        F.lit(f"\n{f['note']}: toxic="), "toxic", F.lit(f"\n\nsecond line\n{markup.REPORT_RULE}"),
    )
    path = scratch_path(spark, "report")
    table(spark, sf_dir, "labels").select(block.alias("value")).write.text(path)
    return markup.read_block_report(spark, path)


@query("sink_convert", "SELECT * FROM part")
def sink_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parquet -> csv -> ndjson -> tsv -> ssv -> parquet."""
    part = table(spark, sf_dir, "part")
    at, base = f"{sf_dir}/part.parquet", scratch_path(spark, "convert")
    for i, ext in enumerate(("csv", "ndjson", "tsv", "ssv", "parquet")):
        at = sinks.convert(spark, at, f"{base}/{i}.{ext}", part.schema)
    return files.read_parquet(spark, at)


@query("sink_convert_texts", "SELECT * FROM documents")
def sink_convert_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks through comma, tab and semicolon files and back."""
    documents = table(spark, sf_dir, "documents")
    at, base = f"{sf_dir}/documents.parquet", scratch_path(spark, "convert")
    for i, ext in enumerate(("csv", "tsv", "ssv", "parquet")):
        at = sinks.convert(spark, at, f"{base}/{i}.{ext}", documents.schema)
    return files.read_parquet(spark, at)


@query("src_csv_line_breaks", "SELECT * FROM conversations")
def src_csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns and texts with line breaks from CSV that is read in splits."""
    turns = table(spark, sf_dir, "conversations")
    return files.read_csv(spark, sinks.write_csv(turns, scratch_path(spark, "csv")), turns.schema)

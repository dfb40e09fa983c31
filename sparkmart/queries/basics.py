"""Sales mart, models, scalar functions, unions and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import records, temporal, text
from sparkmart.plans import sales
from sparkmart.plans.extract_load import param_query as run_param_query
from sparkmart.plans.extract_load import user_step as run_user_step
from sparkmart.plans.models import Model, Project
from sparkmart.queries import fixtures as fx
from sparkmart.queries.registry import query, table
from sparkmart.runtime import scratch_database

# the sales fact: every order line beside its header, whose key is null where there is no header
_LINES = "FROM orderdetails AS line LEFT JOIN sales_orders AS header ON header.order_number = line.order_number"
_FACT = f"SELECT header.*, line.* EXCLUDE (order_number) {_LINES}"


@query(
    "sales_mart",
    f"""
    WITH {fx.SALES_CTES}
    SELECT {', '.join(sales.MART_COLUMNS)} FROM (
      SELECT *, price_each * quantity_ordered AS total_sales,
             (SELECT c.customer_name FROM customers c WHERE c.customer_number = fact.customer_number) AS customer_name,
             (SELECT p.product_name FROM products p WHERE p.product_code = fact.product_code) AS product_name
      FROM ({_FACT}) AS fact)
    """,
)
def sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = sales.sales_project().plan(fx.sales_sources(spark, sf_dir), ["view_customer_product_sales"])
    return plan["view_customer_product_sales"]


@query("fact_sales", f"WITH {fx.SALES_CTES} {_FACT}")
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.sales_sources(spark, sf_dir)
    return sales.fact_sales(s["orderdetails"], s["orders"])


@query("dim_customers", f"WITH {fx.SALES_CTES} SELECT * FROM customers")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.dimension(fx.sales_sources(spark, sf_dir)["customers"])


@query("dim_products", f"WITH {fx.SALES_CTES} SELECT * FROM products")
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.dimension(fx.sales_sources(spark, sf_dir)["products"])


def example_project() -> Project:
    """Two small models: ids with nulls among them, and the ids equal to 1."""
    project = Project(folder_defaults={"example": "view"})
    tests = (("id", "unique"), ("id", "not_null"))
    project.add(
        Model("first", lambda ids, gaps: ids.select(F.col("p_size").alias("id")).unionByName(
            gaps.select(F.lit(None).cast("int").alias("id"))),
            sources=("ids", "gaps"), materialized="table", folder="example", tests=tests)
    )
    project.add(Model("second", lambda first: first.filter("id = 1"), refs=("first",), folder="example", tests=tests))
    return project


_FIRST = "SELECT p_size AS id FROM part UNION ALL SELECT CAST(NULL AS INTEGER) FROM supplier"


def _example_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"ids": table(spark, sf_dir, "part"), "gaps": table(spark, sf_dir, "supplier")}


@query("model_union", _FIRST)
def model_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return example_project().plan(_example_sources(spark, sf_dir), ["first"])["first"]


@query("model_filter", f"SELECT id FROM ({_FIRST}) f WHERE id = 1")
def model_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return example_project().plan(_example_sources(spark, sf_dir))["second"]


@query(
    "model_materialize",
    f"""
    WITH f AS ({_FIRST}),
    t AS (SELECT 'first' AS model, * FROM f UNION ALL SELECT 'second', id FROM f WHERE id = 1)
    SELECT model, CASE model WHEN 'first' THEN 'MANAGED' ELSE 'TEMPORARY' END AS kind, count(*) AS row_count
    FROM t GROUP BY model
    """,
)
def model_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first model becomes a table, the second a view; both are counted through the catalog."""
    database = scratch_database(spark)
    project = example_project()
    project.run(spark, _example_sources(spark, sf_dir), database)
    out = None
    for name in ("first", "second"):
        relation = f"{database}.{name}" if project.materialization(name) == "table" else name
        kind = spark.catalog.getTable(relation).tableType
        line = spark.table(relation).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), F.lit(kind).alias("kind"), "row_count"
        )
        out = line if out is None else out.unionByName(line)
    return out


@query(
    "model_graph",
    """
    SELECT 'dim_customers' AS model, 'customer_number' AS column_name, 'unique' AS test,
           count(*) - count(DISTINCT c_custkey) AS violations FROM customer
    UNION ALL SELECT 'dim_customers', 'customer_number', 'not_null', count(*) - count(c_custkey) FROM customer
    UNION ALL SELECT 'dim_products', 'product_code', 'unique', count(*) - count(DISTINCT p_partkey) FROM part
    UNION ALL SELECT 'dim_products', 'product_code', 'not_null', count(*) - count(p_partkey) FROM part
    """,
)
def model_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the sales models in dependency order and report their column tests."""
    project = sales.sales_project()
    built = project.run(spark, fx.sales_sources(spark, sf_dir), scratch_database(spark))
    return project.test(built)


@query("limit_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten rows by key; the limit is what is asked for."""
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(10)


@query(
    "param_query",
    """
    SELECT o_orderpriority, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_totalprice > 50000 GROUP BY o_orderpriority
    """,
)
def param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_source")
    text_ = """
        SELECT o_orderpriority, count(*) AS n FROM IDENTIFIER(:source)
        WHERE o_orderdate >= CAST(:start AS TIMESTAMP_NTZ) AND o_totalprice > :min_price GROUP BY o_orderpriority
    """
    defaults = {"source": "orders_source", "start": "1995-01-01", "min_price": 50000.0}
    return run_param_query(spark, text_, defaults, {"start": "1997-01-01"})


_TYPES = {"c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@query(
    "unpivot_kv",
    " UNION ALL ".join(
        f"SELECT c_custkey, '{c}' AS key, '{t}' AS type, CAST({c} AS VARCHAR) AS value FROM customer" for c, t in _TYPES.items()
    ),
)
def unpivot_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.unpivot_record(table(spark, sf_dir, "customer"), ["c_custkey"])


@query(
    "strip_punct",
    r"""
    SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_\s\p{Z}\x{1c}-\x{1f}\x{85}]', '', 'g') AS text FROM documents
    """,
)
def strip_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_punctuation("text").alias("text"))


@query(
    "split_tags",
    f"""
    SELECT seq, trim(tag) AS tag FROM (SELECT seq, unnest(string_split(tags, ',')) AS tag FROM ({fx.NEWS_SQL}) n) t
    WHERE trim(tag) <> ''
    """,
)
def split_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.news(spark, sf_dir).select("seq", F.explode(text.split_list("tags")).alias("tag"))


@query(
    "key_text",
    """
    SELECT c_custkey, concat_ws(' // ', lower(c_mktsegment),
           CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN '' ELSE lower(c_name) END) AS key_text
    FROM customer
    """,
)
def key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 5 == 0, "null").when(F.col("c_custkey") % 5 == 1, None).otherwise(
        F.concat(F.lit("  "), "c_name")
    )
    return customer.select(
        "c_custkey", text.key_text([F.col("c_mktsegment"), name], ignore_whitespace=True, ignore_case=True).alias("key_text")
    )


_DATE_TEXTS = """
    SELECT o_orderkey,
           CASE o_orderkey % 6 WHEN 0 THEN {f1} WHEN 1 THEN {f2} WHEN 2 THEN {f3} WHEN 3 THEN {f4}
                WHEN 4 THEN 'soon' ELSE NULL END AS shown
    FROM {orders}
"""


@query(
    "parse_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 2, 3) THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders
    """,
)
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = [f"date_format(o_orderdate, '{p}')" for p in ("dd-MM-yyyy", "d/M/yyyy", "yyyy-MM-dd", "d MMM yyyy")]
    df = spark.sql(
        _DATE_TEXTS.format(f1=f[0], f2=f[1], f3=f[2], f4=f[3], orders="{orders}"), orders=table(spark, sf_dir, "orders")
    )
    return df.select("o_orderkey", temporal.parse_day_first("shown").alias("parsed"))


@query(
    "coerce_dates",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate END AS updated_at, CAST(o_orderdate AS VARCHAR) AS note
    FROM orders
    """,
)
def coerce_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the text column with 'date' in its name is read as a time."""
    orders = table(spark, sf_dir, "orders")
    shown = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "d/M/yyyy"))
        .otherwise("n/a")
    )
    return temporal.coerce_dates(
        orders.select("o_orderkey", shown.alias("updated_at"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("note"))
    )


@query(
    "tz_shift",
    "SELECT event_id, strftime(ts + INTERVAL 7 HOUR - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS shown FROM events",
)
def tz_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", temporal.shift_zone_minus_day(F.col("ts")).alias("shown"))


@query("ts_minus_day", "SELECT event_id, date_trunc('second', ts) - INTERVAL 1 DAY AS earlier FROM events")
def ts_minus_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    fmt = "yyyyMMdd'T'HHmmss"
    shown = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", fmt).alias("shown"))
    return shown.select("event_id", temporal.parse_minus_day("shown", fmt).cast("timestamp_ntz").alias("earlier"))


@query(
    "json_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer",
)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal"))
    )
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    written = customer.select(records.to_json_record(columns).alias("body"))
    schema = customer.select(columns).schema
    return written.select(records.from_json_record("body", schema).alias("r")).select("r.*")


def _raise_price(df: DataFrame, factor: float, label: str = "none") -> DataFrame:
    return df.select("p_partkey", F.round(F.col("p_retailprice") * factor, 2).alias("price"), F.lit(label).alias("label"))


@query("user_step", "SELECT p_partkey, round(p_retailprice * 2.5, 2) AS price, 'raised' AS label FROM part")
def user_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_user_step(table(spark, sf_dir, "part"), _raise_price, 2.5, label="raised")

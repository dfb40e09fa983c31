"""Load modes and table changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import changes, loads
from sparkmart.operators.quality import Rule
from sparkmart.plans.extract_load import extract_load, specs_from
from sparkmart.queries.registry import query, table
from sparkmart.runtime import scratch_database, scratch_path


@query("load_replace", "SELECT * FROM orders")
def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = f"{scratch_database(spark)}.orders"
    loads.replace_table(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), target)
    loads.replace_table(orders, target)
    return spark.table(target)


@query(
    "load_append",
    """
    SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier
    """,
)
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{scratch_database(spark)}.parties"
    for name, key, kind in (("customer", "c", "customer"), ("supplier", "s", "supplier")):
        id_column = "c_custkey" if key == "c" else "s_suppkey"
        rows = table(spark, sf_dir, name).select(
            F.col(id_column).alias("id"), F.col(f"{key}_name").alias("name"), F.lit(kind).alias("kind")
        )
        loads.append_table(rows, target)
    return spark.table(target)


_INCREMENTAL_SQL = """
    SELECT *, CASE WHEN event_id <= (SELECT max(event_id) // 2 FROM events) THEN 'first' ELSE 'second' END AS run
    FROM events
"""


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The state of the source at two moments: first its older half, then everything."""
    events = table(spark, sf_dir, "events")
    middle = events.agg(F.expr("max(event_id) div 2")).first()[0]
    first = events.filter(F.col("event_id") <= middle).withColumn("run", F.lit("first"))
    return first, events.withColumn("run", F.lit("second"))


@query("load_incremental", _INCREMENTAL_SQL)
def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{scratch_database(spark)}.events"
    for source in _two_runs(spark, sf_dir):
        loads.load(source, target, "incremental", "event_id")
    return spark.table(target)


@query("load_staged", _INCREMENTAL_SQL)
def load_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staging = f"{scratch_database(spark)}.events", scratch_path(spark, "staging")
    for source in _two_runs(spark, sf_dir):
        loads.load_staged(source, target, staging, "incremental", "event_id")
    return spark.table(target)


@query("load_incremental_empty", "SELECT *, 'second' AS run FROM events")
def load_incremental_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target exists but is empty, so the incremental load takes everything."""
    target = f"{scratch_database(spark)}.events"
    _, everything = _two_runs(spark, sf_dir)
    loads.replace_table(everything.limit(0), target)
    loads.load(everything, target, "incremental", "event_id")
    return spark.table(target)


@query("load_constrained", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def load_constrained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates the table, then appends to it; both loads pass the checks."""
    customer = table(spark, sf_dir, "customer")
    target = f"{scratch_database(spark)}.customer"
    rules = [Rule("c_custkey"), Rule("c_name", max_length=255), Rule("c_mktsegment", max_length=100)]
    for _ in range(2):
        loads.load_constrained(customer, target, rules)
    return spark.table(target)


@query("elt_uppercase", "SELECT p_partkey, upper(p_name) AS p_name FROM part")
def elt_uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    loads.replace_table(table(spark, sf_dir, "part").select("p_partkey", "p_name"), f"{database}.raw_part")
    upper = spark.sql(f"SELECT p_partkey, upper(p_name) AS p_name FROM {database}.raw_part")
    for _ in range(2):
        loads.create_as(upper, f"{database}.part")
    return spark.table(f"{database}.part")


_CHANGES = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           o_orderpriority, o_totalprice
    FROM {orders}
"""


@query(
    "apply_changes",
    f"""
    WITH t AS ({_CHANGES.format(orders='orders')})
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'F' OR (o_orderstatus IS NULL AND o_orderpriority = '5-LOW')
                THEN -1.0 ELSE o_totalprice END AS o_totalprice
    FROM t WHERE NOT (o_orderstatus IS NULL AND o_orderpriority = '1-URGENT')
    UNION ALL
    SELECT o_orderkey + 100000000, 'N', o_orderpriority, o_totalprice FROM t WHERE o_orderpriority = '2-HIGH'
    """,
)
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.sql(_CHANGES, orders=table(spark, sf_dir, "orders"))
    conditions = ["o_orderstatus", "o_orderpriority"]
    pairs = orders.select(conditions).distinct()
    return changes.apply_changes(
        orders,
        conditions,
        updates=pairs.filter("o_orderstatus = 'F' OR (o_orderstatus IS NULL AND o_orderpriority = '5-LOW')").withColumn(
            "o_totalprice", F.lit(-1.0)
        ),
        deletes=pairs.filter("o_orderstatus IS NULL AND o_orderpriority = '1-URGENT'"),
        inserts=orders.filter("o_orderpriority = '2-HIGH'").withColumns(
            {"o_orderkey": F.col("o_orderkey") + 100000000, "o_orderstatus": F.lit("N")}
        ),
    )


@query(
    "alter_columns",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_acctbal, CAST(NULL AS VARCHAR) AS c_tier, c_name AS customer_name,
           CAST(c_nationkey AS BIGINT) AS c_nationkey
    FROM customer
    """,
)
def alter_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename, retype, add, drop and reorder; the new version replaces the old table."""
    database = scratch_database(spark)
    loads.replace_table(table(spark, sf_dir, "customer"), f"{database}.customer")
    spec = changes.ColumnSpec
    altered = changes.alter_columns(
        spark.table(f"{database}.customer"),
        [
            spec("customer_id", "c_custkey", "string"),
            spec("c_acctbal", "c_acctbal"),
            spec("c_tier", None, "string"),
            spec("customer_name", "c_name"),
            spec("c_nationkey", "c_nationkey", "bigint"),
        ],
    )
    changes.swap_table(altered, f"{database}.customer")
    return spark.table(f"{database}.customer")


@query("move_columns", "SELECT p_type, p_partkey, p_size FROM part")
def move_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.move_columns(table(spark, sf_dir, "part"), [1, -1, -1, 0, 2, -1])


@query(
    "trim_blank",
    """
    SELECT s_suppkey AS pos, s_name AS c0, CAST(s_acctbal AS VARCHAR) AS c1, CASE WHEN s_suppkey > 2 THEN 'late' END AS c2
    FROM supplier WHERE s_suppkey <= (SELECT max(s_suppkey) - 4 FROM supplier)
    """,
)
def trim_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    last = supplier.agg(F.max("s_suppkey")).first()[0]
    filled = F.col("s_suppkey") <= last - 4
    grid = supplier.select(
        F.col("s_suppkey").alias("pos"),
        F.when(filled, F.col("s_name")).alias("c0"),
        F.when(filled, F.col("s_acctbal").cast("string")).otherwise("").alias("c1"),
        F.when(filled & (F.col("s_suppkey") > 2), "late").alias("c2"),
        F.lit("").alias("c3"),
    )
    return changes.trim_blank(grid, "pos")


@query(
    "el_tables",
    """
    SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'customer', count(*) FROM customer
    UNION ALL SELECT 'part', count(*) FROM part
    """,
)
def el_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = specs_from(
        """
        - orders
        - {name: lineitem, ingest_type: incremental, key: l_orderkey}
        - {name: customer, columns: [c_custkey, c_name]}
        - part
        """
    )
    return extract_load(spark, specs, lambda name: table(spark, sf_dir, name), scratch_database(spark))

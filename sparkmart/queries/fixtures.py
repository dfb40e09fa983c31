"""Views over the given tables that stand in for the inputs of the flows, in Spark and in DuckDB SQL.

Nulls, repeated rows and changed values are put in by key, since the given tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.queries.registry import table

# ---- news -------------------------------------------------------------------------------------
# fixed values: the column names of the news input

_NEWS_COLUMNS = """
    doc_id AS seq,
    concat(source, ' no. ', doc_id, ' (', lang, ')') AS title,
    CASE WHEN doc_id % 29 = 0 THEN NULL ELSE text END AS description,
    concat('https://example.org/', source, '/', md5(text)) AS url,
    CASE WHEN doc_id % 23 = 0 THEN NULL ELSE lang END AS category,
    CASE WHEN doc_id % 31 = 0 THEN NULL ELSE source END AS source_category,
    CASE WHEN doc_id % 13 = 0 THEN NULL
         ELSE concat(lang, ', ', source, ' ,,', CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END) END AS tags,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 37 = 0 THEN 'n/a'
         ELSE {day} END AS updated,
    CASE WHEN doc_id % 2 = 0 THEN 'Yes' WHEN doc_id % 3 = 0 THEN NULL ELSE 'No' END AS live,
    doc_id % 3 = 0 AS in_pagination
"""

NEWS_SQL = "SELECT" + _NEWS_COLUMNS.format(
    day="strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%d-%m-%Y')"
) + "FROM documents"


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "date_format(date_add(DATE'2024-01-01', CAST(doc_id % 365 AS INT)), 'dd-MM-yyyy')"
    docs = table(spark, sf_dir, "documents")
    return spark.sql("SELECT" + _NEWS_COLUMNS.format(day=day) + "FROM {docs}", docs=docs)


# ---- orders with gaps -------------------------------------------------------------------------

_DQ_ORDERS = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM {orders}
"""
DQ_ORDERS_SQL = f"""
    SELECT * FROM ({_DQ_ORDERS.format(orders='orders')}) x
    UNION ALL
    SELECT * FROM ({_DQ_ORDERS.format(orders='orders')}) y WHERE o_orderkey % 50 = 0
"""


def dq_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nulls in four columns, and every key divisible by 50 twice."""
    base = spark.sql(_DQ_ORDERS, orders=table(spark, sf_dir, "orders"))
    return base.unionAll(base.filter("o_orderkey % 50 = 0"))


# ---- sales ------------------------------------------------------------------------------------
# fixed values: the column names of the sales inputs

_ORDERDETAILS = """
    SELECT CASE WHEN l_orderkey % 97 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END AS order_number,
           l_partkey AS product_code, l_quantity AS quantity_ordered, l_extendedprice AS price_each,
           l_linenumber AS order_line_number
    FROM {lineitem}
"""
_SALES_ORDERS = """
    SELECT o_orderkey AS order_number, o_orderdate AS order_date, o_orderstatus AS status,
           o_orderpriority AS comments, o_custkey AS customer_number
    FROM {orders}
"""
_CUSTOMERS = "SELECT c_custkey AS customer_number, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}"
_PRODUCTS = "SELECT p_partkey AS product_code, p_name AS product_name, p_brand, p_type, p_size, p_retailprice FROM {part}"

SALES_CTES = f"""
    orderdetails AS ({_ORDERDETAILS.format(lineitem='lineitem')}),
    sales_orders AS ({_SALES_ORDERS.format(orders='orders')}),
    customers AS ({_CUSTOMERS.format(customer='customer')}),
    products AS ({_PRODUCTS.format(part='part')})
"""


def sales_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Order lines (some without an order), orders, customers and products."""
    return {
        "orderdetails": spark.sql(_ORDERDETAILS, lineitem=table(spark, sf_dir, "lineitem")),
        "orders": spark.sql(_SALES_ORDERS, orders=table(spark, sf_dir, "orders")),
        "customers": spark.sql(_CUSTOMERS, customer=table(spark, sf_dir, "customer")),
        "products": spark.sql(_PRODUCTS, part=table(spark, sf_dir, "part")),
    }


# ---- customer versions ------------------------------------------------------------------------

_PARENT = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}"
_LOCAL = """
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN c_custkey % 10 = 0 THEN round(c_acctbal + 100, 2) ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM {customer} WHERE c_custkey % 41 <> 0
"""
_REMOTE = """
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN c_custkey % 15 = 0 THEN round(c_acctbal + 7, 2) ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_custkey % 6 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
    FROM {customer} WHERE c_custkey % 43 <> 0
    UNION ALL
    SELECT c_custkey + 10000000, concat('New ', c_name), c_nationkey, c_acctbal, c_mktsegment
    FROM {customer} WHERE c_custkey % 60 = 0
"""
_REMOTE_WIDE = """
    SELECT c_custkey, c_acctbal, c_name, c_mktsegment,
           CASE WHEN c_custkey % 9 = 0 THEN 'gold' WHEN c_custkey % 9 = 1 THEN '' END AS c_tier
    FROM ({remote}) w
"""

PARENT_SQL = _PARENT.format(customer="customer")
LOCAL_SQL = _LOCAL.format(customer="customer")
REMOTE_SQL = _REMOTE.format(customer="customer")
REMOTE_WIDE_SQL = _REMOTE_WIDE.format(remote=REMOTE_SQL)
VERSION_CTES = f"parent AS ({PARENT_SQL}), loc AS ({LOCAL_SQL}), remote AS ({REMOTE_SQL}), wide AS ({REMOTE_WIDE_SQL})"


def parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_PARENT, customer=table(spark, sf_dir, "customer"))


def local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent without some rows and with some balances raised."""
    return spark.sql(_LOCAL, customer=table(spark, sf_dir, "customer"))


def remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent without other rows, with changed segments and balances, and with new rows."""
    return spark.sql(_REMOTE, customer=table(spark, sf_dir, "customer"))


def remote_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote with a column added, one dropped and one moved."""
    return spark.sql(_REMOTE_WIDE.format(remote=_REMOTE), customer=table(spark, sf_dir, "customer"))

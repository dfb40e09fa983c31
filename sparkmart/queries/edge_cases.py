"""Repeated and null keys, unlike types, large and odd numbers: inputs that simple tables don't have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import temporal
from sparkmart.operators import align, diff, impute, intervals, merge, patch, stats, tables
from sparkmart.operators.position import with_position
from sparkmart.plans import sales
from sparkmart.queries import basics  # noqa: F401  its SQL is used again
from sparkmart.queries import fixtures as fx
from sparkmart.queries.registry import ORACLES, query, table
from sparkmart.runtime import scratch_database, scratch_path
from sparkmart.sources import registry

_LINES = "SELECT l_partkey % 10 AS grp, l_orderkey, l_linenumber, l_quantity FROM {lineitem}"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_LINES, lineitem=table(spark, sf_dir, "lineitem"))


@query(
    "merge3_repeated_keys",
    """
    SELECT * EXCLUDE (copy) REPLACE (l_partkey % 10 AS l_partkey)
    FROM (SELECT *, unnest(range(CASE WHEN l_orderkey % 17 = 0 OR l_orderkey % 19 = 0 THEN 0 WHEN l_orderkey % 23 = 0 THEN 2 ELSE 1 END)) AS copy
          FROM lineitem)
    """,
)
def merge3_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten keys for all order lines: local and remote dropped some rows, remote doubled others."""
    p = table(spark, sf_dir, "lineitem").withColumn("l_partkey", F.col("l_partkey") % 10)
    local = p.filter("l_orderkey % 17 <> 0")
    remote = p.filter("l_orderkey % 19 <> 0").unionAll(p.filter("l_orderkey % 23 = 0 AND l_orderkey % 19 <> 0"))
    return merge.three_way(p, local, remote, ["l_partkey"]).merged()


_ORDER_EDITS = """
    SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN 'done' ELSE o_orderstatus END AS o_orderstatus,
                      CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 50 END AS o_custkey)
    FROM orders WHERE o_orderkey % 11 <> 0
    UNION ALL SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 50 END AS o_custkey)
    FROM orders WHERE o_orderkey % 13 = 0
"""


@query("merge3_same_changes", f"SELECT * FROM ({_ORDER_EDITS}) WHERE o_orderkey % 17 <> 0 OR o_orderkey % 5 = 0 OR o_orderkey % 13 = 0")
def merge3_same_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides made the same updates, deletes and copies under repeated and null keys; remote dropped more rows."""
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey") % 50)
    p = table(spark, sf_dir, "orders").withColumn("o_custkey", key)
    status = F.when(F.col("o_orderkey") % 5 == 0, "done").otherwise(F.col("o_orderstatus"))
    both = p.withColumn("o_orderstatus", status).filter("o_orderkey % 11 <> 0").unionAll(p.filter("o_orderkey % 13 = 0"))
    remote = both.filter("o_orderkey % 17 <> 0 OR o_orderkey % 5 = 0 OR o_orderkey % 13 = 0")
    return merge.three_way(p, both, remote, ["o_custkey"]).merged()


_HOLES = "SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey), o_orderkey AS n FROM orders"


@query("merge3_null_keys", f"SELECT * FROM ({_HOLES}) WHERE n % 21 <> 0 AND n % 35 <> 0")
def merge3_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the keys is null; local and remote each dropped some rows."""
    orders = table(spark, sf_dir, "orders").withColumn("n", F.col("o_orderkey"))
    p = orders.withColumn("o_orderkey", F.when(F.col("n") % 7 != 0, F.col("n")))
    return merge.three_way(p, p.filter("n % 21 <> 0"), p.filter("n % 35 <> 0"), ["o_orderkey"]).merged()


@query(
    "diff3_both_inserted",
    f"SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN '{merge.CONFLICT}' ELSE '{diff.SAME}' END AS action FROM customer",
)
def diff3_both_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local and remote both inserted the same customers, half of them with another balance."""
    customer = table(spark, sf_dir, "customer")
    changed = F.when(F.col("c_custkey") % 20 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    found = merge.three_way(customer.filter("c_custkey % 10 <> 0"), customer, customer.withColumn("c_acctbal", changed), ["c_custkey"])
    return found.row_actions()


@query("patch_repeated_keys", f"SELECT grp, l_orderkey, l_linenumber, l_quantity + 1 AS l_quantity FROM ({_LINES.format(lineitem='lineitem')})")
def patch_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ten keys against their changed copies: all are deleted and inserted anew."""
    a = _lines(spark, sf_dir)
    b = a.withColumn("l_quantity", F.col("l_quantity") + 1)
    return patch.apply_diff(a, diff.diff(a, b, ["grp"])).table


@query(
    "diff_types",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN '->' ELSE '' END AS action FROM orders
    """,
)
def diff_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column became text, and some of its values no numbers."""
    a = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.lit("abc"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    found = diff.diff(a, a.withColumn("o_custkey", text), ["o_orderkey"])
    return found.rows.select(*found.key_values(), "action")


@query(
    "diff_six_columns",
    """
    SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS l_pos, row_number() OVER (ORDER BY o_custkey DESC, o_orderkey DESC) - 1 AS r_pos
    FROM orders
    """,
)
def diff_six_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows of six columns in another order, paired without a key."""
    orders = table(spark, sf_dir, "orders")
    a = with_position(orders, ["o_orderkey"], "row_no")
    b = with_position(orders, [F.desc("o_custkey"), F.desc("o_orderkey")], "row_no")
    return align.align_rows(a, b, "row_no")


_TIES = "SELECT s_suppkey, k, CASE k WHEN 0 THEN 9 WHEN 1 THEN 10 END AS v FROM supplier, (SELECT unnest([0, 1, 2]) AS k)"


@query("impute_mode_numeric", f"SELECT s_suppkey, CAST(k AS INTEGER) AS k, CAST(coalesce(v, 9) AS INTEGER) AS v FROM ({_TIES})")
def impute_mode_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """9 and 10 are as frequent; the smaller number wins, not the smaller text."""
    each = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k"))
    return impute.impute(each.withColumn("v", F.when(F.col("k") == 0, 9).when(F.col("k") == 1, 10)), "v", "mode")


_LONGS = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN 9007199254740993 + 2 * o_orderkey END AS v FROM orders"
_RANKED = "SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM t WHERE v IS NOT NULL"


@query(
    "impute_long",
    f"""
    WITH t AS ({_LONGS}), r AS ({_RANKED})
    SELECT o_orderkey, coalesce(v, (SELECT CAST((min(v)::HUGEINT + max(v)) // 2 AS BIGINT) FROM r WHERE i = (n - 1) // 2 OR i = n // 2)) AS v FROM t
    """,
)
def impute_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers that a double can't hold keep their value and their type."""
    t = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.lit(9007199254740993) + 2 * F.col("o_orderkey")).alias("v")
    )
    return impute.impute(t, "v", "median")


_DECIMALS = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_totalprice AS DECIMAL(18, 2)) END AS v FROM orders"


@query(
    "impute_decimal",
    f"""
    WITH t AS ({_DECIMALS}), r AS ({_RANKED})
    SELECT o_orderkey, CAST(coalesce(v * 1000, (SELECT (min(v) + max(v)) * 500 FROM r WHERE i = (n - 1) // 2 OR i = n // 2)) AS BIGINT) AS v FROM t
    """,
)
def impute_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, price).alias("v"))
    return impute.impute(t, "v", "median").withColumn("v", (F.col("v") * 1000).cast("long"))


@query(
    "impute_nan",
    """
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 THEN o_totalprice END AS v FROM orders)
    SELECT o_orderkey, round(coalesce(v, (SELECT avg(v) FROM t)), 3) AS v FROM t
    """,
)
def impute_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN is filled like a null and doesn't count in the mean."""
    value = F.when(F.col("o_orderkey") % 13 == 0, F.lit(float("nan"))).when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice"))
    t = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("v"))
    return impute.impute(t, "v", "mean").withColumn("v", F.round("v", 3))


_ENDLESS = """
    SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS high,
           CASE WHEN o_orderkey % 13 = 0 THEN CAST('-Infinity' AS DOUBLE) WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS low,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 < 6 THEN CAST('-Infinity' AS DOUBLE) ELSE CAST('Infinity' AS DOUBLE) END AS both
    FROM {orders}
"""


@query(
    "impute_infinity",
    f"""
    WITH t AS ({_ENDLESS.format(orders='orders')})
    SELECT * REPLACE (coalesce(high, CAST('Infinity' AS DOUBLE)) AS high, round(coalesce(low, (SELECT median(low) FROM t)), 4) AS low) FROM t
    """,
)
def impute_infinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An infinite mean fills, a median is taken over infinities too, and a mean of opposite infinities fills nothing."""
    t = spark.sql(_ENDLESS, orders=table(spark, sf_dir, "orders"))
    return impute.impute_columns(t, {"high": "mean", "low": "median", "both": "mean"}).withColumn("low", F.round("low", 4))


@query(
    "run_shares",
    """
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS runs, max(value * 1000) AS max_ms,
      list_sort(list(value * 1000))[(count(*) * 7 + 99) // 100] AS p7_ms, list_sort(list(value * 1000))[(count(*) * 14 + 99) // 100] AS p14_ms,
      list_sort(list(value * 1000))[(count(*) * 55 + 99) // 100] AS p55_ms
    FROM events WHERE value IS NOT NULL GROUP BY 1, 2
    """,
)
def run_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares that no binary fraction holds."""
    return intervals.run_metrics(table(spark, sf_dir, "events"), "ts", "event_type", "value", "1 day", [0.07, 0.14, 0.55])


_MANY = "FROM lineitem, (SELECT unnest([0, 1, 2]) AS k)"


@query(
    "median_large",
    f"""
    SELECT 'price' AS column_name, round(median(l_extendedprice + k), 4) AS median {_MANY}
    UNION ALL SELECT 'few', median(CASE WHEN l_quantity < 45 THEN 7.0 ELSE l_quantity END) {_MANY}
    """,
)
def median_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More values than are sorted at once, and a column of mostly one value; the order lines three times."""
    lines = table(spark, sf_dir, "lineitem").withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(3)])))
    t = lines.select(
        (F.col("l_extendedprice") + F.col("k")).alias("price"), F.when(F.col("l_quantity") < 45, 7.0).otherwise(F.col("l_quantity")).alias("few")
    )
    found = stats.exact_medians(t, ["price", "few"], limit=10_000)
    return spark.createDataFrame([(c, round(float(v), 4)) for c, v in found.items()], "column_name string, median double")


@query("parse_date_forms", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders")
def parse_date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in many ways."""
    forms = ("yyyy-MM-dd'T'HH:mm:ss", "EEEE, d MMMM yyyy", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "yyyy-MM-dd'T'HH:mm:ss'+07:00'", "MMM d, yyyy", "d-MMM-yy", "dd-MMM-yyyy", "MMMM d, yyyy", "d/M/yy", "yyyy-MM-dd HH:mm:ss.SSS", "d.M.yyyy", "d MMMM yyyy HH:mm",
             "yyyyMMdd", "d/M/yyyy h:mm a", "yyyy/M/d")
    day = F.col("o_orderdate").cast("timestamp")
    text = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        text = F.when(F.col("o_orderkey") % len(forms) == i, F.date_format(day, form)).otherwise(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", temporal.parse_day_first(text).alias("parsed"))


_SALES_SOURCES = """
sources:
  - name: classic
    tables: [{name: orderdetails}, {name: orders}, {name: customers}, {name: products}]
"""


@query("declared_sources", ORACLES["sales_mart"])
def declared_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales mart from sources that a declaration names and binds to folders."""
    places = {}
    for name, rows in fx.sales_sources(spark, sf_dir).items():
        places[name] = scratch_path(spark, name)
        rows.write.parquet(places[name])
    bound = registry.register_sources(spark, registry.load_declaration(_SALES_SOURCES), places)
    given = {name: rows for (_, name), rows in bound.items()}
    return sales.sales_project().plan(given, ["view_customer_product_sales"])["view_customer_product_sales"]


@query(
    "diff_table_sets",
    """
    SELECT 'nation' AS table_name, '+++' AS action, count(*) AS row_inserts, 0::BIGINT AS row_deletes, 0::BIGINT AS row_updates,
           3::BIGINT AS col_inserts, 0::BIGINT AS col_deletes, 0::BIGINT AS col_updates FROM nation
    UNION ALL SELECT 'orders', '', 0, count(*), 0, 0, 0, 0 FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT 'supplier', '', 0, 0, 0, 0, 0, 1
    """,
)
def diff_table_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of two databases: one as it was, one with rows gone, one retyped, one new."""
    old, new = scratch_database(spark, "old"), scratch_database(spark, "new")
    given = {n: table(spark, sf_dir, n) for n in ("region", "orders", "supplier", "nation")}
    for name in ("region", "orders", "supplier"):
        given[name].write.saveAsTable(f"{old}.{name}")
    given["region"].write.saveAsTable(f"{new}.region")
    given["orders"].filter("o_orderkey % 5 <> 0").write.saveAsTable(f"{new}.orders")
    given["supplier"].withColumn("s_nationkey", F.col("s_nationkey").cast("long")).write.saveAsTable(f"{new}.supplier")
    given["nation"].write.saveAsTable(f"{new}.nation")
    keys = {"region": ["r_regionkey"], "orders": ["o_orderkey"], "supplier": ["s_suppkey"]}
    return tables.diff_tables(registry.table_set(spark, old), registry.table_set(spark, new), keys)


@query(
    "diff_flat_ordered",
    """
    WITH t AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS o, c_custkey, c_mktsegment AS s, c_custkey % 100 = 7 AS changed FROM customer),
    w AS (SELECT *, o - max(CASE WHEN changed THEN o END) OVER (ORDER BY o) AS since, min(CASE WHEN changed THEN o END) OVER (ORDER BY o DESC) - o AS until,
                 min(CASE WHEN changed THEN o END) OVER () AS first FROM t),
    v AS (SELECT *, coalesce(since <= 1, false) OR coalesce(until <= 1, false) AS shown FROM w)
    SELECT o AS row_order, CASE WHEN changed THEN '->' WHEN shown THEN '' ELSE '...' END AS action, CASE WHEN shown THEN c_custkey::VARCHAR END AS c_custkey,
           CASE WHEN changed THEN s || '->' || lower(s) WHEN shown THEN s END AS c_mktsegment
    FROM v WHERE shown OR since = 2 OR o = first - 2
    """,
)
def diff_flat_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed segments in row order, each with the rows beside it, and marks where rows are left out."""
    a = with_position(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), ["c_custkey"], "row_no")
    b = a.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 100 == 7, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")))
    flat = patch.flatten(diff.diff(a, b, ["c_custkey"], position="row_no"), position="row_no", context=1)
    return flat.withColumnRenamed(patch.ACTION_COLUMN, "action")

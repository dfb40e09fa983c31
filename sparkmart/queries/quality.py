"""Data quality, imputation, column statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import impute, quality, stats
from sparkmart.plans import news as news_plan
from sparkmart.queries import fixtures as fx
from sparkmart.queries.registry import query, table

_T = f"t AS ({fx.DQ_ORDERS_SQL})"


@query(
    "dq_duplicates",
    f"""
    WITH {_T}, n AS (
      SELECT *, count(*) OVER w AS group_size, row_number() OVER w AS rn FROM t
      WINDOW w AS (PARTITION BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT 'orders' AS dataset, * EXCLUDE (rn) FROM n WHERE rn > 1
    UNION ALL
    SELECT 'tags', NULL, NULL, NULL, NULL, NULL, NULL, group_size
    FROM (SELECT count(*) OVER (PARTITION BY event_type) AS group_size,
                 row_number() OVER (PARTITION BY event_type) AS rn FROM events) e WHERE rn > 1
    """,
)
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a few copies, and a table that consists of a handful of rows copied many times."""
    types = table(spark, sf_dir, "events").select("event_type")
    report = quality.duplicate_rows({"orders": fx.dq_orders(spark, sf_dir), "tags": types})
    return report.drop("event_type")


@query("dq_dedupe", f"WITH {_T} SELECT DISTINCT * FROM t")
def dq_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_duplicates(fx.dq_orders(spark, sf_dir), ["o_orderkey"], "o_custkey")


@query(
    "dq_keep_first",
    """
    SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id
    """,
)
def dq_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return quality.keep_first(events, ["user_id"], "event_id")


def _null_line(dataset: str, column: str, dtype: str, is_date: bool) -> str:
    return f"""
    SELECT '{dataset}' AS dataset, '{column}' AS column_name, '{dtype}' AS data_type,
           count(*) - count({column}) AS null_count, (count(*) - count({column})) / count(*) * 100 AS null_percent,
           {str(is_date).lower()} AS is_date FROM t
    """


@query(
    "dq_nulls",
    f"WITH {_T} "
    + " UNION ALL ".join(
        _null_line("orders", c, t, d)
        for c, t, d in (
            ("o_orderstatus", "string", False),
            ("o_totalprice", "double", False),
            ("o_orderdate", "timestamp_ntz", True),
            ("o_orderpriority", "string", False),
        )
    ),
)
def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_report({"orders": fx.dq_orders(spark, sf_dir), "part": table(spark, sf_dir, "part")})


@query("dq_drop_sparse", f"WITH {_T} SELECT * EXCLUDE (o_orderpriority) FROM t")
def dq_drop_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_sparse_columns(fx.dq_orders(spark, sf_dir), 20.0)


@query("impute_mean", f"WITH {_T} SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM t)), 4) AS o_totalprice FROM t")
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = impute.impute(fx.dq_orders(spark, sf_dir), "o_totalprice", "mean")
    return filled.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


@query("impute_median", f"WITH {_T} SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT median(o_totalprice) FROM t)), 4) AS o_totalprice FROM t")
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = impute.impute(fx.dq_orders(spark, sf_dir), "o_totalprice", "median")
    return filled.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


def _mode_sql(column: str, source: str = "t") -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


@query("impute_mode", f"WITH {_T} SELECT o_orderkey, coalesce(o_orderstatus, {_mode_sql('o_orderstatus')}) AS o_orderstatus FROM t")
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.impute(fx.dq_orders(spark, sf_dir), "o_orderstatus", "mode").select("o_orderkey", "o_orderstatus")


def interpolation_ctes(source: str, column: str, order: str, out: str = "filled") -> str:
    """CTEs that interpolate a timestamp column of ``source`` over its ``order`` and floor it to seconds."""
    return f"""
    numbered AS (SELECT *, row_number() OVER (ORDER BY {order}) AS p, epoch_us({column}) AS us FROM {source}),
    marked AS (SELECT *, CASE WHEN us IS NOT NULL THEN p END AS kp FROM numbered),
    edged AS (
      SELECT *, last_value(kp IGNORE NULLS) OVER before AS lp, last_value(us IGNORE NULLS) OVER before AS lv,
             first_value(kp IGNORE NULLS) OVER after AS rp, first_value(us IGNORE NULLS) OVER after AS rv
      FROM marked
      WINDOW before AS (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             after AS (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    {out} AS (
      SELECT * EXCLUDE ({column}, p, us, kp, lp, lv, rp, rv), make_timestamp(1000000 * CAST(
        CASE WHEN lp IS NULL THEN NULL WHEN rp IS NULL OR rp = lp THEN lv // 1000000
             ELSE (CAST(lv AS HUGEINT) * (rp - lp) + CAST(rv - lv AS HUGEINT) * (p - lp)) // (CAST(rp - lp AS HUGEINT) * 1000000)
        END AS BIGINT)) AS {column}
      FROM edged)
    """


@query(
    "impute_interpolate",
    f"WITH {_T}, {interpolation_ctes('t', 'o_orderdate', 'o_orderkey')} SELECT o_orderkey, o_orderdate FROM filled",
)
def impute_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = impute.impute(fx.dq_orders(spark, sf_dir), "o_orderdate", "interpolate", ["o_orderkey"])
    return filled.select("o_orderkey", "o_orderdate")


@query(
    "dq_autoclean",
    f"""
    WITH base AS ({fx.DQ_ORDERS_SQL}), t AS (SELECT DISTINCT * FROM base),
    {interpolation_ctes('t', 'o_orderdate', 'o_orderkey')}
    SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, {_mode_sql('o_orderstatus')}) AS o_orderstatus,
           round(coalesce(o_totalprice, (SELECT median(o_totalprice) FROM t)), 4) AS o_totalprice, o_orderdate
    FROM filled
    """,
)
def dq_autoclean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = news_plan.clean(fx.dq_orders(spark, sf_dir), ["o_orderkey"], ["o_orderkey"], 25.0)
    return cleaned.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("test_unique", f"WITH {_T} SELECT o_orderkey, count(*) AS n FROM t GROUP BY o_orderkey HAVING count(*) > 1")
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations_unique(fx.dq_orders(spark, sf_dir), "o_orderkey")


@query("test_not_null", f"WITH {_T} SELECT * FROM t WHERE o_orderstatus IS NULL")
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations_not_null(fx.dq_orders(spark, sf_dir), "o_orderstatus")


@query(
    "dq_constraints",
    f"""
    WITH n AS ({fx.NEWS_SQL})
    SELECT 'title' AS column_name, 'not_null' AS rule, count(*) - count(title) AS violations FROM n
    UNION ALL SELECT 'title', 'max_length_18', count(*) FILTER (length(title) > 18) FROM n
    UNION ALL SELECT 'description', 'not_null', count(*) - count(description) FROM n
    UNION ALL SELECT 'category', 'not_null', count(*) - count(category) FROM n
    UNION ALL SELECT 'category', 'max_length_100', count(*) FILTER (length(category) > 100) FROM n
    UNION ALL SELECT 'tags', 'max_length_10', count(*) FILTER (length(tags) > 10) FROM n
    """,
)
def dq_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        quality.Rule("title", max_length=18),
        quality.Rule("description"),
        quality.Rule("category", max_length=100),
        quality.Rule("tags", not_null=False, max_length=10),
    ]
    return quality.constraint_report(fx.news(spark, sf_dir), rules)


@query(
    "dq_validate",
    f"""
    WITH {_T}
    SELECT 'orders' AS dataset, 'o_orderkey' AS column_name, 'Data Type' AS check_name, 'bigint' AS expected,
           'bigint' AS actual, 'Pass' AS status
    UNION ALL SELECT 'orders', 'o_orderdate', 'Data Type', 'date', 'timestamp_ntz', 'Fail'
    UNION ALL
    SELECT 'orders', c, 'Value Range', r, CASE WHEN ok THEN 'All values in range' ELSE 'Out of range values exist' END,
           CASE WHEN ok THEN 'Pass' ELSE 'Fail' END
    FROM (SELECT 'o_orderkey' AS c, '0 to 1000000000' AS r, bool_and(coalesce(o_orderkey BETWEEN 0 AND 1000000000, false)) AS ok FROM t
          UNION ALL SELECT 'o_totalprice', '0 to 1000000', bool_and(coalesce(o_totalprice BETWEEN 0 AND 1000000, false)) FROM t
          UNION ALL SELECT 'o_custkey', '1 to 5', bool_and(coalesce(o_custkey BETWEEN 1 AND 5, false)) FROM t) x
    """,
)
def dq_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status range is not checked (a text), the price fails for its nulls."""
    return quality.validate(
        {"orders": fx.dq_orders(spark, sf_dir)},
        {"o_orderkey": "bigint", "o_orderdate": "date"},
        {"o_orderkey": (0, 1000000000), "o_totalprice": (0, 1000000), "o_custkey": (1, 5), "o_orderstatus": (0, 1)},
    )


def _stat_line(column: str) -> str:
    return f"""
    SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 4) AS mean, round(median({column}), 4) AS median,
           round(skewness({column}), 4) AS skewness, {_mode_sql(column, 'lineitem')} AS mode FROM lineitem
    """


@query("col_stats", " UNION ALL ".join(_stat_line(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def col_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.column_stats(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "median", "skewness")})


@query(
    "pass_rate",
    """
    SELECT toxic, count(*) AS total, count(*) FILTER (quality = 1) AS passed,
           round(100.0 * count(*) FILTER (quality = 1) / count(*), 1) AS pass_rate
    FROM labels GROUP BY toxic
    """,
)
def pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.pass_rate(table(spark, sf_dir, "labels"), F.col("quality") == 1, ["toxic"])


def _distinct_line(i: int, column: str) -> str:
    def n(source: str) -> str:
        return f"(SELECT count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) FROM {source})"

    return f"SELECT '{column}' AS column_name, {i} AS place, {n('parent')} AS distinct_a, {n('remote')} AS distinct_b"


@query(
    "key_candidates",
    f"WITH {fx.VERSION_CTES}, c AS ("
    + " UNION ALL ".join(
        _distinct_line(i, c) for i, c in enumerate(("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    )
    + """)
    SELECT column_name, CAST(distinct_a AS BIGINT) AS distinct_a, CAST(distinct_b AS BIGINT) AS distinct_b,
           CAST(distinct_a + distinct_b AS BIGINT) AS distinct_total,
           CAST(row_number() OVER (ORDER BY distinct_a + distinct_b DESC, place) AS INTEGER) AS rank FROM c
    """,
)
def key_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = fx.parent(spark, sf_dir), fx.remote(spark, sf_dir)
    return stats.distinct_counts(a, b, a.columns)


def _quality_line(columns: tuple[str, ...]) -> str:
    k = ", ".join(columns)
    return f"""
    SELECT '{' // '.join(columns)}' AS key_columns, count(*) FILTER (na > 0) AS keys_a, count(*) FILTER (nb > 0) AS keys_b,
           CAST(greatest(max(na), max(nb)) AS BIGINT) AS max_frequency, count(*) FILTER (na = 1 AND nb = 1) AS unique_in_both,
           count(*) FILTER (na = 1 AND nb = 1) / sum(na) AS quality
    FROM (SELECT {k}, count(*) FILTER (side = 'a') AS na, count(*) FILTER (side = 'b') AS nb
          FROM (SELECT 'a' AS side, * FROM parent UNION ALL SELECT 'b', * FROM remote) u GROUP BY {k}) g
    """


_CANDIDATES = (("c_custkey",), ("c_name",), ("c_nationkey", "c_mktsegment"), ("c_acctbal",))


@query("key_quality", f"WITH {fx.VERSION_CTES} " + " UNION ALL ".join(_quality_line(c) for c in _CANDIDATES))
def key_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.key_quality(fx.parent(spark, sf_dir), fx.remote(spark, sf_dir), _CANDIDATES)

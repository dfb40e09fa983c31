"""Table comparison, merge and patch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.comparison import CompareOptions
from sparkmart.operators import align, diff, merge, moves, patch, tables
from sparkmart.operators.position import with_position
from sparkmart.operators.stats import column_subsets
from sparkmart.queries import fixtures as fx
from sparkmart.queries.registry import query, table

_KEYS = ["c_custkey"]
_ACTION = """
    CASE WHEN p.c_custkey IS NULL THEN '+++' WHEN r.c_custkey IS NULL THEN '---'
         WHEN p.c_acctbal IS DISTINCT FROM r.c_acctbal OR p.c_mktsegment IS DISTINCT FROM r.c_mktsegment THEN '->' ELSE '' END
"""
_CHANGED = """
    concat_ws(',', CASE WHEN p.c_custkey = r.c_custkey AND p.c_acctbal <> r.c_acctbal THEN 'c_acctbal' END,
                   CASE WHEN p.c_custkey = r.c_custkey AND p.c_mktsegment <> r.c_mktsegment THEN 'c_mktsegment' END)
"""
_ROWS_SQL = f"""
    WITH {fx.VERSION_CTES}
    SELECT coalesce(r.c_custkey, p.c_custkey) AS c_custkey, {_ACTION} AS action, {_CHANGED} AS changed_columns
    FROM parent p FULL JOIN remote r ON p.c_custkey = r.c_custkey
"""


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fx.parent(spark, sf_dir), fx.remote(spark, sf_dir)


@query("diff_keyed", _ROWS_SQL)
def diff_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff(*_versions(spark, sf_dir), _KEYS).row_actions()


@query("diff_pk", _ROWS_SQL)
def diff_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff_by_primary_key(*_versions(spark, sf_dir), _KEYS, _KEYS).row_actions()


@query(
    "diff_repeated_keys",
    """
    WITH a AS (SELECT event_type, event_id FROM events), b AS (SELECT event_type, event_id + 1 AS event_id FROM events WHERE event_type <> 'view')
    SELECT event_type, '---' AS action, count(*) AS n FROM a GROUP BY event_type
    UNION ALL SELECT event_type, '+++', count(*) FROM b GROUP BY event_type
    """,
)
def diff_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that repeats pairs with nothing, however many rows have it."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    changed = events.filter("event_type <> 'view'").withColumn("event_id", F.col("event_id") + 1)
    found = diff.diff(events, changed, ["event_type"]).row_actions()
    return found.groupBy("event_type", "action").agg(F.count(F.lit(1)).alias("n"))


def _cell(column: str) -> str:
    return f"""
    SELECT p.c_custkey, '{column}' AS column_name, CAST(p.{column} AS VARCHAR) AS old_value, CAST(r.{column} AS VARCHAR) AS new_value
    FROM parent p JOIN remote r ON p.c_custkey = r.c_custkey WHERE p.{column} IS DISTINCT FROM r.{column}
    """


@query("diff_cells", f"WITH {fx.VERSION_CTES} {_cell('c_acctbal')} UNION ALL {_cell('c_mktsegment')}")
def diff_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff(*_versions(spark, sf_dir), _KEYS).cells()


@query("diff_filter", f"SELECT * FROM ({_ROWS_SQL}) d WHERE action IN ('+++', '---')")
def diff_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff(*_versions(spark, sf_dir), _KEYS).only(diff.INSERT, diff.DELETE).row_actions()


@query(
    "diff_tolerant",
    f"""
    WITH {fx.VERSION_CTES}
    SELECT coalesce(r.c_custkey, p.c_custkey) AS c_custkey,
           CASE WHEN p.c_custkey IS NULL THEN '+++' WHEN r.c_custkey IS NULL THEN '---'
                WHEN abs(p.c_acctbal - r.c_acctbal) >= 50 THEN '->' ELSE '' END AS action
    FROM parent p FULL JOIN loc r ON p.c_custkey = r.c_custkey
    UNION ALL
    SELECT coalesce(r.c_custkey, p.c_custkey), CASE WHEN p.c_custkey IS NULL THEN '+++' WHEN r.c_custkey IS NULL THEN '---'
           ELSE '' END
    FROM parent p FULL JOIN remote r ON p.c_custkey = r.c_custkey
    """,
)
def diff_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances 100 apart differ, balances 7 apart do not; case and outer blanks do not count."""
    options = CompareOptions(ignore_columns=("c_name",), ignore_whitespace=True, ignore_case=True, epsilon=50.0)
    p = fx.parent(spark, sf_dir)
    out = None
    for other in (fx.local(spark, sf_dir), fx.remote(spark, sf_dir)):
        padded = other.withColumn("c_mktsegment", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))
        found = diff.diff(p, padded, _KEYS, options).row_actions().drop("changed_columns")
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "diff_as_text",
    "SELECT count(*) AS typed_updates, count(*) AS text_updates, 0 AS typed_same FROM customer WHERE c_nationkey IS NOT NULL",
)
def diff_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compared as texts 1 and 1.0 differ; compared as values, a changed balance does."""
    a = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("v"))
    b = a.withColumn("v", F.col("v").cast("double"))
    c = a.withColumn("v", F.col("v") + 1)
    updates = F.count_if(F.col("action") == diff.UPDATE)
    text = diff.diff(a, b, _KEYS, CompareOptions(compare_as="string")).rows.agg(updates.alias("text_updates"))
    typed = diff.diff(a, c, _KEYS).rows.agg(updates.alias("typed_updates"))
    same = diff.diff(a, b, _KEYS).rows.agg(updates.cast("int").alias("typed_same"))
    counts = [x.first()[0] for x in (typed, text, same)]
    return spark.createDataFrame([tuple(counts)], "typed_updates long, text_updates long, typed_same int")


_SUMMARY = """
    count(*) FILTER (p.c_custkey IS NULL) AS row_inserts, count(*) FILTER (r.c_custkey IS NULL) AS row_deletes,
    count(*) FILTER (p.c_custkey = r.c_custkey AND (p.c_acctbal <> r.c_acctbal OR p.c_mktsegment <> r.c_mktsegment)) AS row_updates
"""


@query(
    "diff_summary",
    f"""
    WITH {fx.VERSION_CTES}
    SELECT {_SUMMARY}, CAST(0 AS BIGINT) AS row_reorders, CAST(1 AS BIGINT) AS col_inserts, CAST(1 AS BIGINT) AS col_deletes,
           CAST(2 AS BIGINT) AS col_updates, CAST(0 AS BIGINT) AS col_renames, CAST(1 AS BIGINT) AS col_reorders,
           count(p.c_custkey) AS row_count_initial, count(r.c_custkey) AS row_count_final, CAST(5 AS BIGINT) AS col_count_initial,
           CAST(5 AS BIGINT) AS col_count_final, true AS different
    FROM parent p FULL JOIN wide r ON p.c_custkey = r.c_custkey
    """,
)
def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff(fx.parent(spark, sf_dir), fx.remote_wide(spark, sf_dir), _KEYS).summary()


@query(
    "diff_schema",
    f"""
    WITH {fx.VERSION_CTES},
    u AS (SELECT count(*) FILTER (p.c_acctbal <> r.c_acctbal) AS bal, count(*) FILTER (p.c_mktsegment <> r.segment) AS seg
          FROM parent p JOIN (SELECT c_custkey, c_acctbal, c_mktsegment AS segment FROM wide) r ON p.c_custkey = r.c_custkey)
    SELECT 'c_custkey' AS column_name, '' AS action, 'bigint' AS old_type, 'bigint' AS new_type, 0 AS updated_cells
    UNION ALL SELECT 'c_acctbal', '', 'double', 'double', bal FROM u
    UNION ALL SELECT 'c_name', ':', 'string', 'string', 0
    UNION ALL SELECT 'segment', '(c_mktsegment)', 'string', 'string', seg FROM u
    UNION ALL SELECT 'c_tier', '+++', NULL, 'string', 0
    UNION ALL SELECT 'c_nationkey', '---', 'int', NULL, 0
    """,
)
def diff_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns added, removed, moved and renamed, with the number of cells that changed in them."""
    renamed = fx.remote_wide(spark, sf_dir).withColumnRenamed("c_mktsegment", "segment")
    found = diff.diff(fx.parent(spark, sf_dir), renamed, _KEYS, renames={"c_mktsegment": "segment"})
    return found.column_activity()


@query(
    "diff_gained",
    f"""
    WITH {fx.VERSION_CTES}
    SELECT coalesce(r.c_custkey, p.c_custkey) AS c_custkey,
           CASE WHEN p.c_custkey IS NULL THEN '+++' WHEN r.c_custkey IS NULL THEN '---'
                WHEN p.c_acctbal <> r.c_acctbal OR p.c_mktsegment <> r.c_mktsegment THEN '->'
                WHEN r.c_tier <> '' THEN '+' ELSE '' END AS action
    FROM parent p FULL JOIN wide r ON p.c_custkey = r.c_custkey
    """,
)
def diff_gained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that only gained a value in the new column have an action of their own."""
    found = diff.diff(fx.parent(spark, sf_dir), fx.remote_wide(spark, sf_dir), _KEYS)
    return found.row_actions().drop("changed_columns")


@query(
    "diff_columns_pruned",
    f"""
    WITH {fx.VERSION_CTES}
    SELECT CASE WHEN r.c_custkey IS NULL THEN '---' ELSE '->' END AS action, coalesce(r.c_custkey, p.c_custkey) AS c_custkey,
           coalesce(r.c_acctbal, p.c_acctbal) AS c_acctbal, coalesce(r.c_mktsegment, p.c_mktsegment) AS c_mktsegment
    FROM parent p LEFT JOIN remote r ON p.c_custkey = r.c_custkey
    WHERE r.c_custkey IS NULL OR p.c_acctbal <> r.c_acctbal OR p.c_mktsegment <> r.c_mktsegment
    """,
)
def diff_columns_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff(*_versions(spark, sf_dir), _KEYS).only(diff.UPDATE, diff.DELETE, diff.SAME).pruned()


def _numbered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a, b = _versions(spark, sf_dir)
    return with_position(a, _KEYS, "row_no"), with_position(b, _KEYS, "row_no")


_ORDERED = f"""
    {fx.VERSION_CTES},
    pn AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM parent),
    rn AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM remote),
    o AS (SELECT p.pos AS l_pos, r.pos AS r_pos, coalesce(r.c_custkey, p.c_custkey) AS c_custkey, {_ACTION} AS action
          FROM pn p FULL JOIN rn r ON p.c_custkey = r.c_custkey)
"""


@query(
    "diff_index",
    f"""
    WITH {_ORDERED}
    SELECT concat(coalesce(CAST(l_pos AS VARCHAR), '-'), ':', coalesce(CAST(r_pos AS VARCHAR), '-')) AS rows, c_custkey, action
    FROM o WHERE action <> ''
    """,
)
def diff_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.diff(*_numbered(spark, sf_dir), _KEYS, position="row_no").provenance("row_no")


@query(
    "diff_context",
    f"""
    WITH {_ORDERED},
    q AS (SELECT *, row_number() OVER (ORDER BY coalesce(r_pos, l_pos), r_pos IS NOT NULL) - 1 AS row_order FROM o),
    c AS (SELECT *, CASE WHEN action <> '' THEN row_order END AS marked, min(CASE WHEN action <> '' THEN row_order END) OVER () AS first_at FROM q),
    w AS (SELECT *, row_order - max(marked) OVER (ORDER BY row_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since,
                 min(marked) OVER (ORDER BY row_order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - row_order AS until FROM c)
    SELECT row_order, c_custkey, CASE WHEN since <= 1 OR until <= 1 THEN action ELSE '...' END AS action
    FROM w WHERE since <= 1 OR until <= 1 OR since = 2 OR (row_order = first_at - 2)
    """,
)
def diff_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed rows with one row of context; where more is left out, one mark."""
    return diff.diff(*_numbered(spark, sf_dir), _KEYS, position="row_no").with_context("row_no", 1)


def _shown(column: str) -> str:
    old, new = f"CAST(p.{column} AS VARCHAR)", f"CAST(r.{column} AS VARCHAR)"
    return f"""CASE WHEN p.c_custkey IS NULL THEN {new} WHEN r.c_custkey IS NULL THEN {old}
               WHEN p.{column} IS DISTINCT FROM r.{column} THEN concat(coalesce({old}, 'NULL'), '-->', coalesce({new}, 'NULL'))
               ELSE {old} END AS {column}"""


_ARROWS = "CASE WHEN c_custkey % 70 = 0 THEN concat('a->', c_name) WHEN c_custkey % 71 = 0 THEN NULL ELSE c_name END AS c_name"


@query(
    "diff_flat",
    f"""
    WITH {fx.VERSION_CTES.replace('parent AS', 'parent0 AS').replace('remote AS', 'remote0 AS').replace('wide AS', 'wide0 AS')},
    parent AS (SELECT * REPLACE ({_ARROWS.replace(' AS c_name', '')} AS c_name) FROM parent0),
    remote AS (SELECT * FROM remote0)
    SELECT CASE WHEN p.c_custkey IS NULL THEN '+++' WHEN r.c_custkey IS NULL THEN '---' ELSE '-->' END AS "@@",
           {', '.join(_shown(c) for c in ('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'))}
    FROM parent p FULL JOIN remote r ON p.c_custkey = r.c_custkey
    WHERE p.c_custkey IS NULL OR r.c_custkey IS NULL OR p.c_name IS DISTINCT FROM r.c_name
       OR p.c_acctbal <> r.c_acctbal OR p.c_mktsegment <> r.c_mktsegment
    """,
)
def diff_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some names contain the arrow, so it grows by a dash; some are null."""
    a, b = _versions(spark, sf_dir)
    a = a.selectExpr("c_custkey", _ARROWS, "c_nationkey", "c_acctbal", "c_mktsegment")
    return patch.flatten(diff.diff(a, b, _KEYS))


@query(
    "tables_equal",
    f"""
    WITH {fx.VERSION_CTES},
    g AS (SELECT sum(a) AS na, sum(b) AS nb FROM (
        SELECT *, 1 AS a, 0 AS b FROM parent UNION ALL SELECT *, 0, 1 FROM remote) u
        GROUP BY c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment),
    x AS (SELECT CAST(sum(na) AS BIGINT) AS rows_a, CAST(sum(nb) AS BIGINT) AS rows_b, count(*) FILTER (na <> nb) AS differing_rows FROM g)
    SELECT 'remote' AS compared, true AS same_columns, *, differing_rows = 0 AS equal FROM x
    UNION ALL SELECT 'itself', true, count(*), count(*), 0, true FROM parent
    """,
)
def tables_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _versions(spark, sf_dir)
    other = tables.compare_tables(a, b).select(F.lit("remote").alias("compared"), "*")
    return other.unionByName(tables.compare_tables(a, a).select(F.lit("itself").alias("compared"), "*"))


@query(
    "diff_tables",
    f"""
    WITH {fx.VERSION_CTES}
    SELECT 'customer' AS table_name, '' AS action, {_SUMMARY}, CAST(1 AS BIGINT) AS col_inserts, CAST(1 AS BIGINT) AS col_deletes,
           CAST(2 AS BIGINT) AS col_updates
    FROM parent p FULL JOIN wide r ON p.c_custkey = r.c_custkey
    UNION ALL SELECT 'part', '---', 0, count(*), 0, 0, 6, 0 FROM part
    UNION ALL SELECT 'orders', '+++', count(*), 0, 0, 6, 0, 0 FROM orders
    """,
)
def diff_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table changed, one is gone, one is new, and one is identical and left out."""
    supplier = table(spark, sf_dir, "supplier")
    a = {"customer": fx.parent(spark, sf_dir), "supplier": supplier, "part": table(spark, sf_dir, "part")}
    b = {"customer": fx.remote_wide(spark, sf_dir), "supplier": supplier, "orders": table(spark, sf_dir, "orders")}
    return tables.diff_tables(a, b, {"customer": _KEYS, "supplier": ["s_suppkey"]})


_THREE = f"""
    {fx.VERSION_CTES},
    j AS (SELECT coalesce(l.c_custkey, r.c_custkey, p.c_custkey) AS c_custkey, p.c_custkey IS NOT NULL AS hp,
                 l.c_custkey IS NOT NULL AS hl, r.c_custkey IS NOT NULL AS hr, p.c_acctbal AS pb, l.c_acctbal AS lb, r.c_acctbal AS rb,
                 p.c_mktsegment AS ps, l.c_mktsegment AS ls, r.c_mktsegment AS rs, coalesce(l.c_name, r.c_name) AS c_name,
                 coalesce(l.c_nationkey, r.c_nationkey) AS c_nationkey
          FROM parent p FULL JOIN loc l ON p.c_custkey = l.c_custkey
          FULL JOIN remote r ON coalesce(p.c_custkey, l.c_custkey) = r.c_custkey),
    v AS (SELECT *, pb IS DISTINCT FROM rb AND pb IS DISTINCT FROM lb AND lb IS DISTINCT FROM rb AS cb,
                 ps IS DISTINCT FROM rs AND ps IS DISTINCT FROM ls AND ls IS DISTINCT FROM rs AS cs FROM j)
"""


@query(
    "diff3",
    f"""
    WITH {_THREE}
    SELECT c_custkey, CASE WHEN NOT hp AND NOT hl AND hr THEN '+++' WHEN hp AND hl AND NOT hr THEN '---'
      WHEN hp AND hr AND (cb OR cs OR (NOT hl AND (pb <> rb OR ps <> rs))) THEN '!->'
      WHEN hp AND hr AND (pb <> rb OR ps <> rs) THEN '->' ELSE '' END AS action
    FROM v
    """,
)
def diff3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows remote changed; keys deleted locally but changed by remote disagree in every changed cell."""
    return merge.three_way(fx.parent(spark, sf_dir), fx.local(spark, sf_dir), fx.remote(spark, sf_dir), _KEYS).row_actions()


@query(
    "merge3",
    f"""
    WITH {_THREE}
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN hl AND hr AND cb THEN lb WHEN hl AND hr AND pb <> rb THEN rb WHEN hl THEN lb ELSE rb END AS c_acctbal,
           CASE WHEN hl AND hr AND cs THEN ls WHEN hl AND hr AND ps <> rs THEN rs WHEN hl THEN ls ELSE rs END AS c_mktsegment
    FROM v WHERE (hl AND hr) OR (NOT hp AND (hl OR hr))
    """,
)
def merge3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.three_way(fx.parent(spark, sf_dir), fx.local(spark, sf_dir), fx.remote(spark, sf_dir), _KEYS).merged()


@query(
    "merge3_text",
    f"""
    WITH {_THREE}
    SELECT c_custkey, CASE WHEN hl AND hr AND cb THEN concat('((( ', pb, ' ))) ', lb, ' /// ', rb)
                WHEN hl AND hr AND pb <> rb THEN CAST(rb AS VARCHAR) WHEN hl THEN CAST(lb AS VARCHAR) ELSE CAST(rb AS VARCHAR) END AS c_acctbal
    FROM v WHERE (hl AND hr) OR (NOT hp AND (hl OR hr))
    """,
)
def merge3_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge.three_way(fx.parent(spark, sf_dir), fx.local(spark, sf_dir), fx.remote(spark, sf_dir), _KEYS)
    return merged.merged("text").select("c_custkey", "c_acctbal")


@query(
    "merge3_conflicts",
    f"""
    WITH {_THREE}
    SELECT c_custkey, 'c_acctbal' AS column_name, CAST(pb AS VARCHAR) AS parent_value, CAST(lb AS VARCHAR) AS local_value,
           CAST(rb AS VARCHAR) AS remote_value FROM v WHERE hp AND hl AND hr AND cb
    UNION ALL SELECT c_custkey, 'c_mktsegment', ps, ls, rs FROM v WHERE hp AND hl AND hr AND cs
    """,
)
def merge3_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.three_way(fx.parent(spark, sf_dir), fx.local(spark, sf_dir), fx.remote(spark, sf_dir), _KEYS).conflicts()


@query("patch_roundtrip", f"WITH {fx.VERSION_CTES} SELECT * FROM wide")
def patch_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patching the parent with the comparison gives the other table, columns included."""
    a, b = fx.parent(spark, sf_dir), fx.remote_wide(spark, sf_dir)
    return patch.apply_diff(a, diff.diff(a, b, _KEYS)).table


@query(
    "patch_flat",
    f"""
    WITH {fx.VERSION_CTES}
    SELECT r.c_custkey, r.c_acctbal, r.c_name, r.c_mktsegment,
           CASE WHEN r.c_tier = '' AND r.c_acctbal = p.c_acctbal AND r.c_mktsegment = p.c_mktsegment THEN NULL ELSE r.c_tier END AS c_tier
    FROM wide r LEFT JOIN parent p ON p.c_custkey = r.c_custkey
    """,
)
def patch_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the text form; a row that only gained a blank text is no change there."""
    a, b = fx.parent(spark, sf_dir), fx.remote_wide(spark, sf_dir)
    return patch.apply_flat(a, patch.flatten(diff.diff(a, b, _KEYS)), _KEYS).table


@query(
    "patch_rejects",
    f"""
    WITH {fx.VERSION_CTES}
    SELECT l.c_custkey, 'c_acctbal' AS column_name, CAST(p.c_acctbal AS VARCHAR) AS expected, CAST(l.c_acctbal AS VARCHAR) AS found,
           CAST(r.c_acctbal AS VARCHAR) AS wanted
    FROM parent p JOIN loc l ON p.c_custkey = l.c_custkey JOIN remote r ON p.c_custkey = r.c_custkey
    WHERE p.c_acctbal <> r.c_acctbal AND p.c_acctbal <> l.c_acctbal
    """,
)
def patch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A patch meant for the parent, applied to the local version: cells changed there are left alone."""
    a, b = _versions(spark, sf_dir)
    return patch.apply_diff(fx.local(spark, sf_dir), diff.diff(a, b, _KEYS)).rejected


@query(
    "diff_moves",
    """
    WITH t AS (SELECT c_custkey, floor(c_custkey / 20) % 7 = 3 AS late FROM customer)
    SELECT l_pos, r_pos FROM (
      SELECT late, row_number() OVER (ORDER BY c_custkey) - 1 AS l_pos, row_number() OVER (ORDER BY late, c_custkey) - 1 AS r_pos FROM t)
    WHERE late
    """,
)
def diff_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in key order against an order in which some blocks of keys went to the end."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    block = F.floor(F.col("c_custkey") / 20)
    late = (block % 7 == 3).cast("int")
    source = with_position(customer, ["c_custkey"], "l_pos")
    target = with_position(customer, [late, F.col("c_custkey")], "r_pos")
    return moves.moved_rows(source.join(target, "c_custkey"), "l_pos", "r_pos")


def _auto_sql() -> str:
    """The subsets one after the other, as chained CTEs."""
    columns = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    subsets = column_subsets(columns)
    parts = [
        f"""{fx.VERSION_CTES},
        a AS MATERIALIZED (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, {', '.join(columns)} FROM parent),
        b AS MATERIALIZED (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, {', '.join(columns)} FROM remote),
        p0 AS (SELECT CAST(NULL AS BIGINT) AS l_pos, CAST(NULL AS BIGINT) AS r_pos WHERE false)"""
    ]
    for i, subset in enumerate(subsets, 1):
        k = ", ".join(subset)
        on = " AND ".join(f"x.{c} = y.{c}" for c in subset)
        parts.append(
            f"""
        p{i} AS MATERIALIZED (
          SELECT * FROM p{i - 1}
          UNION ALL
          SELECT x.pos, y.pos
          FROM (SELECT {k}, min(pos) AS pos, count(*) AS n FROM a GROUP BY {k}) x
          JOIN (SELECT {k}, min(pos) AS pos, count(*) AS n FROM b GROUP BY {k}) y ON {on}
          WHERE x.n = 1 AND y.n = 1
            AND x.pos NOT IN (SELECT l_pos FROM p{i - 1}) AND y.pos NOT IN (SELECT r_pos FROM p{i - 1}))"""
        )
    return f"WITH {','.join(parts)} SELECT l_pos, r_pos FROM p{len(subsets)}"


@query(
    "diff_keyless",
    f"""
    WITH p AS ({_auto_sql()}), {fx.VERSION_CTES},
    a AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, * EXCLUDE (c_custkey) FROM parent),
    b AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, * EXCLUDE (c_custkey) FROM remote),
    j AS (SELECT x.pos AS xp, y.pos AS yp, x.c_name IS DISTINCT FROM y.c_name OR x.c_nationkey IS DISTINCT FROM y.c_nationkey
                 OR x.c_acctbal IS DISTINCT FROM y.c_acctbal OR x.c_mktsegment IS DISTINCT FROM y.c_mktsegment AS differs
          FROM a x LEFT JOIN p ON x.pos = p.l_pos FULL JOIN b y ON p.r_pos = y.pos)
    SELECT count(*) FILTER (xp IS NULL) AS row_inserts, count(*) FILTER (yp IS NULL) AS row_deletes,
           count(*) FILTER (xp IS NOT NULL AND yp IS NOT NULL AND differs) AS row_updates FROM j
    """,
)
def diff_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two tables without a key."""
    a, b = _numbered(spark, sf_dir)
    found = align.diff_without_key(a.drop("c_custkey"), b.drop("c_custkey"), "row_no")
    return found.summary().select("row_inserts", "row_deletes", "row_updates")


@query(
    "diff_reordered",
    """
    WITH t AS (SELECT max(o_orderkey) * 9 // 10 AS cut FROM orders)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CASE WHEN o_orderkey % 100 = 7 THEN '->' WHEN o_orderkey > cut THEN ':' ELSE '' END AS action,
           o_orderkey > cut AS moved
    FROM orders, t
    """,
)
def diff_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last tenth of the orders went to the front, and some statuses changed."""
    orders = table(spark, sf_dir, "orders")
    cut = orders.agg(F.expr("max(o_orderkey) * 9 div 10")).first()[0]
    changed = orders.withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 100 == 7, "changed").otherwise(F.col("o_orderstatus"))
    )
    a = with_position(orders, ["o_orderkey"], "row_no")
    b = with_position(changed, [(F.col("o_orderkey") <= cut).cast("int"), "o_orderkey"], "row_no")
    found = diff.diff(a, b, ["o_orderkey"], position="row_no").with_moves("row_no")
    kept = [F.col("l")[c].alias(c) for c in orders.columns if c != "o_orderkey"]
    return found.rows.select(*found.key_values(), *kept, "action", "moved")


@query("diff_auto", _auto_sql())
def diff_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows paired without a key, by whatever columns identify them."""
    a, b = _numbered(spark, sf_dir)
    return align.align_rows(a.drop("c_custkey"), b.drop("c_custkey"), "row_no")


@query(
    "diff_auto_repeated",
    """
    WITH a AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () // 2 AS mid FROM orders)
    SELECT pos AS l_pos, pos - CASE WHEN pos < mid THEN 1 ELSE 2 END AS r_pos FROM a WHERE pos NOT IN (0, mid)
    """,
)
def diff_auto_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven rows repeated over and over, and once without the first and a middle one: neighbours pair, two rows are gone."""
    orders = with_position(table(spark, sf_dir, "orders"), ["o_orderkey"], "nth")
    same = [F.concat(F.lit(f"{c} "), F.col("nth") % 7).alias(c) for c in orders.columns if c != "nth"]
    mid = orders.count() // 2
    a = orders.select("nth", *same)
    b = with_position(a.filter(~F.col("nth").isin(0, mid)), ["nth"], "row_no").drop("nth")
    return align.align_rows(a.withColumnRenamed("nth", "row_no"), b, "row_no")

"""Compares registered queries with their SQL on DuckDB, the way a grader would."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def normalize(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# DuckDB type of each Spark type
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(spark_df, con, sql: str) -> str | None:
    """None if columns, types and rows are equal, else what differs."""
    cursor = con.execute(sql)
    want_cols = [d[0] for d in cursor.description]
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    wrong = [(c, t, want_types.get(c)) for c, t in spark_df.dtypes if TYPES.get(t) != want_types.get(c)]
    if wrong:
        return f"types {wrong}"
    want = normalize(cursor.fetchall(), want_cols)
    got = normalize([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        missing = [r for r in want[1] if r not in set(got[1])][:2]
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        return f"rows {len(got[1])} != {len(want[1])}; missing {missing}; extra {extra}"[:900]
    return None


def main(names: list[str], sf_dir: str = "/root/testdata/sf0.01") -> int:
    from sparkmart.queries import ORACLES, QUERIES
    from sparkmart.runtime import local_session

    spark = local_session("oracle", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or sorted(QUERIES):
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
            else:
                problem = None if df.count() > 0 else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind:4} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

"""Equality of tables and comparison of whole table sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.comparison import EXACT, CompareOptions
from sparkmart.operators.diff import DELETE, INSERT, diff
from sparkmart.operators.quality import concat_reports

# fixed values: exit codes of the comparison gate
EQUAL, DIFFERENT, ERROR = 0, 1, 2


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: same shape, row counts, number of distinct rows whose counts differ, and equality.

    Rows are compared as multisets: of each row only two 64-bit hashes are shuffled and counted on both sides. Which
    columns are null is part of what is hashed, so that a null differs from an empty place beside it.
    For tables with an order, include the position column.
    """
    same_shape = a.dtypes == b.dtypes
    if not same_shape:
        left = a.select(F.count(F.lit(1)).alias("rows_a"))
        right = b.select(F.count(F.lit(1)).alias("rows_b"))
        sizes = left.withColumn("rows_b", F.lit(right.first()[0]))
        return sizes.select(
            F.lit(False).alias("same_columns"), "rows_a", "rows_b", F.lit(None).cast("long").alias("differing_rows"),
            F.lit(False).alias("equal"),
        )
    cells = [F.col(f"`{c}`") for c in a.columns]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "0").otherwise("1") for c in cells])
    marks = [F.xxhash64(F.lit(seed), nulls, *cells).alias(f"h{seed}") for seed in (1, 2)]
    tagged = a.select(*marks, F.lit(1).alias("in_a")).unionAll(b.select(*marks, F.lit(0).alias("in_a")))
    counted = tagged.groupBy("h1", "h2").agg(F.sum("in_a").alias("na"), F.sum(1 - F.col("in_a")).alias("nb"))
    sums = counted.agg(
        F.coalesce(F.sum("na"), F.lit(0)).alias("rows_a"),
        F.coalesce(F.sum("nb"), F.lit(0)).alias("rows_b"),
        F.count_if(F.col("na") != F.col("nb")).alias("differing_rows"),
    )
    return sums.select(
        F.lit(True).alias("same_columns"), "rows_a", "rows_b", "differing_rows", (F.col("differing_rows") == 0).alias("equal")
    )


def tables_equal(a: DataFrame, b: DataFrame) -> bool:
    return compare_tables(a, b).first()["equal"]


def gate(a: DataFrame, b: DataFrame) -> int:
    """0 if the tables are equal, 1 if they differ, 2 if they could not be compared."""
    try:
        return EQUAL if tables_equal(a, b) else DIFFERENT
    except Exception:
        return ERROR


def diff_tables(a: dict[str, DataFrame], b: dict[str, DataFrame], keys: dict[str, Sequence[str]],
                options: CompareOptions = EXACT, only: Sequence[str] | None = None,
                renames: dict[str, str] | None = None) -> DataFrame:
    """Summary per table, matched by name (or by ``renames``: old -> new); identical tables are left out."""
    renames = renames or {}
    names = [n for n in a if only is None or n in only]
    reports = []
    for name in names:
        other = renames.get(name, name)
        if other not in b:
            reports.append(_whole(a[name], name, DELETE))
            continue
        summary = diff(a[name], b[other], keys[name], options).summary().filter("different")
        reports.append(
            summary.select(
                F.lit(other).alias("table_name"), F.lit("").alias("action"), "row_inserts", "row_deletes", "row_updates",
                "col_inserts", "col_deletes", "col_updates",
            )
        )
    matched = {renames.get(n, n) for n in names}
    reports += [_whole(b[n], n, INSERT) for n in b if n not in matched and (only is None or n in only)]
    return concat_reports(reports)


def _whole(df: DataFrame, name: str, action: str) -> DataFrame:
    """Report line of a table that exists on one side only."""
    zero = F.lit(0).cast("long")
    rows, columns = F.count(F.lit(1)), F.lit(len(df.columns)).cast("long")
    new = action == INSERT
    return df.agg(rows.alias("n")).select(
        F.lit(name).alias("table_name"),
        F.lit(action).alias("action"),
        (F.col("n") if new else zero).alias("row_inserts"),
        (zero if new else F.col("n")).alias("row_deletes"),
        zero.alias("row_updates"),
        (columns if new else zero).alias("col_inserts"),
        (zero if new else columns).alias("col_deletes"),
        zero.alias("col_updates"),
    )

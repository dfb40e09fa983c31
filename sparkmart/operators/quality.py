"""Data quality: duplicates, nulls, types, ranges, constraints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.temporal import coerce_dates
from sparkmart.operators.position import expand_ranges
from sparkmart.operators.stats import known_value
from sparkmart.runtime import materialize


def concat_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """Union of the reports of several datasets; columns a report lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def duplicate_rows(datasets: dict[str, DataFrame]) -> DataFrame:
    """Every full-row duplicate but the first of its group, with the group size.

    The copies are counted with map-side partial sums and written out again from the count, so a
    group that holds a large part of the table is never gathered: it travels as one row, and its
    copies are produced in batches spread over the cluster.
    """
    return concat_reports([_duplicates(name, df) for name, df in datasets.items()])


def _duplicates(name: str, df: DataFrame) -> DataFrame:
    groups = _row_groups(df)
    copies = expand_ranges(groups.withColumn("__extra", F.col("group_size") - 1), "__extra", "__copy")
    return copies.select(F.lit(name).alias("dataset"), *df.columns, "group_size")


def _row_groups(df: DataFrame) -> DataFrame:
    """The rows that occur more than once, each once, with ``group_size``.

    All rows are compared by a hash first, so only eight bytes per row are shuffled; the rows whose hash
    repeats are then grouped by their values. The repeated hashes are written, so that Spark knows
    their number when it joins them.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    counts = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__hash")
    repeated = materialize(counts, "repeated-hashes")
    if repeated.isEmpty():
        return df.limit(0).withColumn("group_size", F.lit(0).cast("long"))
    suspects = hashed.join(repeated, "__hash", "left_semi")
    return suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """The first row of each key group in ``order_by`` order (its columns, then all others).

    An aggregate instead of a ranking window: copies are dropped before the shuffle.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys]
    ranked = order + [c for c in rest if c not in order]
    first = F.min(F.struct(*ranked)).alias("__first")
    kept = df.groupBy(*keys).agg(first)
    return kept.select([F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in df.columns])


def drop_duplicates(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """Keep the first row per key, but only if the table has full-row duplicates at all."""
    return df if _row_groups(df).isEmpty() else keep_first(df, keys, order_by)


def null_report(datasets: dict[str, DataFrame]) -> DataFrame:
    """Per column with at least one null: type, null count and percentage, whether it is a date."""
    return concat_reports([_nulls(name, coerce_dates(df)) for name, df in datasets.items()])


def _nulls(name: str, df: DataFrame) -> DataFrame:
    counts = [F.count_if(known_value(f).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema.fields)]
    one_row = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    lines = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("null_count"),
                (F.col(f"n{i}") / F.nullif("total", F.lit(0)) * 100).alias("null_percent"),
                F.lit(isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))).alias("is_date"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return one_row.select(F.lit(name).alias("dataset"), F.inline(lines)).filter("null_count > 0")


def sparse_columns(df: DataFrame, threshold: float) -> list[str]:
    """Names of the columns with more than ``threshold`` percent nulls."""
    report = _nulls("t", df).filter(F.col("null_percent") > threshold).select("column_name")
    return [row[0] for row in report.collect()]  # at most one row per column


def drop_sparse_columns(df: DataFrame, threshold: float = 20.0) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def violations_unique(df: DataFrame, column: str) -> DataFrame:
    """The values that occur more than once, with their count; nulls do not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def violations_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


@dataclass(frozen=True)
class Rule:
    """A load constraint on one column: not null, and for texts a maximal length."""

    column: str
    not_null: bool = True
    max_length: int | None = None

    def checks(self) -> list[tuple[str, str, Column]]:
        col = F.col(f"`{self.column}`")
        out = []
        if self.not_null:
            out.append((self.column, "not_null", col.isNull()))
        if self.max_length is not None:
            out.append((self.column, f"max_length_{self.max_length}", F.coalesce(F.length(col) > self.max_length, F.lit(False))))
        return out


def constraint_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per constraint with the number of rows that break it; a single pass."""
    checks = [check for rule in rules for check in rule.checks()]
    counted = df.agg(*[F.count_if(broken).alias(f"v{i}") for i, (_, _, broken) in enumerate(checks)])
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("rule"), F.col(f"v{i}").alias("violations"))
            for i, (c, k, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(lines))


class ConstraintError(ValueError):
    """Raised when a load would break a constraint; nothing has been written."""


def require(df: DataFrame, rules: Sequence[Rule]) -> None:
    broken = constraint_report(df, rules).filter("violations > 0").collect()
    if broken:
        raise ConstraintError("; ".join(f"{r['column_name']} {r['rule']}: {r['violations']} rows" for r in broken))


def validate(
    datasets: dict[str, DataFrame],
    expected_types: dict[str, str] | None = None,
    value_ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Type and inclusive range checks; a null in a range-checked numeric column is out of range."""
    expected_types, value_ranges = expected_types or {}, value_ranges or {}
    reports = []
    for name, df in datasets.items():
        ranged = [
            f.name for f in df.schema.fields if f.name in value_ranges and isinstance(f.dataType, T.NumericType)
        ]
        inside = [
            F.coalesce(F.bool_and(F.coalesce(F.col(f"`{c}`").between(*value_ranges[c]), F.lit(False))), F.lit(True)).alias(c)
            for c in ranged
        ]
        lines = []
        for f in df.schema.fields:
            if f.name in expected_types:
                actual, expected = f.dataType.simpleString(), expected_types[f.name]
                lines.append(_check(f.name, "Data Type", expected, F.lit(actual), F.lit(actual == expected)))
            if f.name in ranged:
                low, high = value_ranges[f.name]
                shown = F.when(F.col(f.name), "All values in range").otherwise("Out of range values exist")
                lines.append(_check(f.name, "Value Range", f"{low} to {high}", shown, F.col(f.name)))
        if lines:
            # without range checks no data is read: the types come from the schema
            base = df.agg(*inside) if inside else df.sparkSession.range(1)
            reports.append(base.select(F.lit(name).alias("dataset"), F.inline(F.array(*lines))))
    if not reports:
        raise ValueError("no column of the datasets has a check")
    return concat_reports(reports)


# fixed values above and here: names of the checks, their result texts
def _check(column: str, kind: str, expected: str, actual: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column_name"),
        F.lit(kind).alias("check_name"),
        F.lit(expected).alias("expected"),
        actual.alias("actual"),
        F.when(passed, "Pass").otherwise("Fail").alias("status"),
    )

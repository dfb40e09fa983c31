"""Row changes, column changes and blank trimming on whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.runtime import materialize


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition under which NULL matches NULL."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def apply_changes(
    table: DataFrame,
    conditions: Sequence[str],
    updates: DataFrame | None = None,
    deletes: DataFrame | None = None,
    inserts: DataFrame | None = None,
) -> DataFrame:
    """The table after UPDATE, DELETE and INSERT, as one rewrite.

    ``updates`` holds the condition columns and the columns to set, ``deletes`` the condition
    columns. Repeated updates count once; unlike ones for the same condition values are refused, as neither is the
    last. NULL condition values match NULL.
    The changes are written first, so that Spark knows their size: a condition may hit a large part of
    the table, and a small change set is then broadcast instead of gathering those rows by condition.
    """
    out = table
    if deletes is not None:
        gone = materialize(deletes.select(*[F.col(c).alias(f"__{c}") for c in conditions]).distinct(), "deletes")
        out = out.join(gone, null_safe(out, gone, [(c, f"__{c}") for c in conditions]), "left_anti")
    if updates is not None:
        assigned = [c for c in updates.columns if c not in conditions]
        new = materialize(
            updates.select(*[F.col(c).alias(f"__{c}") for c in conditions], F.struct(*assigned).alias("__new")).distinct(), "updates"
        )
        if not new.groupBy(*[f"__{c}" for c in conditions]).count().where("count > 1").isEmpty():
            raise ValueError(f"unlike updates for the same values of {', '.join(conditions)}")
        joined = out.join(new, null_safe(out, new, [(c, f"__{c}") for c in conditions]), "left")
        hit = F.col("__new").isNotNull()
        out = joined.select(
            [
                F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in assigned else F.col(c)
                for c in table.columns
            ]
        )
    if inserts is not None:
        out = out.unionByName(inserts, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class ColumnSpec:
    """A column of the altered table: taken from ``source`` (None adds it empty), with an optional new type."""

    name: str
    source: str | None = None
    type: str | None = None
    default: object = None


def alter_columns(table: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Rename, drop, add, retype and reorder columns, keeping the data. Unlisted columns are dropped."""
    out = []
    for spec in columns:
        value = F.col(f"`{spec.source}`") if spec.source is not None else F.lit(spec.default)
        if spec.type is not None:
            value = value.try_cast(spec.type)
        out.append(value.alias(spec.name))
    return table.select(out)


def move_columns(table: DataFrame, fate: Sequence[int]) -> DataFrame:
    """Place column i at index ``fate[i]``; -1 drops it."""
    placed = sorted((target, name) for name, target in zip(table.columns, fate) if target >= 0)
    return table.select([F.col(f"`{name}`") for _, name in placed])


def _blank(name: str) -> Column:
    text = F.col(f"`{name}`").cast("string")
    return text.isNull() | (text == "")


def trim_blank(table: DataFrame, position: str) -> DataFrame:
    """Drop trailing all-blank rows, then trailing columns that are blank in every row.

    The table is a positional grid whose header, if any, is its first row; ``position`` is a column
    with the row order.
    """
    cells = [c for c in table.columns if c != position]
    all_blank = F.lit(True)
    for c in cells:
        all_blank = all_blank & _blank(c)
    filled = [F.max(~_blank(c)).alias(f"f{i}") for i, c in enumerate(cells)]
    found = table.agg(F.max(F.when(~all_blank, F.col(position))).alias("last"), *filled).first()
    if found["last"] is None:
        return table.limit(0)
    kept = table.filter(F.col(position) <= found["last"])
    width = len(cells)
    while width and not found[f"f{width - 1}"]:
        width -= 1
    return kept.select(position, *cells[:width])


def swap_table(df: DataFrame, table: str) -> None:
    """Replace a catalog table by a version of itself.

    The new version is written first and the old one is dropped last, after the names were exchanged, so a crash
    between two steps leaves the old rows under one of the two names.
    """
    spark = df.sparkSession
    following, previous = f"{table}__next", f"{table}__previous"
    for name in (following, previous):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format("parquet").saveAsTable(following)
    spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE {previous}")

"""Comparisons as a table of texts, and patches made from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.text import escape_null, unescape_null
from sparkmart.operators.changes import null_safe
from sparkmart.operators.diff import DELETE, GAIN, INSERT, MOVE, SAME, SKIP, UPDATE, TableDiff, schema_diff

# fixed values: name of the action column and the action of the schema line
ACTION_COLUMN, SCHEMA_LINE = "@@", "!"
ORDER_COLUMN = "row_order"


def arrow(tables: Sequence[DataFrame]) -> str:
    """The shortest arrow ``->``, ``-->``, ... that occurs in no cell; one pass per table.

    A cell holds an arrow of n dashes exactly if it holds a '>' after at least n dashes.
    """
    longest = 0
    for table in tables:
        runs = [
            F.coalesce(
                F.array_max(
                    F.transform(F.regexp_extract_all(F.col(f"`{c}`").cast("string"), F.lit("(-+)>"), F.lit(1)), F.length)
                ),
                F.lit(0),
            )
            for c in table.columns
        ]
        widest = F.greatest(*runs, F.lit(0)) if runs else F.lit(0)
        longest = max(longest, table.agg(F.max(widest)).first()[0] or 0)
    return "-" * (longest + 1) + ">"


def flatten(diff: TableDiff, everything: bool = False, position: str | None = None, context: int | None = None) -> DataFrame:
    """The comparison as texts: action column ``@@``, then one column per column of either table.

    Updated rows have the arrow as action and ``old->new`` in the changed cells, where NULL is written
    as a literal. Columns that were added, removed, renamed or moved are told by a line with action ``!``.

    With ``position``, the row number that both tables carry, the lines are numbered in ``row_order``: merged order,
    the schema line before all. ``context`` then adds so many unchanged rows around changes, and ``...`` where rows
    are left out.
    """
    a, b = (diff.a.drop(position), diff.b.drop(position)) if position else (diff.a, diff.b)
    sign = arrow([a, b])
    schema = schema_diff(a, b, diff.renames)
    source = {y: x for x, y in diff.columns.common}
    if position:
        rows = diff.in_merged_order(position, ORDER_COLUMN)
        if not everything and context is not None:
            shown = diff.with_context(position, context).select(ORDER_COLUMN, F.col("action").alias("__shown"))
            rows = rows.join(shown, ORDER_COLUMN).withColumn("action", F.col("__shown")).drop("__shown")
        elif not everything:
            rows = rows.filter(F.col("action") != SAME)
    else:
        rows = diff.rows if everything else diff.changes_only()
    numbered = [F.col(ORDER_COLUMN)] if position else []
    cells = [*numbered, F.when(F.col("action") == UPDATE, sign).otherwise(F.col("action")).alias(ACTION_COLUMN)]
    for entry in schema:
        c = entry.column
        if entry.action == INSERT:
            value = F.col("r")[c].cast("string")
        elif entry.action == DELETE:
            value = F.col("l")[c].cast("string")
        else:
            old, new = F.col("l")[source[c]], F.col("r")[c]
            shown = F.when(F.col("action") == INSERT, new.cast("string")).otherwise(old.cast("string"))
            value = F.when(
                F.array_contains("changed", c), F.concat(escape_null(old), F.lit(sign), escape_null(new))
            ).otherwise(shown)
        cells.append(F.when(F.col("action") != SKIP, value).alias(c))
    flat = rows.select(cells)
    if any(e.action != SAME for e in schema):
        line = diff.a.sparkSession.createDataFrame(
            [(*([-1] if position else []), SCHEMA_LINE, *[e.action for e in schema])], flat.schema
        )
        flat = line.unionByName(flat)
    return flat


@dataclass(frozen=True)
class Patched:
    """The patched table, and the update cells left alone because their old value was not found."""

    table: DataFrame
    rejected: DataFrame


def apply_diff(table: DataFrame, diff: TableDiff) -> Patched:
    """Apply a typed comparison to a table with the same key.

    Unlike the text form it also carries blank texts of added columns.
    """
    names = dict((x, y) for x, y in diff.columns.common)
    keys = list(diff.keys)
    gains = [F.col("r")[c].isNotNull() for c in diff.columns.added]
    relevant = reduce(lambda x, y: x | y, gains, F.col("action") != SAME)
    edits = diff.rows.filter(relevant).select(
        *[c.alias(f"__{k}") for c, k in zip(diff.key_values(), keys)], "action", "changed", "l", "r"
    )
    # a key that repeats is only ever deleted; one row of it is enough to find all its rows
    gone = edits.filter(F.col("action") == DELETE).select([F.col(f"__{k}") for k in keys]).distinct()
    left = table.join(gone, null_safe(table, gone, [(k, f"__{k}") for k in keys]), "left_anti")
    pending = edits.filter(~F.col("action").isin(INSERT, DELETE))
    kept = left.join(pending, null_safe(left, pending, [(k, f"__{k}") for k in keys]), "left")
    touched = F.col("action").isNotNull()

    def edited(x: str, y: str) -> Column:
        return touched & F.array_contains("changed", y)

    def cell(c: str, source: str | None) -> Column:
        if source is None:
            return F.when(touched, F.col("r")[c])
        fits = F.col(f"`{source}`").eqNullSafe(F.col("l")[source])
        return F.when(edited(source, c) & fits, F.col("r")[c]).otherwise(F.col(f"`{source}`"))

    source = {y: x for x, y in diff.columns.common}
    columns = [c for c in diff.b.columns if c not in source or source[c] in table.columns]
    patched = kept.select([cell(c, source.get(c)).alias(c) for c in columns])
    inserted = edits.filter(F.col("action") == INSERT).select([F.col("r")[c].alias(c) for c in columns])
    entries = [
        F.when(
            edited(x, y) & ~F.col(f"`{x}`").eqNullSafe(F.col("l")[x]),
            F.struct(
                F.lit(y).alias("column_name"),
                F.col("l")[x].cast("string").alias("expected"),
                F.col(f"`{x}`").cast("string").alias("found"),
                F.col("r")[y].cast("string").alias("wanted"),
            ),
        )
        for x, y in names.items()
        if x in table.columns
    ]
    rejected = kept.select(*[left[k] for k in keys], F.inline(F.array_compact(F.array(*entries))))
    return Patched(patched.unionByName(inserted), rejected)


@dataclass(frozen=True)
class FlatPatch:
    """A text patch taken apart: its column changes and its row edits."""

    schema: dict[str, str]
    rows: DataFrame


def read_flat(flat: DataFrame) -> FlatPatch:
    """Take a text comparison apart. The arrow of a row is its action, so it needs no further search."""
    columns = [c for c in flat.columns if c not in (ACTION_COLUMN, ORDER_COLUMN)]
    line = flat.filter(F.col(ACTION_COLUMN) == SCHEMA_LINE).first()
    schema = {c: (line[c] or "") if line is not None else "" for c in columns}
    return FlatPatch(schema, flat.filter(~F.col(ACTION_COLUMN).isin(SCHEMA_LINE, SKIP)).drop(ORDER_COLUMN))


def apply_flat(table: DataFrame, flat: DataFrame, keys: Sequence[str], types: dict[str, str] | None = None) -> Patched:
    """Apply a text comparison to a table.

    Rows are found by the text of their key. ``types`` gives the types of added columns (text if absent).
    """
    patch = read_flat(flat)
    types = types or {}
    added = [c for c, action in patch.schema.items() if action.endswith(INSERT)]
    removed = [c for c, action in patch.schema.items() if action.endswith(DELETE)]
    renamed = {c: a.lstrip(MOVE)[1:-1] for c, a in patch.schema.items() if a.lstrip(MOVE).startswith("(")}
    final = [c for c in patch.schema if c not in removed]
    source = {c: renamed.get(c, c) for c in final if c not in added}
    old_types = dict(table.dtypes)
    new_types = {c: types.get(c, "string") if c in added else old_types[source[c]] for c in final}
    keys_new = {k: next((c for c, s in source.items() if s == k), k) for k in keys}

    sign = F.col(ACTION_COLUMN)
    is_update = F.endswith(sign, F.lit(UPDATE))
    edits = patch.rows
    key_cells = [F.col(f"`{keys_new[k]}`").alias(f"__k_{k}") for k in keys]
    by_key = [(f"__t_{k}", f"__k_{k}") for k in keys]
    text_keys = table.select("*", *[F.col(f"`{k}`").cast("string").alias(f"__t_{k}") for k in keys])
    gone = edits.filter(sign == DELETE).select(key_cells).distinct()
    left = text_keys.join(gone, null_safe(text_keys, gone, by_key), "left_anti")
    lookup = edits.filter(is_update | (sign == GAIN)).select(*key_cells, F.struct(*edits.columns).alias("__e"))
    kept = left.join(lookup, null_safe(left, lookup, by_key), "left")
    action = F.col("__e")[ACTION_COLUMN]

    def halves(c: str) -> tuple[Column, Column, Column]:
        text = F.col("__e")[c]
        at = F.instr(text, action)
        edited = F.coalesce(F.endswith(action, F.lit(UPDATE)) & (at > 0), F.lit(False))
        old = F.substring(text, F.lit(1), at - 1)
        new = F.substring(text, at + F.length(action), F.length(text))
        return edited, unescape_null(old), unescape_null(new)

    cells, entries = [], []
    for c in final:
        if c in added:
            cells.append(F.col("__e")[c].cast(new_types[c]).alias(c))
            continue
        current = F.col(f"`{source[c]}`")
        edited, old, new = halves(c)
        fits = current.cast("string").eqNullSafe(old)
        cells.append(F.when(edited & fits, new.cast(new_types[c])).otherwise(current).alias(c))
        entries.append(
            F.when(
                edited & ~fits,
                F.struct(
                    F.lit(c).alias("column_name"),
                    old.alias("expected"),
                    current.cast("string").alias("found"),
                    new.alias("wanted"),
                ),
            )
        )
    inserted = edits.filter(sign == INSERT).select([F.col(f"`{c}`").cast(new_types[c]).alias(c) for c in final])
    rejected = kept.select(*[F.col(f"`{k}`") for k in keys], F.inline(F.array_compact(F.array(*entries))))
    return Patched(kept.select(cells).unionByName(inserted), rejected)

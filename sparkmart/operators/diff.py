"""Keyed comparison of two tables: row actions, changed cells, summary, schema, context."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.comparison import EXACT, CompareOptions
from sparkmart.functions.text import key_part
from sparkmart.operators.moves import moved_items, moved_rows
from sparkmart.operators.position import with_neighbourhood, with_position
from sparkmart.runtime import materialize

# fixed values: row and column actions
INSERT, DELETE, UPDATE, GAIN, MOVE, SAME, SKIP = "+++", "---", "->", "+", ":", "", "..."


@dataclass(frozen=True)
class ColumnPairs:
    """How the columns of two tables line up; pairs are (name in a, name in b)."""

    common: tuple[tuple[str, str], ...]
    added: tuple[str, ...]
    removed: tuple[str, ...]


def pair_columns(a: DataFrame, b: DataFrame, renames: dict[str, str] | None = None) -> ColumnPairs:
    """Columns pair by name, or by ``renames`` (old name -> new name)."""
    renames = renames or {}
    common = [(c, renames.get(c, c)) for c in a.columns if renames.get(c, c) in b.columns]
    left, right = {x for x, _ in common}, {y for _, y in common}
    return ColumnPairs(
        tuple(common), tuple(c for c in b.columns if c not in right), tuple(c for c in a.columns if c not in left)
    )


def _plain_key(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))


def key_columns(tables: Sequence[DataFrame], keys: Sequence[Sequence[str]], options: CompareOptions) -> list[list[Column]]:
    """Comparable key expressions per table.

    Numbers and times of equal type are used as they are. Texts are normalised: blank keys (null, '',
    'null', 'undefined') are all the same, and NULL where the key is a single column.
    """
    alone = len(keys[0]) == 1
    out: list[list[Column]] = [[] for _ in tables]
    for place in range(len(keys[0])):
        types = [t.schema[k[place]].dataType for t, k in zip(tables, keys)]
        plain = _plain_key(types[0]) and len(set(map(str, types))) == 1
        for i, (table, k) in enumerate(zip(tables, keys)):
            column = F.col(f"`{k[place]}`")
            text = key_part(column, options.ignore_whitespace, options.ignore_case)
            text = F.nullif(text, F.lit("")) if alone else text
            out[i].append((column if plain else text).alias(f"__k{place}"))
    return out


def _blank_key(names: Sequence[str]) -> Column:
    """A one-column key that is blank never pairs."""
    return F.lit(False) if len(names) > 1 else F.col(names[0]).isNull()


def same_key(pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition on the key. A single column needs no null-safe test, which leaves the plain column
    as join key, so that tables already bucketed or partitioned by it are not shuffled again."""
    if len(pairs) == 1:
        return F.col(pairs[0][0]) == F.col(pairs[0][1])
    return reduce(lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


def split_by_uniqueness(sides: Sequence[DataFrame], names: Sequence[str]) -> tuple[list[DataFrame], list[DataFrame | None]]:
    """Split the sides into rows whose key occurs at most once per side, and all other rows.

    Only the key columns are counted, with map-side partial sums, so a key that holds much of a table
    is no hot spot; its rows are then separated from the wide tables before those are joined.
    """
    tagged = reduce(
        lambda x, y: x.unionByName(y), [s.select(*names, F.lit(i).alias("__side")) for i, s in enumerate(sides)]
    )
    counts = tagged.groupBy(*names).agg(
        *[F.count_if(F.col("__side") == i).alias(f"n{i}") for i in range(len(sides))]
    )
    repeated = reduce(lambda x, y: x | y, [F.col(f"n{i}") > 1 for i in range(len(sides))]) | _blank_key(names)
    # written, so that Spark knows their size: few keys are broadcast, many are joined by a shuffle
    odd = materialize(counts.filter(repeated).select(*[F.col(k).alias(f"__odd_{k}") for k in names]), "repeated-keys")
    if odd.isEmpty():
        return list(sides), [None] * len(sides)

    def on(side: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [side[k].eqNullSafe(odd[f"__odd_{k}"]) for k in names])

    return [s.join(odd, on(s), "left_anti") for s in sides], [s.join(odd, on(s), "left_semi") for s in sides]


def pair_rows(a: DataFrame, b: DataFrame, keys: Sequence[str], options: CompareOptions = EXACT,
              renames: dict[str, str] | None = None, unique: bool = False) -> DataFrame:
    """Rows ``(l, r)``: the two rows of a key that each table holds exactly once, all others alone.

    ``unique`` says that the key is known to be unique, which saves counting it.
    """
    renames = renames or {}
    names = [f"__k{i}" for i in range(len(keys))]
    ka, kb = key_columns([a, b], [list(keys), [renames.get(k, k) for k in keys]], options)
    left = a.select(*ka, F.struct(*[F.col(f"`{c}`") for c in a.columns]).alias("l"))
    right = b.select(*kb, F.struct(*[F.col(f"`{c}`") for c in b.columns]).alias("r"))
    if unique:
        (one_l, one_r), (many_l, many_r) = (left, right), (None, None)
    else:
        (one_l, one_r), (many_l, many_r) = split_by_uniqueness([left, right], names)
    one_r = one_r.select(*[F.col(k).alias(f"r{k}") for k in names], "r")
    paired = one_l.join(one_r, same_key([(k, f"r{k}") for k in names]), "full_outer").select("l", "r")
    if many_l is None:
        return paired
    return paired.unionByName(many_l.select("l"), allowMissingColumns=True).unionByName(
        many_r.select("r"), allowMissingColumns=True
    )


@dataclass(frozen=True)
class TableDiff:
    """A classified comparison: ``rows`` has action, changed (names in b), l and r."""

    rows: DataFrame
    columns: ColumnPairs
    keys: tuple[str, ...]
    a: DataFrame
    b: DataFrame
    options: CompareOptions
    renames: dict[str, str]

    def key_values(self) -> list[Column]:
        return [
            F.coalesce(F.col("r")[self.renames.get(k, k)].cast(self.a.schema[k].dataType), F.col("l")[k]).alias(k)
            for k in self.keys
        ]

    def changes_only(self) -> DataFrame:
        return self.rows.filter(F.col("action") != SAME)

    def only(self, *actions: str) -> "TableDiff":
        """Keep the rows with these actions, as the insert / delete / update filters do."""
        return replace(self, rows=self.rows.filter(F.col("action").isin(*actions)))

    def row_actions(self) -> DataFrame:
        """(key, action, changed columns as text) of every row."""
        return self.rows.select(*self.key_values(), "action", F.array_join("changed", ",").alias("changed_columns"))

    def cells(self) -> DataFrame:
        """(key, column, old, new) of every changed cell, values as text."""
        entries = [
            F.when(
                F.array_contains("changed", y),
                F.struct(
                    F.lit(y).alias("column_name"),
                    F.col("l")[x].cast("string").alias("old_value"),
                    F.col("r")[y].cast("string").alias("new_value"),
                ),
            )
            for x, y in self.columns.common
        ]
        updated = self.rows.filter(F.col("action") == UPDATE)
        return updated.select(*self.key_values(), F.inline(F.array_compact(F.array(*entries))))

    def column_activity(self) -> DataFrame:
        """One row per column of either table: schema action and number of updated cells; one pass."""
        counted = self.rows.agg(
            *[F.count_if(F.array_contains("changed", y)).alias(f"u{i}") for i, (_, y) in enumerate(self.columns.common)],
            F.count_if(F.col("action") == INSERT).alias("__ins"),
        )
        schema = {e.column: e for e in schema_diff(self.a, self.b, self.renames)}
        place = {y: i for i, (_, y) in enumerate(self.columns.common)}
        entries = [
            F.struct(
                F.lit(e.column).alias("column_name"),
                F.lit(e.action).alias("action"),
                F.lit(e.old_type).alias("old_type"),
                F.lit(e.new_type).alias("new_type"),
                (F.col(f"u{place[c]}") if c in place else F.lit(0).cast("long")).alias("updated_cells"),
            )
            for c, e in schema.items()
        ]
        return counted.select(F.inline(F.array(*entries)))

    def active_columns(self, context: int = 0) -> list[str]:
        """Columns of b worth showing: keys, changed and new ones, all of them if rows were inserted."""
        names = list(self.b.columns)
        row = self.rows.agg(
            F.max((F.col("action") == INSERT).cast("int")).alias("__ins"),
            *[F.max(F.array_contains("changed", y).cast("int")).alias(y) for _, y in self.columns.common],
        ).first()
        keys = {self.renames.get(k, k) for k in self.keys}
        active = [
            i for i, c in enumerate(names) if row["__ins"] or c in keys or c in self.columns.added or (row[c] or 0) > 0
        ]
        return [c for i, c in enumerate(names) if any(abs(i - j) <= context for j in active)]

    def pruned(self, context: int = 0) -> DataFrame:
        """Changed rows with the columns worth showing; deleted rows show their old values."""
        source = {y: x for x, y in self.columns.common}
        cells = [
            F.when(F.col("r").isNotNull(), F.col("r")[c]).otherwise(
                F.col("l")[source[c]] if c in source else F.lit(None)
            ).alias(c)
            for c in self.active_columns(context)
        ]
        return self.changes_only().select("action", *cells)

    def summary(self) -> DataFrame:
        """Counts of row and column changes, initial and final sizes, and whether anything differs.

        A column whose type changed counts as updated, whatever its values. Reordered rows are counted after :meth:`with_moves`.
        """
        schema = schema_diff(self.a, self.b, self.renames)
        inserts = sum(e.action.endswith(INSERT) for e in schema)
        deletes = sum(e.action.endswith(DELETE) for e in schema)
        renamed = sum("(" in e.action for e in schema)
        moved = sum(e.action.startswith(MOVE) for e in schema)
        retyped = {e.column for e in schema if e.old_type is not None and e.new_type is not None and e.old_type != e.new_type}
        updated = [
            F.lit(1).cast("long") if y in retyped else F.max(F.array_contains("changed", y).cast("long")) for _, y in self.columns.common
        ]
        col_updates = reduce(lambda x, y: x + y, [F.coalesce(u, F.lit(0)) for u in updated], F.lit(0).cast("long"))
        counts = self.rows.agg(
            F.count_if(F.col("action") == INSERT).alias("row_inserts"),
            F.count_if(F.col("action") == DELETE).alias("row_deletes"),
            F.count_if(F.col("action") == UPDATE).alias("row_updates"),
            (F.count_if("moved") if "moved" in self.rows.columns else F.lit(0).cast("long")).alias("row_reorders"),
            F.lit(inserts).cast("long").alias("col_inserts"),
            F.lit(deletes).cast("long").alias("col_deletes"),
            col_updates.alias("col_updates"),
            F.lit(renamed).cast("long").alias("col_renames"),
            F.lit(moved).cast("long").alias("col_reorders"),
            F.count("l").alias("row_count_initial"),
            F.count("r").alias("row_count_final"),
            F.lit(len(self.a.columns)).cast("long").alias("col_count_initial"),
            F.lit(len(self.b.columns)).cast("long").alias("col_count_final"),
        )
        parts = ("row_inserts", "row_deletes", "row_updates", "row_reorders", "col_inserts", "col_deletes",
                 "col_updates", "col_renames", "col_reorders")
        return counts.withColumn("different", reduce(lambda x, y: x + y, [F.col(p) for p in parts]) > 0)

    def positions(self, position: str) -> tuple[Column, Column]:
        return F.col("l")[position], F.col("r")[position]

    def provenance(self, position: str) -> DataFrame:
        """Changed rows with source and target row number as ``l:r`` text ('-' on the missing side)."""
        l_pos, r_pos = self.positions(position)
        link = F.concat(
            F.coalesce(l_pos.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(r_pos.cast("string"), F.lit("-"))
        )
        return self.changes_only().select(link.alias("rows"), *self.key_values(), "action")

    def with_moves(self, position: str) -> "TableDiff":
        """Mark rows that changed place: otherwise unchanged ones get the action ``:``, and ``moved`` is set on all."""
        l_pos, r_pos = self.positions(position)
        both = self.rows.filter("l IS NOT NULL AND r IS NOT NULL")
        moved = moved_rows(both.select(l_pos.alias("__l"), r_pos.alias("__r")), "__l", "__r")
        places = materialize(moved.select(F.col("__r").alias("__moved_to")), "moved")
        marked = self.rows.join(places, r_pos == F.col("__moved_to"), "left").withColumn(
            "moved", F.col("__moved_to").isNotNull() & F.col("l").isNotNull()
        )
        action = F.when(F.col("moved") & F.col("action").isin(SAME, GAIN), MOVE).otherwise(F.col("action"))
        return replace(self, rows=marked.withColumn("action", action).drop("__moved_to"))

    def in_merged_order(self, position: str, name: str = "row_order") -> DataFrame:
        """All rows numbered by target position, deleted rows by their source position and before the row there."""
        l_pos, r_pos = self.positions(position)
        placed = self.rows.withColumns({"__at": F.coalesce(r_pos, l_pos), "__side": F.col("r").isNotNull()})
        return with_position(placed, ["__at", "__side"], name=name).drop("__at", "__side")

    def with_context(self, position: str, context: int) -> DataFrame:
        """Changed rows, unchanged ones within ``context`` rows of a change, and ``...`` where rows are left out.

        Rows are in merged order. The distance to a change is found inside position blocks that overlap by
        ``context + 1`` rows, so no window spans the table.
        """
        ordered = self.in_merged_order(position, "__order")
        first = ordered.filter(F.col("action") != SAME).agg(F.min("__order")).first()[0]
        if first is None:
            return ordered.limit(0).select(F.col("__order").alias("row_order"), *self.key_values(), "action")
        blocks = with_neighbourhood(ordered, "__order", context + 1)
        changed_at = F.when(F.col("action") != SAME, F.col("__order"))
        window = Window.partitionBy("__block").orderBy("__order")
        near = blocks.withColumns(
            {
                "__prev": F.max(changed_at).over(window.rowsBetween(-(context + 1), 0)),
                "__next": F.min(changed_at).over(window.rowsBetween(0, context + 1)),
            }
        ).filter("__own")
        since = F.col("__order") - F.col("__prev")
        until = F.col("__next") - F.col("__order")
        shown = F.coalesce(since <= context, F.lit(False)) | F.coalesce(until <= context, F.lit(False))
        # one mark per gap: after the change above it, or before the very first change
        mark = ~shown & (F.coalesce(since == context + 1, F.lit(False)) | (F.col("__order") == first - context - 1))
        return (
            near.filter(shown | mark)
            .withColumn("action", F.when(mark, F.lit(SKIP)).otherwise(F.col("action")))
            .select(F.col("__order").alias("row_order"), *self.key_values(), "action")
        )


def diff(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    options: CompareOptions = EXACT,
    renames: dict[str, str] | None = None,
    unique: bool = False,
    position: str | None = None,
) -> TableDiff:
    """Compare two tables by key. ``position`` names a row-number column that is carried, not compared."""
    rows = pair_rows(a, b, keys, options, renames, unique)
    return classify(rows, a, b, keys, options, renames, position)


def classify(
    rows: DataFrame, a: DataFrame, b: DataFrame, keys: Sequence[str], options: CompareOptions = EXACT,
    renames: dict[str, str] | None = None, position: str | None = None,
) -> TableDiff:
    """Give paired rows their action."""
    if position is not None:
        columns = pair_columns(a.drop(position), b.drop(position), renames)
    else:
        columns = pair_columns(a, b, renames)
    ignored = set(options.ignore_columns)
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    differs = [
        F.when(~options.equal(F.col("l")[x], F.col("r")[y], (a.schema[x].dataType, b.schema[y].dataType)), F.lit(y))
        for x, y in columns.common
        if x not in ignored and y not in ignored
    ]
    changed = F.when(both, F.array_compact(F.array(*differs))).otherwise(F.array().cast("array<string>"))
    gained = F.lit(False)
    for c in columns.added:
        if c not in ignored:
            gained = gained | F.coalesce(F.col("r")[c].cast("string") != "", F.lit(False))
    staged = rows.withColumn("changed", changed)
    action = (
        F.when(F.col("l").isNull(), INSERT)
        .when(F.col("r").isNull(), DELETE)
        .when(F.size("changed") > 0, UPDATE)
        .when(gained, GAIN)
        .otherwise(SAME)
    )
    plain_a = a.drop(position) if position else a
    plain_b = b.drop(position) if position else b
    return TableDiff(
        staged.withColumn("action", action), columns, tuple(keys), plain_a, plain_b, options, dict(renames or {})
    )


class KeyMismatch(ValueError):
    """The tables have no primary key, or not the same one."""


def diff_by_primary_key(a: DataFrame, b: DataFrame, key_a: Sequence[str], key_b: Sequence[str],
                        options: CompareOptions = EXACT) -> TableDiff:
    """Comparison of two tables by their declared primary key, which makes it a single join."""
    if not key_a or list(key_a) != list(key_b):
        raise KeyMismatch(f"primary keys differ or are missing: {list(key_a)} and {list(key_b)}")
    return diff(a, b, key_a, options, unique=True)


@dataclass(frozen=True)
class ColumnChange:
    column: str
    action: str
    old_name: str | None
    old_type: str | None
    new_type: str | None


def schema_diff(a: DataFrame, b: DataFrame, renames: dict[str, str] | None = None) -> list[ColumnChange]:
    """Column changes from the schemas alone: '+++', '---', '(old name)', ':' in front when moved."""
    pairs = pair_columns(a, b, renames)
    types_a, types_b = dict(a.dtypes), dict(b.dtypes)
    source = {y: x for x, y in pairs.common}
    common_in_a = [y for _, y in pairs.common]
    moved = set(moved_items(common_in_a, [c for c in b.columns if c in source]))
    out = []
    for c in b.columns:
        if c not in source:
            out.append(ColumnChange(c, INSERT, None, None, types_b[c]))
            continue
        old = source[c]
        action = (MOVE if c in moved else "") + (f"({old})" if old != c else "")
        out.append(ColumnChange(c, action, old, types_a[old], types_b[c]))
    out.extend(ColumnChange(c, DELETE, c, types_a[c], None) for c in pairs.removed)
    return out


def propose_renames(a: DataFrame, b: DataFrame, position: str) -> dict[str, str]:
    """Columns that look renamed: a removed and an added one with the same text at every position.

    Each column is reduced to the number of its values and to two sums of hashes of (position, text), in one pass per table.
    """
    pairs = pair_columns(a, b)

    def marks(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
        if not columns:
            return {}
        wanted = []
        for i, c in enumerate(columns):
            text = F.col(f"`{c}`").cast("string")
            hashes = [F.xxhash64(F.lit(seed), F.col(position), text).cast("decimal(38,0)") for seed in (1, 2)]
            wanted.append(F.struct(F.count(text), *[F.sum(F.when(text.isNotNull(), h)) for h in hashes]).alias(f"m{i}"))
        row = df.agg(*wanted).first()
        return {c: tuple(row[f"m{i}"]) for i, c in enumerate(columns)}

    old, new = marks(a, pairs.removed), marks(b, pairs.added)
    found: dict[str, str] = {}
    for x, mark in old.items():
        match = next((y for y, other in new.items() if other == mark and y not in found.values()), None)
        if match is not None and mark[0] > 0:
            found[x] = match
    return found

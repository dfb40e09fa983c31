"""Three-way comparison and merge against a common parent."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.comparison import EXACT, CompareOptions
from sparkmart.operators.diff import DELETE, GAIN, INSERT, SAME, UPDATE, key_columns, same_key, split_by_uniqueness
from sparkmart.operators.position import expand_ranges

# fixed values: the conflict action and the text of a conflicting cell
CONFLICT = "!->"
CONFLICT_TEXT = ("((( ", " ))) ", " /// ")


def align_three(parent: DataFrame, local: DataFrame, remote: DataFrame, keys: Sequence[str],
                options: CompareOptions = EXACT) -> DataFrame:
    """Rows ``(p, l, r, loose)`` by key. Keys that repeat in a table, or are blank, do not pair and stay alone: ``loose``.

    The distinct keys of the three tables are the spine; each table is joined to it once. The joins share
    one partitioning and order by key, so each wide table is shuffled and sorted once.
    """
    tables, tags = [parent, local, remote], ["p", "l", "r"]
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = key_columns(tables, [list(keys)] * 3, options)
    sides = [
        t.select(*k, F.struct(*[F.col(f"`{c}`") for c in t.columns]).alias(tag)) for t, k, tag in zip(tables, keyed, tags)
    ]
    single, repeated = split_by_uniqueness(sides, names)
    rows = reduce(lambda x, y: x.unionByName(y), [s.select(*names) for s in single]).distinct()
    for side, tag in zip(single, tags):
        named = side.select(*[F.col(k).alias(f"{tag}{k}") for k in names], tag)
        rows = rows.join(named, same_key([(k, f"{tag}{k}") for k in names]), "left")
    rows = rows.select(*tags, F.lit(False).alias("loose"))
    for side, tag in zip(repeated, tags):
        if side is not None:
            rows = rows.unionByName(side.select(tag, F.lit(True).alias("loose")), allowMissingColumns=True)
    return rows


@dataclass(frozen=True)
class ThreeWay:
    """A three-way comparison; ``rows`` has the structs p, l and r."""

    rows: DataFrame
    parent: DataFrame
    local: DataFrame
    remote: DataFrame
    keys: tuple[str, ...]
    options: CompareOptions

    def key_values(self) -> list[Column]:
        return [F.coalesce(F.col("l")[k], F.col("r")[k], F.col("p")[k]).alias(k) for k in self.keys]

    def _shared(self) -> list[str]:
        """Columns all three tables have."""
        return [c for c in self.local.columns if c in self.parent.columns and c in self.remote.columns]

    def _cell(self, c: str) -> tuple[Column, Column, Column]:
        return F.col("p")[c], F.col("l")[c], F.col("r")[c]

    def _same(self, c: str, x: str, y: str) -> Column:
        """Whether two of the tables, by their tags, agree in column ``c``."""
        of = {"p": self.parent, "l": self.local, "r": self.remote}
        return self.options.equal(F.col(x)[c], F.col(y)[c], (of[x].schema[c].dataType, of[y].schema[c].dataType))

    def _remote_changed(self, c: str) -> Column:
        return ~self._same(c, "p", "r")

    def _conflict(self, c: str) -> Column:
        """Changed on both sides, to different values."""
        return ~self._same(c, "p", "r") & ~self._same(c, "p", "l") & ~self._same(c, "l", "r")

    def _has(self, tag: str) -> Column:
        return F.col(tag).isNotNull()

    def row_actions(self) -> DataFrame:
        """(key, action): what remote did to the parent, ``!->`` where local disagrees."""
        shown = [c for c in self.remote.columns if c in self.parent.columns and c not in self.options.ignore_columns]
        new = [c for c in self.remote.columns if c not in self.parent.columns]
        in_local = [c for c in shown if c in self.local.columns]
        conflict = reduce(lambda x, y: x | y, [self._conflict(c) for c in in_local], F.lit(False))
        update = reduce(lambda x, y: x | y, [self._remote_changed(c) for c in shown], F.lit(False))
        gained = reduce(
            lambda x, y: x | y, [F.coalesce(F.col("r")[c].cast("string") != "", F.lit(False)) for c in new], F.lit(False)
        )
        p, loc, r = self._has("p"), self._has("l"), self._has("r")
        action = (
            F.when(~p & ~loc & r, INSERT)
            .when(p & loc & ~r, DELETE)
            .when(r & (p | loc) & conflict, CONFLICT)  # without a parent: both inserted the key, with other values
            .when(p & r & update, UPDATE)
            .when(r & gained, GAIN)
            .otherwise(SAME)
        )
        return self.rows.select(*self.key_values(), action.alias("action"))

    def merged(self, conflict_style: str = "local") -> DataFrame:
        """The merge of local and remote.

        A cell changed on one side only takes that change. Inserts of both sides stay, deletes of
        either side go, and so do columns. A conflicting cell keeps the local value, or, with
        ``conflict_style='text'``, shows parent, local and remote in one text.

        Rows with a repeated or blank key can't be told apart by it. They are merged as a multiset, by the number of
        copies of each full row: a number changed on one side only is taken, and so is one changed alike on both.
        Where both changed it differently the local number stays; :meth:`copy_conflicts` lists such rows.
        """
        if conflict_style not in ("local", "text"):
            raise ValueError(f"unknown conflict style {conflict_style!r}")
        p, loc, r = self._has("p"), self._has("l"), self._has("r")
        kept = self.rows.filter(~F.col("loose") & ((loc & r) | (~p & (loc | r))))
        merged = kept.select([self._merged_cell(c, conflict_style).alias(c) for c in self.merged_columns()])
        return merged.unionByName(self._merged_loose(merged.schema))

    def _loose_copies(self, schema: T.StructType) -> DataFrame:
        """Full rows with a repeated or blank key, and how many copies each table has; hot rows are counted map-side."""
        names = self.merged_columns()
        cells = []
        for c in names:
            have = [F.col(tag)[c] for tag, t in (("l", self.local), ("r", self.remote), ("p", self.parent)) if c in t.columns]
            cells.append(F.coalesce(*have).cast(schema[c].dataType).alias(c))
        counts = [F.count_if(f"__{tag}").alias(f"__{tag}") for tag in "plr"]
        loose = self.rows.filter("loose").select(*cells, *[self._has(tag).alias(f"__{tag}") for tag in "plr"])
        return loose.groupBy(*[F.col(f"`{c}`") for c in names]).agg(*counts)

    def _merged_loose(self, schema: T.StructType) -> DataFrame:
        # a side that kept the parent's number leaves the decision to the other one
        copies = self._loose_copies(schema).withColumn("__n", F.expr("CASE WHEN __l = __p THEN __r ELSE __l END"))
        names = [F.col(f"`{c}`") for c in self.merged_columns()]
        return expand_ranges(copies.filter("__n > 0").drop("__p", "__l", "__r"), "__n", "__i").select(*names)

    def copy_conflicts(self) -> DataFrame:
        """Full rows with a repeated or blank key whose number of copies both sides changed, to different numbers."""
        types = T.StructType([next(t.schema[c] for t in (self.local, self.remote, self.parent) if c in t.columns) for c in self.merged_columns()])
        numbers = {"__p": "parent_copies", "__l": "local_copies", "__r": "remote_copies"}
        return self._loose_copies(types).filter("__l != __p AND __r != __p AND __l != __r").withColumnsRenamed(numbers)

    def merged_columns(self) -> list[str]:
        """Local order; columns dropped on either side go, columns added by remote come last."""
        in_parent = set(self.parent.columns)
        out = [c for c in self.local.columns if c not in in_parent or c in self.remote.columns]
        return out + [c for c in self.remote.columns if c not in in_parent and c not in out]

    def _merged_cell(self, c: str, conflict_style: str) -> Column:
        loc, r = self._has("l"), self._has("r")
        as_text = conflict_style == "text" and c not in self.keys

        def show(x: Column) -> Column:
            return x.cast("string") if as_text else x

        if c not in self.local.columns:
            return show(F.col("r")[c])
        if c not in self.remote.columns:
            return show(F.col("l")[c])
        if c not in self.parent.columns:
            return show(F.coalesce(F.col("l")[c], F.col("r")[c]))
        pv, lv, rv = self._cell(c)
        both = loc & r
        conflict = show(lv)
        if as_text:
            opening, middle, between = CONFLICT_TEXT
            parts = [F.coalesce(v.cast("string"), F.lit("")) for v in (pv, lv, rv)]
            conflict = F.concat(F.lit(opening), parts[0], F.lit(middle), parts[1], F.lit(between), parts[2])
        return (
            F.when(both & self._conflict(c), conflict)
            .when(both & self._remote_changed(c) & self._same(c, "p", "l"), show(rv))
            .when(loc, show(lv))
            .otherwise(show(rv))
        )

    def conflicts(self) -> DataFrame:
        """(key, column, parent, local, remote) of every conflicting cell of rows local and remote both have.

        A key inserted on both sides with different values counts as a conflict with an empty parent.
        """
        entries = [
            F.when(
                self._conflict(c),
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col("p")[c].cast("string").alias("parent_value"),
                    F.col("l")[c].cast("string").alias("local_value"),
                    F.col("r")[c].cast("string").alias("remote_value"),
                ),
            )
            for c in self._shared()
            if c not in self.keys
        ]
        both = self.rows.filter(self._has("l") & self._has("r"))
        return both.select(*self.key_values(), F.inline(F.array_compact(F.array(*entries))))


def three_way(parent: DataFrame, local: DataFrame, remote: DataFrame, keys: Sequence[str],
              options: CompareOptions = EXACT) -> ThreeWay:
    rows = align_three(parent, local, remote, keys, options)
    return ThreeWay(rows, parent, local, remote, tuple(keys), options)

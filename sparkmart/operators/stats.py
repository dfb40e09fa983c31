"""Column statistics that stay distributed: moments, exact median, mode, rates, key quality."""

from __future__ import annotations

import struct
from fractions import Fraction
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.text import key_part
from sparkmart.operators.position import with_position
from sparkmart.runtime import materialize

# values that are sorted in one task; a larger column is narrowed down around its middle first
MEDIAN_LIMIT = 100_000
# rank error of the quantile sketch is 1 / accuracy, far below the margin on either side of the middle
_SKETCH_ACCURACY, _SKETCH_MARGIN = 2000, 0.005
_SKEW_ZERO = 1e-12


def sample_skewness(column: str | Column) -> Column:
    """Adjusted skewness: 0 for constant input, NULL below three values."""
    column = F.col(column) if isinstance(column, str) else column
    n = F.count(column)
    adjusted = F.skewness(column) * F.sqrt(n * (n - 1.0)) / F.nullif(n - 2.0, F.lit(0.0))
    constant = F.min(column) == F.max(column)
    return F.when(n >= 3, F.when(constant, 0.0).otherwise(adjusted))


def is_skewed(value: float | None) -> bool:
    return value is None or abs(value) > _SKEW_ZERO


@dataclass
class _Bracket:
    """Values of a column between ``lo`` and ``hi`` (None: open), among them its middle."""

    size: int
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    inside: int = 0
    median: float | int | Decimal | None = None

    @property
    def ranks(self) -> tuple[int, int]:
        return (self.size - 1) // 2, self.size // 2

    def holds(self, column: Column) -> Column:
        test = column.isNotNull()
        if self.lo is not None:
            test = test & (column >= self.lo)
        if self.hi is not None:
            test = test & (column <= self.hi)
        return test


def exact_medians(df: DataFrame, columns: Sequence[str], limit: int = MEDIAN_LIMIT,
                  sizes: dict[str, int] | None = None) -> dict[str, float | int | Decimal | None]:
    """Interpolated median of each column, all columns in the same passes; exact for whole numbers and decimals.

    Columns with at most ``limit`` values are sorted at once. For the others a quantile sketch gives
    two values close to the middle on either side, a second pass counts exactly how many values lie
    below and between them, and this repeats until few are left between.
    """
    if not columns:
        return {}
    names = list(columns)
    typed = {c: known_value(df.schema[c]) for c in names}
    values = {c: typed[c].cast("double") for c in names}  # brackets are of doubles, which keep the order
    if sizes is None:
        row = df.agg(*[F.count(values[c]).alias(f"c{i}") for i, c in enumerate(names)]).first()
        sizes = {c: row[f"c{i}"] for i, c in enumerate(names)}
    brackets = {c: _Bracket(sizes[c], inside=sizes[c]) for c in names if sizes[c] > 0}
    wide = [c for c, b in brackets.items() if b.inside > limit]
    while wide:
        _narrow(df, {c: brackets[c] for c in wide}, values, typed)
        wide = [c for c in wide if brackets[c].median is None and brackets[c].inside > limit]
    rest = [c for c, b in brackets.items() if b.median is None]
    if rest:
        sorted_values = [F.sort_array(F.collect_list(F.when(brackets[c].holds(values[c]), typed[c]))) for c in rest]
        picked = [
            F.transform(F.array(*[F.lit(r - brackets[c].below) for r in brackets[c].ranks]), _element_of(v))
            for c, v in zip(rest, sorted_values)
        ]
        row = df.agg(*[p.alias(f"m{i}") for i, p in enumerate(picked)]).first()
        for i, c in enumerate(rest):
            brackets[c].median = _middle(*row[f"m{i}"])
    return {c: brackets[c].median if c in brackets else None for c in names}


def _middle(a, b):
    """The mean of two middle values, exact for whole numbers and decimals."""
    if a == b:
        return a
    if isinstance(a, int):
        return (a + b) // 2 if (a + b) % 2 == 0 else Decimal(a + b) / 2
    return (a + b) / 2 if isinstance(a, Decimal) else a / 2 + b / 2


def _element_of(array: Column):
    return lambda index: F.element_at(array, (index + 1).cast("int"))


def _narrow(df: DataFrame, brackets: dict[str, _Bracket], values: dict[str, Column], typed: dict[str, Column]) -> None:
    """One sketch pass and one counting pass over all still wide columns."""
    names = list(brackets)
    sketches = []
    for i, c in enumerate(names):
        b = brackets[c]
        shares = [(r - b.below + 0.5) / b.inside for r in b.ranks]
        around = [max(0.0, min(shares) - _SKETCH_MARGIN), min(1.0, max(shares) + _SKETCH_MARGIN)]
        inside = F.when(b.holds(values[c]), values[c])
        sketches.append(F.percentile_approx(inside, around, _SKETCH_ACCURACY).alias(f"s{i}"))
    edges = df.agg(*sketches).first()
    counts = []
    for i, c in enumerate(names):
        lo, hi = edges[f"s{i}"]
        counts += [F.count_if(values[c] < lo).alias(f"b{i}"), F.count_if(values[c].between(lo, hi)).alias(f"n{i}")]
    counted = df.agg(*counts).first()
    for i, c in enumerate(names):
        b, (lo, hi) = brackets[c], edges[f"s{i}"]
        below, inside = counted[f"b{i}"], counted[f"n{i}"]
        found = below <= b.ranks[0] and b.ranks[1] < below + inside
        if found and inside < b.inside and lo < hi:
            b.lo, b.hi, b.below, b.inside = lo, hi, below, inside
        else:  # the sketch cannot cut further: a few values hold almost all rows
            column = df.select(typed[c].alias("v")).filter("v IS NOT NULL")
            low, high = column.agg(F.min("v"), F.max("v")).first()
            b.median = _middle(*[_bisect(column, rank, low, high) for rank in b.ranks])


def _bisect(values: DataFrame, rank: int, lo, hi):
    """Smallest value with more than ``rank`` values at or below it, by halving the interval of possible values.

    Doubles are halved by their bits in order, so that at most 64 passes are needed, infinities included.
    """
    while lo < hi:
        mid = _between(lo, hi)
        bound = F.lit(mid).cast(values.schema["v"].dataType)
        row = values.agg(
            F.count_if(F.col("v") <= bound).alias("n"),
            F.max(F.when(F.col("v") <= bound, F.col("v"))).alias("at"),
            F.min(F.when(F.col("v") > bound, F.col("v"))).alias("next"),
        ).first()
        if row["n"] > rank:
            hi = row["at"]
        else:
            lo = row["next"]
    return lo


def _between(lo, hi):
    """A value half-way between two, at least the first and less than the second."""
    if isinstance(lo, int):
        return (lo + hi) // 2
    if isinstance(lo, Decimal):
        scale = max(-lo.as_tuple().exponent, -hi.as_tuple().exponent)
        with localcontext(prec=60):
            return Decimal((int(lo.scaleb(scale)) + int(hi.scaleb(scale))) // 2).scaleb(-scale)

    def place(x: float) -> int:
        bits = struct.unpack("<q", struct.pack("<d", x + 0.0))[0]
        return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)

    at = (place(lo) + place(hi)) // 2
    bits = at if at >= 0 else -at | -0x8000000000000000
    return struct.unpack("<d", struct.pack("<q", bits))[0]


def known_value(field: T.StructField) -> Column:
    """A column whose NaN are nulls."""
    column = F.col(f"`{field.name}`")
    return F.when(~F.isnan(column), column) if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else column


def quantiles_by(df: DataFrame, by: Sequence[str], value: str, shares: dict[str, float], block: int = 100_000) -> DataFrame:
    """Exact discrete quantiles per group: the smallest value that at least ``share`` of the group's values don't exceed.

    Values are counted first. The counts are summed up in (group, value) order block by block of positions, with the sums
    of the blocks before added from one row per block, so a group of any size is no single task.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__c"))
    placed = with_position(counted, [*by, value], "__at").withColumn("__block", F.floor(F.col("__at") / block))
    inside = Window.partitionBy(*by, "__block").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*by, "__block").agg(F.sum("__c").alias("__s"))
    sums = sums.withColumns({"__before": F.coalesce(F.sum("__s").over(earlier), F.lit(0)), "__n": F.sum("__s").over(Window.partitionBy(*by))})
    run = placed.withColumn("__run", F.sum("__c").over(inside))
    joined = run.join(sums, [run[c].eqNullSafe(sums[c]) for c in [*by, "__block"]])
    upto = F.col("__run") + F.col("__before")

    def rank(share: float) -> Column:
        """ceil(share * n) in whole numbers; the share is the decimal it is written as."""
        up, down = Fraction(str(share)).as_integer_ratio()
        return F.expr(f"(__n div {down}) * {up} + ((__n % {down}) * {up} + {down - 1}) div {down}")

    picked = [F.min(F.when(upto >= rank(share), F.col(value))).alias(name) for name, share in shares.items()]
    return joined.groupBy(*[run[c] for c in by]).agg(*picked)


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column, the smallest one on ties: numbers as numbers, other values as texts.

    Values are counted by (column, value) with partial sums, so neither a frequent value nor many
    distinct ones end up in one task. Columns of one type share a pass.
    """
    by_type: dict[str, dict[str, Column]] = {}
    for c in columns:
        field = df.schema[c]
        number = isinstance(field.dataType, T.NumericType)
        value = known_value(field) if number else F.col(f"`{c}`").cast("string")
        by_type.setdefault(field.dataType.simpleString() if number else "string", {})[c] = value
    found: dict[str, object] = {}
    for kind, values in by_type.items():
        found.update(_top_texts(df, values) if kind == "string" else _top_values(df, values))
    return {c: found.get(c) for c in columns}


def _top_texts(df: DataFrame, values: dict[str, Column]) -> dict[str, object]:
    """column -> most frequent text. Texts are counted by hash; only those whose hash is as frequent as any are compared.

    A column without repeated texts needs just its smallest one.
    """
    names = list(values)
    marks = [F.when(values[c].isNotNull(), F.xxhash64(values[c])) for c in names]
    hashed = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("c"), m.alias("h")) for i, m in enumerate(marks)])))
    counted = materialize(hashed.filter("h IS NOT NULL").groupBy("c", "h").agg(F.count(F.lit(1)).alias("n")), "text-counts")
    best = {r["c"]: r["n"] for r in counted.groupBy("c").agg(F.max("n").alias("n")).collect()}  # one row per column
    found: dict[str, object] = {}
    if single := [i for i, n in best.items() if n == 1]:
        row = df.agg(*[F.min(values[names[i]]).alias(f"m{i}") for i in single]).first()
        found.update({names[i]: row[f"m{i}"] for i in single})
    if many := {i: n for i, n in best.items() if n > 1}:
        top = reduce(lambda x, y: x | y, [(F.col("c") == i) & (F.col("n") == n) for i, n in many.items()])
        wanted = materialize(counted.filter(top).select("c", "h"), "text-candidates")
        cells = [F.struct(F.lit(i).alias("c"), marks[i].alias("h"), values[names[i]].alias("v")) for i in many]
        rows = df.select(F.inline(F.array(*cells))).join(wanted, ["c", "h"], "left_semi")
        found.update({names[c]: v for c, v in _most_frequent(rows)})
    return found


def _top_values(df: DataFrame, values: dict[str, Column]) -> dict[str, object]:
    """column -> most frequent value; at most one row per column reaches the driver."""
    names = list(values)
    cells = F.array(*[F.struct(F.lit(i).alias("c"), values[c].alias("v")) for i, c in enumerate(names)])
    return {names[c]: v for c, v in _most_frequent(df.select(F.inline(cells)).filter("v IS NOT NULL"))}


def _most_frequent(cells: DataFrame) -> list[tuple[int, object]]:
    """(c, v) with the most frequent, then smallest value of each column c."""
    counted = cells.groupBy("c", "v").count()
    top = counted.groupBy("c").agg(F.min(F.struct(-F.col("count"), F.col("v").alias("v")))["v"].alias("v"))
    return [(row["c"], row["v"]) for row in top.collect()]


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: count, mean, median, skewness and mode."""
    row = df.agg(
        *[F.count(known_value(df.schema[c])).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.avg(known_value(df.schema[c])).alias(f"m{i}") for i, c in enumerate(columns)],
        *[sample_skewness(known_value(df.schema[c])).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    medians = exact_medians(df, columns, sizes={c: row[f"n{i}"] for i, c in enumerate(columns)})
    top = modes(df, columns)
    as_double = lambda x: None if x is None else float(x)
    lines = [
        (c, row[f"n{i}"], as_double(row[f"m{i}"]), as_double(medians[c]), row[f"s{i}"], as_double(top[c])) for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        lines, "column_name string, n long, mean double, median double, skewness double, mode double"
    )


def pass_rate(df: DataFrame, passed: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows that passed, in percent with one decimal."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(passed).alias("passed"),
        F.round(100.0 * F.count_if(passed) / F.count(F.lit(1)), 1).alias("pass_rate"),
    )


def distinct_counts(a: DataFrame, b: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column in both tables, their sum, and the column's rank by it.

    Nulls count as one value. The cells of all columns are counted in one grouping by
    (side, column, value), which is spread by value.
    """

    def cells(df: DataFrame, side: str) -> DataFrame:
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("place"), F.col(f"`{c}`").cast("string").alias("v"))
            for i, c in enumerate(columns)
        ]
        return df.select(F.lit(side).alias("side"), F.inline(F.array(*entries)))

    both = cells(a, "a").unionByName(cells(b, "b"))
    if approximate:
        per = both.groupBy("column_name", "place", "side").agg(
            (F.approx_count_distinct("v") + F.max(F.col("v").isNull().cast("long"))).alias("n")
        )
    else:
        per = both.distinct().groupBy("column_name", "place", "side").agg(F.count(F.lit(1)).alias("n"))
    wide = per.groupBy("column_name", "place").agg(
        F.coalesce(F.sum(F.when(F.col("side") == "a", F.col("n"))), F.lit(0)).alias("distinct_a"),
        F.coalesce(F.sum(F.when(F.col("side") == "b", F.col("n"))), F.lit(0)).alias("distinct_b"),
    )
    total = wide.withColumn("distinct_total", F.col("distinct_a") + F.col("distinct_b"))
    ranked = F.sort_array(F.collect_list(F.struct(-F.col("distinct_total"), "place", "column_name", "distinct_a", "distinct_b", "distinct_total")))
    # one entry per column of the table
    return total.agg(ranked.alias("r")).select(F.posexplode("r").alias("p", "e")).select(
        F.col("e.column_name").alias("column_name"),
        "e.distinct_a",
        "e.distinct_b",
        "e.distinct_total",
        (F.col("p") + 1).alias("rank"),
    )


def key_quality(a: DataFrame, b: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """How well each candidate key identifies rows: highest frequency and keys unique in both tables."""

    def keys(df: DataFrame, side: str) -> DataFrame:
        entries = [
            F.struct(
                F.lit(" // ".join(cols)).alias("key_columns"),
                F.to_json(F.array(*[key_part(F.col(f"`{c}`")) for c in cols])).alias("k"),
            )
            for cols in candidates
        ]
        return df.select(F.lit(side).alias("side"), F.inline(F.array(*entries)))

    counted = keys(a, "a").unionByName(keys(b, "b")).groupBy("key_columns", "k").agg(
        F.count_if(F.col("side") == "a").alias("in_a"), F.count_if(F.col("side") == "b").alias("in_b")
    )
    return counted.groupBy("key_columns").agg(
        F.count_if(F.col("in_a") > 0).alias("keys_a"),
        F.count_if(F.col("in_b") > 0).alias("keys_b"),
        F.greatest(F.max("in_a"), F.max("in_b")).alias("max_frequency"),
        F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1)).alias("unique_in_both"),
        (F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1)) / F.greatest(F.sum("in_a"), F.lit(1))).alias("quality"),
    )


def column_subsets(columns: Sequence[str]) -> list[list[str]]:
    """All non-empty subsets, in the order of the bit patterns over ``columns``."""
    return [[c for i, c in enumerate(columns) if k >> i & 1] for k in range(1, 1 << len(columns))]

"""Fill missing values: mean, median, mode, interpolation, and the automatic choice between them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.temporal import coerce_dates, epoch_micros
from sparkmart.operators.position import PART, range_layout
from sparkmart.operators.stats import exact_medians, is_skewed, known_value, modes, sample_skewness

METHODS = ("mean", "median", "mode", "interpolate")
_TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def impute(df: DataFrame, column: str, method: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Fill the nulls of one column; ``interpolate`` needs the row order."""
    if method not in METHODS:
        raise ValueError(f"unknown imputation method {method!r}")
    return impute_columns(df, {column: method}, order_by)


def impute_columns(df: DataFrame, methods: dict[str, str], order_by: Sequence[str] | None = None,
                   known: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """Fill several columns; all means, all medians and all modes take one pass each.

    A profile of the table saves the pass for the means and the counting for the medians.
    """
    by_method: dict[str, list[str]] = {m: [c for c, chosen in methods.items() if chosen == m] for m in METHODS}
    values: dict[str, object] = {}
    if known is not None:
        values.update({c: known[c].mean for c in by_method["mean"]})
    elif by_method["mean"]:
        values.update(df.agg(*[F.avg(known_value(df.schema[c])).alias(c) for c in by_method["mean"]]).first().asDict())
    sizes = {c: p.values for c, p in known.items()} if known is not None else None
    values.update(exact_medians(df, by_method["median"], sizes=sizes))
    values.update(modes(df, by_method["mode"]))
    # an infinite mean or median is a fill like others; one that is no number (opposite infinities) leaves the nulls
    values = {c: None if isinstance(v, float) and math.isnan(v) else v for c, v in values.items()}
    large = _beyond_double(df, [c for c, v in values.items() if v is not None and methods[c] != "mode" and math.isfinite(v) and v != int(v)])
    filled = df.withColumns({c: _fill(df.schema[c], v, methods[c], c in large) for c, v in values.items() if v is not None})
    if by_method["interpolate"]:
        if not order_by:
            raise ValueError("interpolation needs order_by: a table has no row order of its own")
        filled = interpolate_time(filled, by_method["interpolate"], order_by)
    return filled


def _beyond_double(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """Those of the long columns that hold whole numbers a double can't tell apart."""
    longs = [c for c in columns if isinstance(df.schema[c].dataType, T.LongType)]
    if not longs:
        return set()
    exact = 1 << 53
    row = df.agg(*[F.max(~F.col(f"`{c}`").between(-exact, exact)).alias(f"x{i}") for i, c in enumerate(longs)]).first()
    return {c for i, c in enumerate(longs) if row[f"x{i}"]}


def _fill(field: T.StructField, value: object, method: str, large: bool) -> Column:
    """The column with its nulls filled; the values it has stay exactly as they are.

    The type stays where the fill fits it. Otherwise whole numbers become doubles, or decimals if a double can't hold
    them, and decimals get the digits that the fill needs.
    """
    column, kind = known_value(field), field.dataType
    if method == "mode":
        return F.coalesce(column, F.lit(value).cast(kind))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(column.cast("double"), F.lit(float(value)))
    if isinstance(kind, T.DecimalType):
        digits = max(kind.scale, -Decimal(value).normalize().as_tuple().exponent)
        kind = T.DecimalType(min(38, kind.precision + digits - kind.scale), digits)
    elif value != int(value):
        kind = T.DecimalType(38, 10) if large else T.DoubleType()
    return F.coalesce(column.cast(kind), F.lit(str(value)).cast("decimal(38,10)" if isinstance(kind, T.IntegralType) else kind).cast(kind))


def interpolate_time(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Linear interpolation of timestamps over the row position, floored to the second.

    Leading nulls stay, trailing nulls take the last value, and the whole column is floored.
    The rows are range partitioned by ``order_by``; each partition fills its own gaps, and the values
    next to its borders come from a summary with one row per partition.
    """
    spark = df.sparkSession
    micros = [epoch_micros(c).alias(f"__v{i}") for i, c in enumerate(columns)]
    layout = range_layout(df.select("*", *micros), order_by)
    ids = range(len(columns))

    def edge(i: int, agg) -> Column:
        point = F.struct(F.col("__local").alias("at"), F.col(f"__v{i}").alias("v"))
        return agg(F.when(F.col(f"__v{i}").isNotNull(), point))

    summary = (
        layout.groupBy(PART)
        .agg(
            (F.max("__local") + 1).alias("n"),
            *[edge(i, F.min).alias(f"first{i}") for i in ids],
            *[edge(i, F.max).alias(f"last{i}") for i in ids],
        )
        .orderBy(PART)
        .collect()
    )
    carried = _carry(summary, ids)
    points = ", ".join(f"pp{i} long, pv{i} long, np{i} long, nv{i} long" for i in ids)
    borders = spark.createDataFrame(carried, f"{PART} int, __first long, {points}")
    rows = layout.join(F.broadcast(borders), PART).withColumn("__p", F.col("__first") + F.col("__local"))

    upto = Window.partitionBy(PART).orderBy("__local").rowsBetween(Window.unboundedPreceding, 0)
    # read backwards: a growing frame is linear, a frame shrinking towards the end is not
    backwards = Window.partitionBy(PART).orderBy(F.desc("__local")).rowsBetween(Window.unboundedPreceding, 0)
    known = {}
    for i in ids:
        point = F.when(F.col(f"__v{i}").isNotNull(), F.struct(F.col("__p").alias("at"), F.col(f"__v{i}").alias("v")))
        before = F.when(F.col(f"pp{i}").isNotNull(), F.struct(F.col(f"pp{i}").alias("at"), F.col(f"pv{i}").alias("v")))
        after = F.when(F.col(f"np{i}").isNotNull(), F.struct(F.col(f"np{i}").alias("at"), F.col(f"nv{i}").alias("v")))
        known[f"__l{i}"] = F.coalesce(F.last(point, ignorenulls=True).over(upto), before)
        known[f"__r{i}"] = F.coalesce(F.last(point, ignorenulls=True).over(backwards), after)
    bounded = rows.withColumns(known)
    out = {c: _interpolated(i, df.schema[c].dataType) for i, c in enumerate(columns)}
    return bounded.withColumns(out).select(*df.columns)


def _carry(summary, ids) -> list[tuple]:
    """Per partition: its first position and, per column, the nearest known point before and after it."""
    firsts, running = [], 0
    for row in summary:
        firsts.append(running)
        running += row["n"]
    before: list[dict[int, tuple]] = []
    seen: dict[int, tuple] = {}
    for row, first in zip(summary, firsts):
        before.append(dict(seen))
        for i in ids:
            if row[f"last{i}"] is not None:
                seen[i] = (first + row[f"last{i}"]["at"], row[f"last{i}"]["v"])
    after: list[dict[int, tuple]] = []
    seen = {}
    for row, first in zip(reversed(summary), reversed(firsts)):
        after.append(dict(seen))
        for i in ids:
            if row[f"first{i}"] is not None:
                seen[i] = (first + row[f"first{i}"]["at"], row[f"first{i}"]["v"])
    after.reverse()
    none = (None, None)
    return [
        (row[PART], first, *[x for i in ids for x in (*prev.get(i, none), *nxt.get(i, none))])
        for row, first, prev, nxt in zip(summary, firsts, before, after)
    ]


def _interpolated(i: int, dtype: T.DataType) -> Column:
    """Seconds of the line between two known points, in exact integer arithmetic."""
    known = _floor_div(f"__l{i}.v", "1000000L")
    seconds = F.expr(
        f"CASE WHEN __l{i} IS NULL THEN NULL WHEN __r{i} IS NULL OR __r{i}.at = __l{i}.at THEN {known} ELSE {_line(i)} END"
    )
    stamp = F.timestamp_seconds(seconds)
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return stamp.cast(dtype)


def _floor_div(x: str, d: str) -> str:
    return f"((({x}) - pmod({x}, {d})) div ({d}))"


def _line(i: int) -> str:
    """Whole seconds at the current position; in long arithmetic where it cannot overflow, else in decimals.

    With the known second ``s`` and the rest ``u`` of the left point this is
    ``s + floor((u * steps + rise * done) / (steps * 1000000))``.
    """
    steps, done = f"(__r{i}.at - __l{i}.at)", f"(__p - __l{i}.at)"
    rise, rest = f"(__r{i}.v - __l{i}.v)", f"pmod(__l{i}.v, 1000000L)"

    def beyond(cast: str) -> str:
        n, d, r, u = (f"CAST({x} AS {cast})" for x in (steps, done, rise, rest))
        return _floor_div(f"{u} * {n} + {r} * {d}", f"{n} * CAST(1000000 AS {cast})")

    fits = f"(abs{rise} + 1000000L) < (9000000000000000000L div {steps})"
    second = _floor_div(f"__l{i}.v", "1000000L")
    return f"({second} + CASE WHEN {fits} THEN {beyond('BIGINT')} ELSE {beyond('DECIMAL(19,0)')} END)"


@dataclass(frozen=True)
class ColumnProfile:
    """What the automatic choice needs to know about a column."""

    dtype: T.DataType
    values: int
    nulls: int
    mean: float | None = None
    skewness: float | None = None

    @property
    def null_percent(self) -> float:
        return 100.0 * self.nulls / max(1, self.values + self.nulls)

    @property
    def method(self) -> str:
        """Median for skewed numbers, mean for symmetric ones, interpolation for times, mode for the rest."""
        if isinstance(self.dtype, T.NumericType):
            return "median" if is_skewed(self.skewness) else "mean"
        return "interpolate" if isinstance(self.dtype, _TIME_TYPES) else "mode"


def profile(df: DataFrame) -> dict[str, ColumnProfile]:
    """Null counts of all columns, mean and skewness of the numeric ones, in a single pass."""
    fields = list(enumerate(df.schema.fields))
    numeric = [(i, f.name) for i, f in fields if isinstance(f.dataType, T.NumericType)]
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(known_value(f)).alias(f"n{i}") for i, f in fields],
        *[F.avg(known_value(df.schema[c])).alias(f"m{i}") for i, c in numeric],
        *[sample_skewness(known_value(df.schema[c])).alias(f"s{i}") for i, c in numeric],
    ).first().asDict()
    return {
        f.name: ColumnProfile(f.dataType, row[f"n{i}"], row["total"] - row[f"n{i}"], row.get(f"m{i}"), row.get(f"s{i}"))
        for i, f in fields
    }


def handle_nulls(df: DataFrame, threshold: float = 20.0, order_by: Sequence[str] | None = None) -> DataFrame:
    """Drop the columns with more than ``threshold`` percent nulls and fill the others automatically."""
    df = coerce_dates(df)
    known = profile(df)
    with_nulls = {c: p for c, p in known.items() if p.nulls > 0}
    dropped = [c for c, p in with_nulls.items() if p.null_percent > threshold]
    if order_by and set(dropped) & set(order_by):
        raise ValueError(f"the order columns {order_by} are too sparse to keep")
    methods = {c: p.method for c, p in with_nulls.items() if c not in dropped}
    return impute_columns(df.drop(*dropped), methods, order_by, known)

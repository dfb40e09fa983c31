"""Global row positions and order-dependent helpers that never use a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.runtime import materialize

PART = "__part"
POS = "__pos"
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in the low 33 bits


def _columns(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def range_layout(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``df`` sorted across range partitions and written once, with ``__part`` and ``__local``.

    ``order_by`` must be a total order, so a re-run of a lost task yields the same row numbers.
    """
    order = _columns(order_by)
    row_id = F.monotonically_increasing_id()
    laid_out = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__row_id", row_id)
        .withColumn(PART, F.shiftright("__row_id", _LOCAL_BITS).cast("int"))
        .withColumn("__local", F.col("__row_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop("__row_id")
    )
    return materialize(laid_out, "layout")


def partition_starts(layout: DataFrame, start: int = 0) -> list[int]:
    """First position of each partition; the driver holds one number per range partition."""
    sizes = {r[PART]: r["n"] for r in layout.groupBy(PART).agg((F.max("__local") + 1).alias("n")).collect()}
    starts, running = [], start
    for part in range(max(sizes, default=-1) + 1):
        starts.append(running)
        running += sizes.get(part, 0)
    return starts


def with_position(df: DataFrame, order_by: Sequence[str | Column], name: str = POS, start: int = 0) -> DataFrame:
    """Add the dense global position of each row in ``order_by`` order, beginning at ``start``."""
    layout = range_layout(df, order_by)
    starts = partition_starts(layout, start)
    # a constant array looked up by partition, not a join: Spark then still knows the size of the result
    # from its files and can choose how to join it further
    constant = F.split(F.lit(",".join(map(str, starts or [start]))), ",").cast("array<bigint>")
    return layout.withColumn(name, F.get(constant, F.col(PART)) + F.col("__local")).drop(PART, "__local")


def with_neighbourhood(df: DataFrame, pos: str, reach: int, block: int = 100_000) -> DataFrame:
    """Copy each row into its position block and into a neighbour block closer than ``reach``.

    A window partitioned by ``__block`` and ordered by ``pos`` then sees everything within
    ``reach`` of each of the block's own rows (``__own``), while blocks stay bounded in size; a block
    has at least twice ``reach`` positions.
    """
    block = max(block, 2 * reach + 1)
    own = F.floor(F.col(pos) / block)
    spread = F.array_distinct(
        F.array(F.floor((F.col(pos) - reach) / block), own, F.floor((F.col(pos) + reach) / block))
    )
    return df.withColumn("__block", F.explode(spread)).withColumn("__own", F.col("__block") == own)


def occurrence_number(df: DataFrame, keys: Sequence[str], order: str, name: str, width: int = 1_000_000) -> DataFrame:
    """Number the rows of each key group 0, 1, ... by ``order`` (a dense position column).

    A group may hold most of the table, so it is cut into chunks of ``width`` positions: rows are
    numbered inside a (key, chunk) piece and the counts of the earlier pieces are added.
    """
    pieces = df.withColumn("__chunk", F.floor(F.col(order) / width))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(*keys, "__chunk")
        .count()
        .withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    inside = Window.partitionBy(*keys, "__chunk").orderBy(order)
    numbered = pieces.withColumn("__inside", F.row_number().over(inside) - 1)
    on = [numbered[k].eqNullSafe(starts[k]) for k in [*keys, "__chunk"]]
    joined = numbered.join(starts, on)
    kept = [numbered[c] for c in df.columns]
    return joined.select(*kept, (numbered["__inside"] + starts["__start"]).alias(name))


def running_max(df: DataFrame, group: str, order: str, value: Column, name: str, block: int = 100_000,
                backwards: bool = False) -> DataFrame:
    """Add the maximum of ``value`` over the rows before the current one (after it, if ``backwards``).

    A group may hold the whole table, so it is cut into blocks of the ``order`` position: the window runs
    inside a block, and the maximum of the blocks before it is added from one row per block.
    """
    pieces = df.withColumns({"__blk": F.floor(F.col(order) / block), "__val": value})
    sign = F.desc if backwards else F.asc
    so_far = Window.unboundedPreceding
    blocks = Window.partitionBy(group).orderBy(sign("__blk")).rowsBetween(so_far, -1)
    carried = (
        pieces.groupBy(group, "__blk")
        .agg(F.max("__val").alias("__top"))
        .select(group, "__blk", F.max("__top").over(blocks).alias("__carry"))
    )
    inside = Window.partitionBy(group, "__blk").orderBy(sign(order)).rowsBetween(so_far, -1)
    joined = pieces.withColumn("__inner", F.max("__val").over(inside)).join(carried, [group, "__blk"])
    return joined.withColumn(name, F.greatest("__inner", "__carry")).select(*df.columns, name)


def expand_ranges(df: DataFrame, length: str, name: str, batch: int = 10_000) -> DataFrame:
    """Repeat each row ``length`` times with ``name`` = 0, 1, ...; long repeats are spread over the cluster."""
    batches = df.withColumn("__batch", F.explode(F.expr(f"sequence(0L, (`{length}` - 1) div {batch})")))
    size = F.least(F.lit(batch), F.col(length) - F.col("__batch") * batch)
    inside = F.explode(F.sequence(F.lit(0), (size - 1).cast("int")))
    spread = batches.repartition(*[F.col(f"`{c}`") for c in batches.columns])
    return (
        spread.withColumn("__within", inside)
        .withColumn(name, F.col("__batch") * batch + F.col("__within"))
        .drop("__batch", "__within")
    )

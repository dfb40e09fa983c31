"""Which of the common rows or columns of two orders were moved.

The common items, read in target order, fall into runs that are consecutive in the source. The
longest run stays in place; runs that cross it were moved; then the longest of the remaining ones
stays, and so on (equal lengths: the earlier run in the target first).
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.operators.position import expand_ranges, running_max, with_neighbourhood, with_position
from sparkmart.runtime import materialize

NOBODY = np.iinfo(np.int64).max


def moved_items(source: Sequence[str], target: Sequence[str]) -> list[str]:
    """Moved items of two short lists with the same items (column names)."""
    at = {item: i for i, item in enumerate(source)}
    runs: list[tuple[int, int, int]] = []  # (length, source start, target start)
    for place, item in enumerate(target):
        if runs and at[item] == runs[-1][1] + runs[-1][0]:
            runs[-1] = (runs[-1][0] + 1, *runs[-1][1:])
        else:
            runs.append((1, at[item], place))
    fixed: list[tuple[int, int, int]] = []
    moved: list[str] = []
    for run in sorted(runs, key=lambda r: (-r[0], r[2])):
        if all((run[1] < f[1]) == (run[2] < f[2]) for f in fixed):
            fixed.append(run)
        else:
            moved.extend(source[run[1] : run[1] + run[0]])
    return moved


def moved_rows(pairs: DataFrame, source: str, target: str, block: int = 100_000) -> DataFrame:
    """The moved rows of a table of common rows, given the two row-number columns.

    ``block`` is the number of positions a window, and of runs a task, sees at a time.
    """
    ranked = with_position(with_position(pairs, [source], "__src"), [target], "__dst")
    blocks = with_neighbourhood(ranked, "__dst", 1, block)
    previous = F.lag("__src").over(Window.partitionBy("__block").orderBy("__dst"))
    starts = (
        blocks.withColumn("__prev", previous)
        .filter("__own AND (__prev IS NULL OR __src != __prev + 1)")
        .select("__src", "__dst")
    )
    numbered = with_position(starts, ["__dst"], "run")
    total = ranked.count()
    following = numbered.select((F.col("run") - 1).alias("run"), F.col("__dst").alias("__end"))
    runs = numbered.join(following, "run", "left").select(
        "run", "__src", "__dst", (F.coalesce("__end", F.lit(total)) - F.col("__dst")).alias("size")
    )
    moved = _moved_runs(runs, block)
    if moved is None:
        return ranked.limit(0).select(source, target)
    places = expand_ranges(moved, "size", "__i").select((F.col("__dst") + F.col("__i")).alias("__dst"))
    return ranked.join(places, "__dst", "left_semi").select(source, target)


def _moved_runs(runs: DataFrame, block: int) -> DataFrame | None:
    """The runs that cross a kept run; None if there are none.

    Runs are ranked once (``turn``: longest first, then by target). In a round every run that comes before
    all runs it crosses is kept, and the runs that cross a kept one are moved. A round decides all runs of the
    greatest length left: of these, one is kept if its source place is beyond those of all before it in the
    target, and any other crosses a kept one. So there are at most as many rounds as lengths, which is below
    the root of twice the rows; local maxima make it far fewer. When at most ``block`` runs are left, one task
    decides them. The driver sees only their number.
    """
    ranked = with_position(with_position(runs, ["__src"], "at"), [F.desc("size"), F.col("__dst")], "turn")
    pending = materialize(ranked.select("run", "at", "turn", "__dst", "size"), "runs")
    extent = left = pending.count()
    moved: list[DataFrame] = []
    while left > block:
        rivals = _first_crossing(pending, extent, block)
        every = rivals.withColumns({"__kept": F.col("turn") < F.col("rival"), "__all": F.lit(0)})
        # kept runs rise in source and target alike: the last one before is the highest, the next one after the lowest
        place = F.when(F.col("__kept"), F.col("at"))
        every = running_max(every, "__all", "run", place, "__before", block)
        every = running_max(every, "__all", "run", -place, "__after", block, backwards=True)
        crosses = F.coalesce(F.col("__before") > F.col("at"), F.lit(False)) | F.coalesce(-F.col("__after") < F.col("at"), F.lit(False))
        step = materialize(every.filter("NOT __kept").select(*pending.columns, crosses.alias("__moved")), "runs")
        moved.append(step.filter("__moved").select("__dst", "size"))
        pending = step.filter("NOT __moved").drop("__moved")
        left = pending.count()
    if left:
        last = pending.withColumn("__all", F.lit(0)).groupBy("__all")
        moved.append(last.applyInPandas(_decide, "__dst long, size long"))
    found = moved[0] if moved else None
    for more in moved[1:]:
        found = found.unionByName(more)
    if found is None:
        return None
    found = materialize(found, "moved-runs")
    return None if found.isEmpty() else found


def _first_crossing(runs: DataFrame, extent: int, block: int) -> DataFrame:
    """Add ``rival``: the least ``turn`` among the runs that each run crosses, or a number beyond all.

    Places ``run`` and ``at`` lie below ``extent``. They are cut into strips. A run crosses runs of its own target
    strip, of its own source strip, and of whole cells (pairs of strips) that lie before one and after the
    other of its strips. Strips are compared inside tasks; the cells, of which only the least turn matters, are a
    smaller problem of the same kind.
    """
    return _in_strips(runs, extent, max(2, block), block)


def _in_strips(points: DataFrame, extent: int, width: int, block: int) -> DataFrame:
    columns = points.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    cut = points.withColumns({"__x": F.expr(f"run div {width}"), "__y": F.expr(f"at div {width}"), "rival": F.lit(NOBODY)})
    kinds += ", __x bigint, __y bigint, rival bigint"
    for strip in ("__x", "__y"):
        cut = cut.groupBy(strip).applyInPandas(_cross_inside, kinds)
        if width >= extent:
            return cut.select(*columns, "rival")
    cut = materialize(cut, "strips")
    strips = -(-extent // width)
    cells = cut.groupBy(F.col("__x").alias("run"), F.col("__y").alias("at")).agg(F.min("turn").alias("turn"))
    # a strip of cells holds its width times the number of strips on the other side
    wide = strips if strips * strips <= block else max(2, min(block // strips, (strips + 1) // 2))
    outer = _in_strips(materialize(cells, "cells"), strips, wide, block).select(
        F.col("run").alias("__x"), F.col("at").alias("__y"), F.col("rival").alias("__outer")
    )
    best = F.least("rival", "__outer").alias("rival")
    return cut.join(outer, ["__x", "__y"]).select(*columns, best)


def _cross_inside(points: pd.DataFrame) -> pd.DataFrame:
    x, y, turn = (points[c].to_numpy(np.int64) for c in ("run", "at", "turn"))
    best = np.minimum(_least_before_above(x, y, turn), _least_before_above(-x, -y, turn))
    return points.assign(rival=np.minimum(points["rival"].to_numpy(np.int64), best))


def _least_before_above(x: np.ndarray, y: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """For each point the least turn among those with smaller x and greater y.

    Points are merged by x in halves of doubling size; at each size the points of a right half look at those
    of the left half beside it that are higher, by a running minimum from the highest point down.
    """
    order = np.lexsort((y, x))  # equal x: by rising y, so that none sees another
    height, value, best = y[order], turn[order], np.full(len(x), NOBODY)
    place, size = np.arange(len(x)), 1
    while size < len(x):
        pair, right = place // (2 * size), (place // size) % 2 == 1
        # downwards in each pair; at equal height the right half comes first and does not see the left one
        down = np.lexsort((~right, -height, pair))
        values, rank = np.unique(np.where(right[down], NOBODY, value[down]), return_inverse=True)
        # one running minimum serves all pairs, as the ranks of each pair lie below those of the pair before
        lower = pair[down] * (len(x) + 1)
        least = values[np.minimum.accumulate(rank - lower) + lower]
        best[down] = np.where(right[down], np.minimum(best[down], least), best[down])
        size *= 2
    out = np.empty(len(x), np.int64)
    out[order] = best
    return out


def _decide(runs: pd.DataFrame) -> pd.DataFrame:
    """The moved ones among a bounded number of runs."""
    sources: list[int] = []
    targets: list[int] = []
    moved = []
    for row in runs.sort_values("turn").itertuples():
        i = bisect_left(targets, row.run)
        if (i == 0 or sources[i - 1] < row.at) and (i == len(targets) or row.at < sources[i]):
            sources.insert(i, row.at)
            targets.insert(i, row.run)
        else:
            moved.append(row.Index)
    return runs.loc[moved, ["__dst", "size"]]

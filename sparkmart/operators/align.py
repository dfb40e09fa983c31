"""Pair the rows of two tables without a given key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.comparison import EXACT, CompareOptions
from sparkmart.functions.text import key_part
from sparkmart.operators.diff import TableDiff, classify
from sparkmart.operators.position import with_position
from sparkmart.operators.stats import column_subsets, distinct_counts
from sparkmart.runtime import materialize

# fixed value: number of columns whose subsets are tried unless the caller says otherwise
MAX_COLUMNS = 5
#: rows of each side that a task of a neighbour pass sees of one gap at a time
GAP_ROWS = 1_000_000


def key_candidates(a: DataFrame, b: DataFrame, ignore: Sequence[str] = (), limit: int = MAX_COLUMNS) -> list[str]:
    """The common columns; if there are more than ``limit``, those with the most distinct values."""
    common = [c for c in a.columns if c in b.columns and c not in ignore]
    if len(common) <= limit:
        return common
    top = distinct_counts(a, b, common).filter(F.col("rank") <= limit).orderBy("rank")
    return [row["column_name"] for row in top.select("column_name").collect()]  # at most ``limit`` rows


def _subset_key(subset: Sequence[str]) -> Column:
    """Key of a column subset as JSON text, which keeps part borders; NULL where a lone part is blank."""
    if len(subset) == 1:
        return F.nullif(F.col(f"__p_{subset[0]}"), F.lit(""))
    return F.to_json(F.array(*[F.col(f"__p_{c}") for c in subset]))


def _shuffled(rows: DataFrame) -> DataFrame:
    """Rows that a join must shuffle: Spark would judge them by their files, where repeated values and positions take
    next to nothing, and gather millions of them in the driver to broadcast them."""
    return rows.hint("merge")


def align_rows(
    a: DataFrame,
    b: DataFrame,
    position: str,
    columns: Sequence[str] | None = None,
    options: CompareOptions = EXACT,
    candidates: int = MAX_COLUMNS,
) -> DataFrame:
    """Pairs ``(l_pos, r_pos)`` of rows; ``position`` is a dense row-number column of both tables.

    The subsets of the candidate columns are tried in turn: two rows pair when their key is unique in
    both tables and neither has been paired by an earlier subset. The candidates are ``columns``, or the
    ``candidates`` common columns with the most distinct values; there are ``2 ** candidates - 1``
    subsets. If there are more common columns, rows that agree in all of them are paired before.
    Rows left over pair by neighbourhood, see :func:`neighbour_pairs`.
    """
    common = [c for c in a.columns if c in b.columns and c != position and c not in options.ignore_columns]
    columns = list(columns or key_candidates(a.drop(position), b.drop(position), options.ignore_columns, candidates))
    everything = list(dict.fromkeys([*columns, *common]))
    parts = [
        key_part(F.col(f"`{c}`"), options.ignore_whitespace, options.ignore_case).alias(f"__p_{c}") for c in everything
    ]
    left = a.select(F.col(position).alias("pos"), *parts)
    right = b.select(F.col(position).alias("pos"), *parts)
    subsets = column_subsets(columns)
    if len(everything) > len(columns):
        subsets.insert(0, everything)

    # most rows pair by the first subset, which is settled on the whole tables
    first = materialize(_unique_pairs(left, right, {0: subsets[0]}).select("l_pos", "r_pos"), "pairs")
    decided = [first]
    rest = range(1, len(subsets))
    pending_l = left.join(_shuffled(first.select(F.col("l_pos").alias("pos"))), "pos", "left_anti")
    pending_r = right.join(_shuffled(first.select(F.col("r_pos").alias("pos"))), "pos", "left_anti")
    if rest and not pending_l.isEmpty() and not pending_r.isEmpty():
        keys = {i: subsets[i] for i in rest}
        open_pairs = _open_pairs(left, right, pending_l, pending_r, keys)
        decided.extend(_by_priority(materialize(open_pairs, "candidates")))
    pairs = decided[0]
    for more in decided[1:]:
        pairs = pairs.unionByName(more)
    return neighbour_pairs(left, right, materialize(pairs, "pairs"), [f"__p_{c}" for c in everything])


def _keyed(side: DataFrame, keys: dict[int, Sequence[str]]) -> DataFrame:
    entries = [F.struct(F.lit(i).alias("i"), _subset_key(subset).alias("k")) for i, subset in keys.items()]
    return side.select("pos", F.inline(F.array(*entries))).filter("k IS NOT NULL")


def _count_pairs(tagged: DataFrame) -> DataFrame:
    """Pairs from rows (side, i, k, pos): keys that occur once on each side."""
    grouped = tagged.groupBy("i", "k").agg(
        F.count_if("left").alias("nl"),
        F.count_if(~F.col("left")).alias("nr"),
        F.max(F.when(F.col("left"), F.col("pos"))).alias("l_pos"),
        F.max(F.when(~F.col("left"), F.col("pos"))).alias("r_pos"),
    )
    return grouped.filter("nl = 1 AND nr = 1").select("i", "l_pos", "r_pos")


def _tag(df: DataFrame, is_left: bool) -> DataFrame:
    return df.withColumn("left", F.lit(is_left))


def _unique_pairs(left: DataFrame, right: DataFrame, keys: dict[int, Sequence[str]]) -> DataFrame:
    return _count_pairs(_tag(_keyed(left, keys), True).unionByName(_tag(_keyed(right, keys), False)))


def _open_pairs(left: DataFrame, right: DataFrame, pending_l: DataFrame, pending_r: DataFrame,
                keys: dict[int, Sequence[str]]) -> DataFrame:
    """Candidate pairs of pending rows. A key must be unique in the whole tables, but only keys that
    occur among the pending rows of both sides are counted there."""
    shared = (
        _keyed(pending_l, keys).select("i", "k").distinct()
        .join(_keyed(pending_r, keys).select("i", "k").distinct(), ["i", "k"], "left_semi")
    )
    wanted = materialize(shared, "pending-keys")
    both = _tag(_keyed(left, keys), True).unionByName(_tag(_keyed(right, keys), False))
    pairs = _count_pairs(both.join(wanted, ["i", "k"], "left_semi"))
    return pairs.join(_shuffled(pending_l.select(F.col("pos").alias("l_pos"))), "l_pos", "left_semi").join(
        _shuffled(pending_r.select(F.col("pos").alias("r_pos"))), "r_pos", "left_semi"
    )


def _by_priority(candidates: DataFrame) -> list[DataFrame]:
    """Accept candidate pairs in subset order.

    A pair whose subset comes first among all open candidates of both its rows is accepted; pairs that
    share a row with it are dropped. This repeats until no candidate is left and gives the same pairs
    as going through the subsets one by one.
    """
    accepted: list[DataFrame] = []
    while not candidates.isEmpty():
        best_l = candidates.groupBy("l_pos").agg(F.min("i").alias("min_l"))
        best_r = candidates.groupBy("r_pos").agg(F.min("i").alias("min_r"))
        judged = candidates.join(_shuffled(best_l), "l_pos").join(_shuffled(best_r), "r_pos")
        win = materialize(
            judged.filter("i = min_l AND i = min_r").select("l_pos", "r_pos"), "pairs"
        )
        accepted.append(win)
        candidates = materialize(
            candidates.join(_shuffled(win.select("l_pos")), "l_pos", "left_anti").join(
                _shuffled(win.select("r_pos")), "r_pos", "left_anti"
            ),
            "candidates",
        )
    return accepted


def neighbour_pairs(left: DataFrame, right: DataFrame, pairs: DataFrame, parts: Sequence[str], block: int = GAP_ROWS) -> DataFrame:
    """``pairs`` and the unpaired rows that follow or precede a pair in both tables and have equal ``parts``.

    Four passes: through the left table forwards, then backwards, then through the right one. A pass goes through the
    gap of unpaired rows after each pair (the backward ones also through the gap at the end of the table) with the row
    next to the pair's other half in hand: a row of the gap that equals the row in hand pairs with it, and the next one
    is taken in hand, until that is paired already. Rows of the gap that don't are passed over.

    Gaps are found as islands of positions and never share rows, so all are worked off at the same time. A gap of more
    than ``block`` rows is worked off block by block, one block a round, so no task sees more.
    """
    whole = F.to_json(F.array(*parts))
    # two hashes, so that unlike rows of large tables don't meet
    marks = [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2")]
    sides = [side.select("pos", *marks) for side in (left, right)]
    ends = [side.agg(F.coalesce(F.max("pos") + 1, F.lit(0)).alias("n")).first()["n"] for side in (left, right)]
    for near in (0, 1):
        for forwards in (True, False):
            more = _neighbour_pass(sides, pairs, ends, near, forwards, block)
            if more is None:
                return pairs
            pairs = pairs.unionByName(more)
    return pairs


def _islands(side: DataFrame, taken: DataFrame) -> DataFrame:
    """Unpaired rows with the number of their island of neighbouring positions."""
    rest = side.join(_shuffled(taken), "pos", "left_anti")
    return materialize(with_position(rest, ["pos"], "nth").select("pos", "k1", "k2", (F.col("pos") - F.col("nth")).alias("island")), "islands")


def _neighbour_pass(sides: list[DataFrame], pairs: DataFrame, ends: list[int], near: int, forwards: bool, block: int) -> DataFrame | None:
    """Pairs that one pass through table ``near`` finds; None where no unpaired rows are equal at all."""
    names = ["l_pos", "r_pos"]
    own, other = names[near], names[1 - near]
    taken = pairs.select(F.col(own).alias("own"), F.col(other).alias("far"))
    rows = _islands(sides[near], taken.select(F.col("own").alias("pos")))
    hand = _islands(sides[1 - near], taken.select(F.col("far").alias("pos")))
    marks = [side.select("k1", "k2").distinct() for side in (rows, hand)]
    if marks[0].join(_shuffled(marks[1]), ["k1", "k2"], "left_semi").isEmpty():
        return None
    step, border = (1, F.min) if forwards else (-1, F.max)
    gaps = rows.groupBy("island").agg(border("pos").alias("at")).withColumn("own", F.col("at") - step)
    runs = hand.groupBy("island").agg(border("pos").alias("hand")).select(F.col("island").alias("run"), "hand", (F.col("hand") - step).alias("far"))
    # numbers of rows as the last pair that is no pair: only gaps at the end are next to it
    anchors = taken if forwards else taken.unionByName(taken.sparkSession.createDataFrame([(ends[near], ends[1 - near])], "own long, far long"))
    state = materialize(gaps.join(_shuffled(anchors), "own").join(_shuffled(runs), "far").select("island", "run", "at", "hand"), "gaps")
    found = None
    while not state.isEmpty():
        reach = lambda c: F.col("pos").between(*((F.col(c), F.col(c) + block - 1) if forwards else (F.col(c) - block + 1, F.col(c))))
        gap = rows.join(state, "island").where(reach("at")).select("island", "run", F.lit(0).alias("side"), "pos", "k1", "k2")
        row = hand.withColumnRenamed("island", "run").join(state, "run").where(reach("hand")).select("island", "run", F.lit(1).alias("side"), "pos", "k1", "k2")
        order = F.col("pos") if forwards else F.desc("pos")
        both = gap.unionByName(row).repartition("island").sortWithinPartitions("island", F.desc("side"), order)
        out = materialize(both.mapInArrow(lambda b: _walked(b, step, block), "island long, run long, own long, far long, last boolean"), "neighbours")
        new = out.where("last IS NULL").select(F.col("own").alias(own), F.col("far").alias(other))
        found = new if found is None else found.unionByName(new)
        state = materialize(out.where("NOT last").select("island", "run", F.col("own").alias("at"), F.col("far").alias("hand")), "gaps")
    return found if found is not None else pairs.limit(0)


def _walked(batches: Iterator[pa.RecordBatch], step: int, block: int) -> Iterator[pa.RecordBatch]:
    """Per gap, the rows in hand first, then those of the gap: its pairs, and a row saying where to go on and whether it ends."""
    own = run = None
    hand: list[tuple[int, int, int]] = []
    seen = taken = 0
    last = None
    out: list[tuple] = []

    def closed() -> None:
        # the rows in hand are used up, or those of the gap: there may be more of them
        more = len(hand) == block if taken == len(hand) else seen == block
        out.append((own, run, last + step, (hand[taken][0] if taken < len(hand) else hand[-1][0] + step), not more))

    for batch in batches:
        for island, to, side, pos, k1, k2 in zip(*(c.to_pylist() for c in batch.columns)):
            if island != own:
                if last is not None:
                    closed()
                own, run, hand, seen, taken, last = island, to, [], 0, 0, None
            if side:
                hand.append((pos, k1, k2))
                continue
            if taken == len(hand) == block:
                continue  # the rest of this block needs the next rows in hand
            seen, last = seen + 1, pos
            if taken < len(hand) and hand[taken][1:] == (k1, k2):
                out.append((own, run, pos, hand[taken][0], None))
                taken += 1
        if out:
            yield _found(out)
            out.clear()
    if last is not None:
        closed()
    if out:
        yield _found(out)


def _found(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.bool_()]
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), kinds)], ["island", "run", "own", "far", "last"])


def pair_by_content(a: DataFrame, b: DataFrame, position: str, columns: Sequence[str] | None = None,
                    options: CompareOptions = EXACT, candidates: int = MAX_COLUMNS) -> DataFrame:
    """Rows ``(l, r)`` as :func:`sparkmart.operators.diff.pair_rows` gives them, paired without a key."""
    pairs = materialize(align_rows(a, b, position, columns, options, candidates), "alignment")
    left = a.select(F.col(position).alias("l_pos"), F.struct(*a.columns).alias("l"))
    right = b.select(F.col(position).alias("r_pos"), F.struct(*b.columns).alias("r"))
    linked = left.join(_shuffled(pairs), "l_pos", "left")
    return linked.join(right, "r_pos", "full_outer").select("l", "r")


def diff_without_key(a: DataFrame, b: DataFrame, position: str, columns: Sequence[str] | None = None,
                     options: CompareOptions = EXACT, candidates: int = MAX_COLUMNS) -> TableDiff:
    """Comparison of two tables whose rows are paired by content; ``position`` is their row number."""
    rows = pair_by_content(a, b, position, columns, options, candidates)
    return classify(rows, a, b, (), options, position=position)


def with_row_number(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add the dense row number that :func:`align_rows` and the context view need."""
    return with_position(df, order_by, name=name)

"""Near-duplicate vectors by NN-descent.

Equal vectors become one node with a number of copies. Each node has a list of its nearest nodes so far, at first the
best of short runs of nodes that random hyperplanes put next to each other. A round joins every node's neighbours, and
those that it is a neighbour of, with one another and keeps what improves a list; only pairs with an entry that is new
are looked at again, until few entries change. What a list holds at the threshold or above is checked in double precision
and becomes a link.

A list full of links is saturated: there may be more. It is enlarged to its whole component, without writing out pairs:
members within half the threshold's angle of the component's mean direction are linked with each other by the triangle
inequality and only need counting; the others are compared with all members, block by block, and counts leave the
blocks. Before that, links beyond are looked for: centres of saturated components are compared with each other, and where
their radii allow a link their members are; other nodes are searched once more with such components collapsed into their mean.

There are as many orders as let a pair at the threshold share a run with a chance of ``RECALL``; they grow with the table.

Recall is audited: nodes, those with the smallest hashes first, are compared with all vectors in blocks until ``LINKED`` of
them have a true link, all nodes are through, or ``AUDIT_MOST`` are. It is the mean of the shares of their links found, so that
a small family counts as much as a large one. Below ``RECALL`` the search is repeated with lists twice as long and twice as many
orders, and after ``ATTEMPTS`` it fails. Where no audited node of a larger table has a link, the recall is NaN: not measured.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different length
neither. Rows with a null id come back without a component. Repeated ids are vectors of their own with one id. The search
compares unit vectors in half precision (off by less than 0.002), the links are decided in double precision.
"""

from __future__ import annotations

import itertools
import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.components import components
from sparkmart.llm.frames import col
from sparkmart.runtime import materialize

LEAST = 0.9
NEIGHBOURS, ORDERS, RUN = 12, 4, 256
ENOUGH = 0.002
HUB, SLACK = 64, 0.005
BLOCK = 512
AUDIT, AUDIT_MOST, LINKED, RECALL, ATTEMPTS = 256, 8192, 128, 0.99, 5

_log = logging.getLogger(__name__)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, unit): bytes of the double-precision unit vector, null where a vector links with nothing."""
    for batch in batches:
        out = []
        for v in batch.column(1).to_pylist():
            unit = None
            if v and None not in v:
                x = np.array(v, np.float64)
                size = np.abs(x).max()
                if np.isfinite(x).all() and size > 0:
                    x = x / size  # no overflow, no underflow
                    unit = (x / np.sqrt(x @ x) + 0.0).tobytes()
            out.append(unit)
        yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["id", "unit"])


def _grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys, which come one after another, as one batch each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        edge = np.zeros(batch.num_rows, bool)
        for c in columns:
            edge[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(edge).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            key = tuple(c[low] for c in columns)
            if held and key != last:
                yield _one(held)
                held = []
            last = key
            held.append(batch.slice(low, high - low))
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1)


def _keyed(batches: Iterator[pa.RecordBatch], orders: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Each node once per order, with its key there: the signs of random projections, first plane highest."""
    bits = 48
    planes: dict[int, np.ndarray] = {}
    weight = (1 << np.arange(bits, dtype=np.int64))[::-1]
    for batch in batches:
        units = batch.column("unit").to_pylist()
        for size in sorted({len(u) for u in units}):
            at = [i for i, u in enumerate(units) if len(u) == size]
            x = np.frombuffer(b"".join(units[i] for i in at), np.float64).reshape(len(at), -1)
            if size not in planes:
                planes[size] = np.random.default_rng(seed).standard_normal((x.shape[1], orders * bits))
            half = [h.tobytes() for h in x.astype(np.float16)]
            node = batch.column("node").take(pa.array(at))
            for t in range(orders):
                key = (x @ planes[size][:, t * bits : (t + 1) * bits] > 0).astype(np.int64) @ weight
                yield pa.record_batch(
                    [node, pa.array([size * 65536 + t] * len(at), pa.int64()), pa.array(key), pa.array(half, pa.binary())], ["node", "order", "key", "half"]
                )


def _runs(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest of each node within runs of nodes next to each other in one order."""
    for group in _grouped(batches, "order"):
        for low in range(0, group.num_rows, RUN):
            part = group.slice(low, RUN)
            n = part.num_rows
            if n < 2:
                continue
            x = _matrix(part.column("half"), np.float16).astype(np.float32)
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            m = min(k, n - 1)
            near = np.argpartition(-sim, m - 1, axis=1)[:, :m]
            node = part.column("node").to_numpy()
            yield _edges(np.repeat(node, m), node[near.ravel()], np.take_along_axis(sim, near, 1).ravel())


def _edges(node: np.ndarray, other: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(sim, pa.float32()), pa.array(np.ones(len(node), bool))],
        ["node", "other", "sim", "fresh"],
    )


_LIST = "node long, other long, sim float, fresh boolean"


def _best(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best entries of each node; an entry that was there before isn't fresh."""

    def cut(table: pa.Table, whole: bool):
        node = table.column("node").to_numpy()
        keep = len(node) if whole else int(np.searchsorted(node, node[-1])) if len(node) else 0
        rest = table.slice(keep)
        other, sim, fresh = (table.column(c).to_numpy()[:keep] for c in ("other", "sim", "fresh"))
        node = node[:keep]
        order = np.lexsort((fresh, other, node))
        node, other, sim, fresh = node[order], other[order], sim[order], fresh[order]
        first = np.ones(keep, bool)
        first[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
        node, other, sim, fresh = node[first], other[first], sim[first], fresh[first]
        order = np.lexsort((other, -sim, node))
        node, other, sim, fresh = node[order], other[order], sim[order], fresh[order]
        start = np.searchsorted(node, node)
        good = np.arange(len(node)) - start < k
        return rest, pa.record_batch([pa.array(node[good]), pa.array(other[good]), pa.array(sim[good]), pa.array(fresh[good])], ["node", "other", "sim", "fresh"])

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows >= 200_000:
            held, out = cut(held, False)
            yield out
    if held is not None and held.num_rows:
        yield cut(held, True)[1]


def _met(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Per owner: its members with each other; pairs with a fresh entry that are better than one's worst.

    Of what a task has found for a node, only the best ``k`` go on, as no more can enter its list.
    """
    a_out, b_out, s_out, held = [], [], [], 0

    def best() -> pa.RecordBatch:
        a, b, s = (np.concatenate(c) for c in (a_out, b_out, s_out))
        node, other, sim = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((s, s))
        order = np.lexsort((other, node))
        order = order[np.concatenate(([True], (np.diff(node[order]) != 0) | (np.diff(other[order]) != 0)))]
        node, other, sim = node[order], other[order], sim[order]
        order = np.lexsort((-sim, node))
        node, other, sim = node[order], other[order], sim[order]
        good = np.arange(len(node)) - np.searchsorted(node, node) < k
        return _edges(node[good], other[good], sim[good])

    for group in _grouped(batches, "owner", "part"):
        fresh = group.column("fresh").to_numpy(zero_copy_only=False)
        if not fresh.any():
            continue
        member = group.column("member").to_numpy()
        order = np.lexsort((~fresh, member))
        order = order[np.concatenate(([True], member[order][1:] != member[order][:-1]))]
        member, fresh = member[order], fresh[order]
        x = _matrix(group.column("half").take(pa.array(order)), np.float16).astype(np.float32)
        worst = group.column("worst").to_numpy()[order]
        sim = x @ x.T
        i, j = np.nonzero(np.triu((sim > np.minimum.outer(worst, worst)) & (fresh[:, None] | fresh[None, :]), 1))
        if len(i):
            a_out.append(member[i])
            b_out.append(member[j])
            s_out.append(sim[i, j])
            held += len(i)
        if held > 500_000:
            yield best()
            a_out, b_out, s_out, held = [], [], [], 0
    if held:
        yield best()


def _deal(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def orders_for(count: int, least: float) -> int:
    """Orders in which a pair at ``least`` among ``count`` nodes shares a run with a chance of ``RECALL``, at least ``ORDERS``.

    A run is what agrees in the first log2(count / RUN) planes; a plane parts a pair with its angle's share of pi.
    """
    planes = math.log2(max(count / RUN, 1))
    share = (1 - math.acos(least) / math.pi) ** planes
    return max(ORDERS, math.ceil(math.log(1 - RECALL) / math.log(1 - share))) if share < 1 else ORDERS


def neighbour_lists(nodes: DataFrame, k: int, orders: int, seed: int) -> DataFrame:
    """(node, other, sim, fresh): the lists after NN-descent over ``nodes`` (node, unit).

    Rounds end when few entries are new, however many rounds that takes.
    """
    deal = _deal(nodes)
    placed = nodes.mapInArrow(lambda b: _keyed(b, orders, seed), "node long, `order` long, key long, half binary")
    dealt = placed.repartitionByRange(deal, "order", "key", "node").sortWithinPartitions("order", "key", "node")
    first = dealt.mapInArrow(lambda b: _runs(b, k), _LIST)

    def kept(entries: DataFrame, round_: int) -> DataFrame:
        best = entries.repartition(deal, "node").sortWithinPartitions("node").mapInArrow(lambda b: _best(b, k), _LIST)
        return materialize(best, f"neighbours-{round_}")

    lists = kept(first, 0)
    half = materialize(nodes.mapInArrow(_halves, "member long, half binary"), "neighbours-vectors")
    count = half.count()
    for round_ in itertools.count(1):
        worst = lists.groupBy("node").agg(F.min("sim").alias("low"), F.count("*").alias("n"))
        worst = worst.select(F.col("node").alias("of"), F.when(F.col("n") >= k, F.col("low")).otherwise(F.lit(-2.0)).cast("float").alias("worst_"))
        known = half.join(worst, half.member == worst.of, "left").select("member", "half", F.coalesce("worst_", F.lit(-2.0).cast("float")).alias("worst"))
        back = lists.select(F.col("other").alias("owner"), F.col("node").alias("member"), "fresh")
        hubs = back.groupBy("owner").agg(F.ceil(F.count("*") / HUB).cast("int").alias("parts")).where("parts > 1")
        hubs = hubs.select(F.col("owner").alias("hub"), "parts")
        ahead = lists.select(F.col("node").alias("owner"), F.col("other").alias("member"), "fresh")
        parts = F.coalesce("parts", F.lit(1))
        # a hub's own list meets each part of those that point to it
        ahead = ahead.join(hubs, ahead.owner == hubs.hub, "left").select("owner", "member", "fresh", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        back = back.join(hubs, back.owner == hubs.hub, "left").select("owner", "member", "fresh", F.pmod(F.hash("member"), parts).alias("part"))
        met = ahead.unionByName(back).join(known, "member").repartition(deal, "owner", "part").sortWithinPartitions("owner", "part")
        found = met.mapInArrow(lambda b: _met(b, k), _LIST)
        lists = kept(lists.withColumn("fresh", F.lit(False)).unionByName(found), round_)
        if lists.where("fresh").count() <= ENOUGH * count * k:
            return lists


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        half = [np.frombuffer(u, np.float64).astype(np.float16).tobytes() for u in batch.column("unit").to_pylist()]
        yield pa.record_batch([batch.column("node"), pa.array(half, pa.binary())], ["member", "half"])


def _close(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dots = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
        good = pa.array(np.array(dots, np.float64) >= least)
        yield batch.select(["a", "b"]).filter(good)


def _checked(pairs: DataFrame, nodes: DataFrame, least: float, label: str) -> DataFrame:
    """Those of the distinct pairs (a, b) whose cosine, in double precision, is at least ``least``."""
    one = nodes.select(F.col("node").alias("a"), F.col("unit").alias("x"))
    two = nodes.select(F.col("node").alias("b"), F.col("unit").alias("y"))
    joined = pairs.join(one, "a").join(two, "b").where(F.length("x") == F.length("y")).select("a", "b", "x", "y")
    return materialize(joined.mapInArrow(lambda b: _close(b, least), "a long, b long"), label)


def _sums(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each component, as far as this task has them."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for root, unit in zip(batch.column("root").to_pylist(), batch.column(name).to_pylist()):
            x = np.frombuffer(unit, np.float64)
            total[root] = total[root] + x if root in total else x
    if total:
        yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["root", "sum"])


def _angles(batches: Iterator[pa.RecordBatch], half: float) -> Iterator[pa.RecordBatch]:
    """(node, root, unit, copies, core): whether a member is within ``half`` of its component's mean direction."""
    for batch in batches:
        core = []
        for unit, mean in zip(batch.column("unit").to_pylist(), batch.column("sum").to_pylist()):
            x, m = np.frombuffer(unit, np.float64), np.frombuffer(mean, np.float64)
            size = math.sqrt(m @ m)
            core.append(size > 1e-9 and math.acos(max(-1.0, min(1.0, float(x @ m) / size))) <= half - 1e-6)
        yield pa.record_batch([*(batch.column(c) for c in ("node", "root", "unit", "copies")), pa.array(core)], ["node", "root", "unit", "copies", "core"])


def _counted(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Per block pair: how many copies each left member is linked with on the right, and each right core member on the left."""
    for group in _grouped(batches, "root", "left_block", "right_block"):
        left = group.filter(group.column("left"))
        right = group.filter(pa.compute.invert(group.column("left")))
        if not left.num_rows or not right.num_rows:
            continue
        a, b = left.column("node").to_numpy(), right.column("node").to_numpy()
        linked = _matrix(left.column("unit"), np.float64) @ _matrix(right.column("unit"), np.float64).T >= least
        linked &= a[:, None] != b[None, :]
        core = right.column("core").to_numpy(zero_copy_only=False)
        n_a = linked @ right.column("copies").to_numpy()
        n_b = (left.column("copies").to_numpy() @ linked) * core
        yield pa.record_batch([pa.array(np.concatenate((a, b)), pa.int64()), pa.array(np.concatenate((n_a, n_b)), pa.int64())], ["node", "n"])


def _enlarged(nodes: DataFrame, roots: DataFrame, wide: DataFrame, least: float) -> DataFrame:
    """(node, n): links of all members of the components ``wide`` (root), counted against the whole component."""
    deal = _deal(nodes)
    own = roots.join(wide, "root").join(nodes, "node").select("node", "root", "unit", "copies")
    own = materialize(own, "wide-members")
    sums = own.select("root", "unit").mapInArrow(lambda b: _sums(b, "unit"), "root long, sum binary")
    means = sums.repartition(deal, "root").mapInArrow(lambda b: _sums(b, "sum"), "root long, sum binary")
    half = math.acos(least) / 2
    measured = own.join(means, "root").mapInArrow(lambda b: _angles(b, half), "node long, root long, unit binary, copies long, core boolean")
    measured = materialize(measured, "wide-measured")
    size = measured.groupBy("root").agg(
        F.count("*").alias("n"), F.sum(F.when(~F.col("core"), 1).otherwise(0)).alias("rim"), F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("inside")
    )
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int")
    shape = size.select("root", "inside", blocks("n").alias("rights"), blocks("rim").alias("lefts"), F.col("rim"))
    placed = measured.join(shape, "root")
    rim = placed.where(~F.col("core")).select(
        "root", "node", "unit", "copies", "core", F.pmod(F.hash("node"), "lefts").alias("left_block"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("right_block"), F.lit(True).alias("left"),
    )
    every = placed.where("rim > 0").select(
        "root", "node", "unit", "copies", "core", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("left_block"),
        F.pmod(F.hash("node"), "rights").alias("right_block"), F.lit(False).alias("left"),
    )
    keys = ("root", "left_block", "right_block")
    compared = rim.unionByName(every).repartition(deal, *keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _counted(b, least), "node long, n long")
    inside = placed.where("core").select("node", (F.col("inside") - F.col("copies")).alias("n"))
    return compared.unionByName(inside).groupBy("node").agg(F.sum("n").alias("n"))


def _audited(nodes: DataFrame, links: DataFrame, least: float) -> float:
    """Mean share of their true links that was found, over audited nodes with a link; these are compared with all nodes.

    Nodes are taken until ``LINKED`` have a link. 1 if all nodes are audited and have none, NaN if ``AUDIT_MOST`` have none.
    """
    order = materialize(nodes.orderBy(F.xxhash64("node"), "node").limit(AUDIT_MOST).select("node", "unit"), "audit-nodes")
    total, done, step, shares = nodes.count(), 0, AUDIT, []
    while len(shares) < LINKED and done < min(total, AUDIT_MOST):
        picked = order.orderBy(F.xxhash64("node"), "node").offset(done).limit(min(step, AUDIT_MOST - done)).collect()
        done, step = done + len(picked), 2 * step
        true = nodes.select("node", "unit", "copies").mapInArrow(_comparer(picked, least), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
        both = true.where("n > 0").join(links.select("node", F.col("n").alias("got")), "node", "left")
        shares += [r["share"] for r in both.select((F.least("n", F.coalesce("got", F.lit(0))) / F.col("n")).alias("share")).collect()]
    _log.info("audit: %d of %d nodes compared, %d with a link", done, total, len(shares))
    if not shares:
        return 1.0 if done >= total else math.nan
    return sum(shares) / len(shares)


def _comparer(picked: list, least: float):
    """Counts how many copies each of the ``picked`` nodes (node, unit) is linked with in a batch (node, unit, copies)."""
    by_size: dict[int, list] = {}
    for r in picked:
        by_size.setdefault(len(r["unit"]), []).append(r)
    given = {n: (np.array([r["node"] for r in rs]), np.frombuffer(b"".join(r["unit"] for r in rs), np.float64).reshape(len(rs), -1)) for n, rs in by_size.items()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("unit").to_pylist()
            own, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
            for n, (ids, x) in given.items():
                at = np.array([i for i, u in enumerate(units) if len(u) == n], np.int64)
                if len(at):
                    y = np.frombuffer(b"".join(units[i] for i in at), np.float64).reshape(len(at), -1)
                    found = np.zeros(len(ids), np.int64)
                    for low in range(0, len(at), BLOCK):
                        part = slice(low, low + BLOCK)
                        linked = (x @ y[part].T >= least) & (ids[:, None] != own[at[part]][None, :])
                        found += linked @ copies[at[part]]
                    hit = np.flatnonzero(found)
                    yield pa.record_batch([pa.array(ids[hit]), pa.array(found[hit], pa.int64())], ["node", "n"])

    return compare


def _search(nodes: DataFrame, least: float, k: int, orders: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, root) of linked nodes and (node, n) with their numbers of linked copies."""
    lists = neighbour_lists(nodes.select("node", "unit"), k, orders, seed)
    near = lists.where(F.col("sim") >= least - SLACK).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    near = materialize(near, "links-near")
    links = _checked(near, nodes, least, "links")
    roots = components(links, "links-roots")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("n"))
    counted = materialize(counted, "links-counted")
    # an entry near the threshold that is no link takes a place in the list too
    ends = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node")))
    full = materialize(ends.groupBy("node").agg(F.count("*").alias("entries")).where(F.col("entries") >= k).select("node"), "links-full")
    roots = roots.unionByName(full.join(roots.select("node"), "node", "left_anti").select("node", F.col("node").alias("root")))
    wide = materialize(roots.join(full, "node").select("root").distinct(), "links-wide")
    if wide.isEmpty():
        return roots, counted
    roots = _beyond(nodes, roots, wide, least, k, orders, seed + 1)
    wide = roots.join(full, "node").select("root").distinct()
    more = materialize(_enlarged(nodes, roots, wide, least), "links-enlarged")
    rest = counted.join(more, "node", "left_anti").select("node", "n")
    return roots, rest.unionByName(more.select("node", "n"))


def _radii(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, unit, radius) of components, as far as this task has them: mean direction and the largest angle of a member.

    A mean of no direction gets the radius pi, so that nothing is ruled out.
    """
    found: dict[int, list] = {}
    for batch in batches:
        for root, unit, mean in zip(*(batch.column(c).to_pylist() for c in ("root", "unit", "sum"))):
            if root not in found:
                m = np.frombuffer(mean, np.float64)
                size = math.sqrt(m @ m)
                found[root] = [m / size, 0.0] if size > 1e-9 else [np.zeros(len(m)), math.pi]
            at = found[root]
            at[1] = max(at[1], math.acos(max(-1.0, min(1.0, float(np.frombuffer(unit, np.float64) @ at[0])))))
    if found:
        yield pa.record_batch(
            [pa.array(list(found), pa.int64()), pa.array([m.tobytes() for m, _ in found.values()], pa.binary()), pa.array([r for _, r in found.values()], pa.float64())],
            ["node", "unit", "radius"],
        )


def _facing(batches: Iterator[pa.RecordBatch], angle: float) -> Iterator[pa.RecordBatch]:
    """(root, far): pairs of centres whose members may be as near as ``angle``, going by the components' radii."""
    for group in _grouped(batches, "size", "left_block", "right_block"):
        left = group.filter(group.column("left"))
        right = group.filter(pa.compute.invert(group.column("left")))
        if not left.num_rows or not right.num_rows:
            continue
        a, b = left.column("node").to_numpy(), right.column("node").to_numpy()
        apart = np.arccos(np.clip(_matrix(left.column("unit"), np.float64) @ _matrix(right.column("unit"), np.float64).T, -1, 1))
        most = np.add.outer(left.column("radius").to_numpy(), right.column("radius").to_numpy()) + angle + 1e-6
        meet = apart <= most
        if group.column("left_block")[0] == group.column("right_block")[0]:
            meet &= a[:, None] < b[None, :]  # both sides hold the same centres
        i, j = np.nonzero(meet)
        yield pa.record_batch([pa.array(a[i]), pa.array(b[j])], ["root", "far"])


def _asking(batches: Iterator[pa.RecordBatch], angle: float) -> Iterator[pa.RecordBatch]:
    """(root, node, unit): nodes that may be as near as ``angle`` to a member of the component, going by its radius."""
    for batch in batches:
        good = []
        for unit, mean, radius in zip(*(batch.column(c).to_pylist() for c in ("unit", "mean", "radius"))):
            dot = float(np.frombuffer(unit, np.float64) @ np.frombuffer(mean, np.float64)) if len(unit) == len(mean) else -2.0
            good.append(dot > -2 and math.acos(max(-1.0, min(1.0, dot))) <= radius + angle + 1e-6)
        yield batch.select(["root", "node", "unit"]).filter(pa.array(good, pa.bool_()))


def _beyond(nodes: DataFrame, roots: DataFrame, wide: DataFrame, least: float, k: int, orders: int, seed: int) -> DataFrame:
    """``roots`` after links from saturated components to other nodes have been looked for.

    A link between two saturated components may be in neither end's list, so all pairs of their centres are compared, in
    blocks; where the radii allow a link, the members of one that are near enough to the other's centre meet its members.
    A link with an unsaturated node belongs into that node's own list. Such nodes are looked for once more in lists in
    which the members stand aside and one mean vector stands for each component, by entries of either side.
    """
    deal, angle = _deal(nodes), math.acos(least)
    members = materialize(roots.join(wide, "root").join(nodes, "node").select("node", "root", "unit"), "beyond-members")
    sums = members.select("root", "unit").mapInArrow(lambda b: _sums(b, "unit"), "root long, sum binary")
    means = sums.repartition(deal, "root").mapInArrow(lambda b: _sums(b, "sum"), "root long, sum binary")
    part = members.join(means, "root").mapInArrow(_radii, "node long, unit binary, radius double")
    # tasks agree on a component's mean; it is taken from the first, the radius is the largest
    centres = materialize(part.groupBy("node").agg(F.first("unit").alias("unit"), F.max("radius").alias("radius")), "beyond-centres")

    others = nodes.select("node", "unit").join(members.select("node"), "node", "left_anti")
    lists = neighbour_lists(materialize(others.unionByName(centres.select("node", "unit")), "beyond-nodes"), k, orders, seed)
    entries = lists.select("node", "other", "sim").unionByName(lists.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim"))
    reach = F.cos(F.least(F.lit(math.pi), F.col("radius") + angle)) - SLACK
    near = entries.join(centres.select("node", "radius"), "node").where(F.col("sim") >= reach)
    near = near.select(F.col("node").alias("root"), F.col("other").alias("node")).join(centres.select("node"), "node", "left_anti").distinct()
    single = near.join(nodes.select("node", "unit"), "node").select("root", "node", "unit")

    blocks = max(1, math.ceil(centres.count() / (4 * BLOCK)))
    own = centres.withColumn("size", F.length("unit")).withColumn("block", F.pmod(F.hash("node"), F.lit(blocks)))
    left = own.withColumn("left", F.lit(True)).withColumn("left_block", F.col("block")).withColumn("right_block", F.explode(F.sequence("block", F.lit(blocks - 1))))
    right = own.withColumn("left", F.lit(False)).withColumn("right_block", F.col("block")).withColumn("left_block", F.explode(F.sequence(F.lit(0), "block")))
    keys = ("size", "left_block", "right_block")
    pairs = left.unionByName(right).repartition(deal, *keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _facing(b, angle), "root long, far long")
    pairs = pairs.join(centres.select(F.col("node").alias("root"), F.col("unit").alias("mean"), "radius"), "root")
    far = members.select(F.col("root").alias("far"), "node", "unit")
    asking = pairs.join(far, "far").select("root", "node", "unit", "mean", "radius").mapInArrow(lambda b: _asking(b, angle), "root long, node long, unit binary")
    asked = materialize(single.unionByName(asking), "beyond-asked")

    keys = ("root", "left_block", "right_block")
    count = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rights"))
    asks = asked.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("lefts"))
    shape = count.join(asks, "root")
    left = asked.join(shape, "root").select(
        "root", "node", "unit", F.pmod(F.hash("node"), "lefts").alias("left_block"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("right_block"), F.lit(True).alias("left"),
    )
    right = members.join(shape, "root").select(
        "root", "node", "unit", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("left_block"),
        F.pmod(F.hash("node"), "rights").alias("right_block"), F.lit(False).alias("left"),
    )

    def first_links(batches):
        for group in _grouped(batches, *keys):
            l, r = group.filter(group.column("left")), group.filter(pa.compute.invert(group.column("left")))
            if l.num_rows and r.num_rows:
                linked = _matrix(l.column("unit"), np.float64) @ _matrix(r.column("unit"), np.float64).T >= least
                hit = np.flatnonzero(linked.any(axis=1))
                if len(hit):
                    other = r.column("node").to_numpy()[linked[hit].argmax(axis=1)]
                    yield pa.record_batch([pa.array(l.column("node").to_numpy()[hit]), pa.array(other)], ["a", "b"])

    met = left.unionByName(right).repartition(deal, *keys).sortWithinPartitions(*keys).mapInArrow(first_links, "a long, b long")
    found = materialize(met, "beyond-links")
    if found.isEmpty():
        return roots
    star = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    merged = components(found.unionByName(star), "beyond-roots")
    alone = roots.join(merged.select("node"), "node", "left_anti")
    return merged.unionByName(alone)


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", least: float = LEAST, k: int = NEIGHBOURS, orders: int | None = None
) -> tuple[DataFrame, float]:
    """(id, n_links, component) per row of ``vectors``, and the audited recall of the links, which is ``RECALL`` or more.

    Fails where ``ATTEMPTS`` searches stay below that; the recall is NaN where the audit met no link.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    given = vectors.select(col(id_column).alias("id"), col(vector).cast("array<double>").alias("vector"))
    rows = given.mapInArrow(_units, f"id {kind}, unit binary").withColumn("node", F.when(F.col("unit").isNotNull(), F.xxhash64("unit")))
    rows = materialize(rows, "vectors")
    able = rows.where(F.col("node").isNotNull() & F.col("id").isNotNull())
    nodes = materialize(able.groupBy("node").agg(F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min("id").alias("low")), "nodes")
    orders = orders or orders_for(nodes.count(), least)
    seed, recall = 7, 0.0
    for attempt in range(ATTEMPTS):
        roots, counted = _search(nodes, least, k << attempt, orders << attempt, seed + 10 * attempt)
        recall = _audited(nodes, counted, least)
        _log.info("lists of %d, %d orders: recall %.4f", k << attempt, orders << attempt, recall)
        if math.isnan(recall):
            _log.warning("recall not measured: none of %d audited nodes has a link", AUDIT_MOST)
        if not recall < RECALL:
            break
    else:
        raise RuntimeError(f"recall {recall:.4f} is below {RECALL} after {ATTEMPTS} searches, the last with lists of {k << attempt}")
    linked = nodes.join(roots, "node", "left").join(counted, "node", "left").select(
        "node", "low", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    least_id = linked.groupBy("root").agg(F.min("low").alias("component"))
    named = linked.join(least_id, "root").select(F.col("node").alias("of"), "n_links", "component")
    ok = (rows.node == named.of) & rows.id.isNotNull()
    out = rows.join(named, ok, "left").select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component"))
    return out, recall

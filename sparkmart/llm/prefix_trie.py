"""Prefix trie of conversations, summed up by time-forward processing.

1. Turns are put in order by a range sort and numbered, conversations get the head of another one in place of their
   own, and a second range sort runs a 128-bit hash along each conversation: the hash of its first ``d`` turns names the
   trie node they lead to. Sums that cross a partition are carried on by one row per partition, so neither sort needs a
   conversation in one task.
2. Rows with the same hash are one node. Nodes are cut into connected shards: every ``BAND`` levels, and, within a band,
   below the nodes that have more than ``BUDGET`` turns of the band beneath them. Their number is known from counts per
   slot of the hash, which have a fixed bound; a node in the slot of a large one counts as large, which only cuts finer.
3. Within a shard, nodes come externally sorted in reverse level order, deepest first. Each takes the messages of its
   children from a priority queue, adds up, and sends its total to its parent's place in the queue; the queue holds the
   next level only and spills sorted runs to the shared scratch folder. A first run gives the totals of the shard roots,
   those are added up along the tree of shards (by doubling the distance to the ancestor, so a tree of any height takes
   few rounds), and a second run, with the messages from other shards at hand, gives all nodes.

Order of turns: by turn (null first), role, text; repeated rows each count. A null role or text is empty, rows with a
null conversation id are ignored. No rows give no nodes, not even a root. Two sequences share a 128-bit hash with a
chance far below 1e-15 at 10^10 nodes. Only the four named columns are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmart.llm import spans as S
from sparkmart.llm.frames import col, shared_uri
from sparkmart.runtime import materialize, scratch_path

HEADS, FAMILY = 6, 100
BAND = 64
BUDGET = 1 << 18
SLOTS = 1 << 20
QUEUE_ROWS = 1 << 20
SEGMENT_IDS = 2000

ROOT = b"\0" * 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _keys(column: pa.Array) -> np.ndarray:
    """Binary values of 16 bytes as a numpy array that sorts as Spark sorts them; a null is the root."""
    fixed = pc.fill_null(column.cast(pa.binary()), ROOT).cast(pa.binary(16))
    return np.frombuffer(fixed.buffers()[1], "S16")[fixed.offset : fixed.offset + len(fixed)]


def _binary(lanes: np.ndarray) -> pa.Array:
    """Rows of two 64-bit numbers as binary values."""
    at = np.arange(0, 16 * len(lanes) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lanes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(lanes).tobytes())])


def _lanes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(_keys(column).tobytes(), np.uint64).reshape(-1, 2)


def _run_sums(owner: np.ndarray, value: np.ndarray, carry: tuple[int | None, np.ndarray]) -> tuple[np.ndarray, tuple[int, np.ndarray]]:
    """Running sums of ``value`` that start anew with each ``owner``, carried on from the batch before."""
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    total = np.cumsum(value, axis=0, dtype=value.dtype)
    start = np.flatnonzero(new)
    before = total[start] - value[start]
    if owner[0] == carry[0]:
        before[0] -= carry[1]
    total = total - np.repeat(before, np.diff(np.append(start, len(owner))), axis=0)
    return total, (int(owner[-1]), total[-1])


def _sorted_pass(rows: DataFrame, order: list[Column], work, schema: str, label: str) -> DataFrame:
    """``rows`` range-sorted, then through ``work(batches, part)`` and written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        return work((b for b in batches if b.num_rows), context.partitionId() if context else 0)

    return materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), label)


def _offsets(rows: DataFrame, value: str, add, zero) -> list:
    """What each partition's first conversation had in the partitions before; one row per partition reaches the driver."""
    ends = rows.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "place", value)).alias("last"))
    out: dict[int, object] = {}
    conv, sofar = None, zero
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        before = sofar if r["first"] == conv else zero
        out[r["part"]] = before
        own = r["last"][value]
        sofar = add(before, own) if r["last"]["conv"] == r["first"] else own
        conv = r["last"]["conv"]
    return [out.get(p, zero) for p in range(max(out, default=-1) + 1)]


def numbered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, digest, chars): turns of each conversation numbered from 1; texts stay behind."""
    given = rows.where(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
        F.coalesce(col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"),
    )
    mark = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))

    def number(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        carry, first = (None, np.int64(0)), None
        for b in batches:
            owner = b.column(0).to_numpy()
            first = owner[0] if first is None else first
            place, carry = _run_sums(owner, np.ones(len(owner), np.int64), carry)
            yield pa.record_batch(
                [b.column(0), b.column(1), b.column(2), pa.array(np.full(len(owner), part), pa.int32()), pa.array(place), pa.array(owner == first)],
                ["conv", "digest", "chars", "part", "place", "first"],
            )

    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("row")]
    # the sort needs the texts, the pass behind it only their digests
    narrow = given.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", mark.alias("digest"), F.char_length("text").cast("long").alias("chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        return number((b for b in batches if b.num_rows), context.partitionId() if context else 0)

    placed = materialize(narrow.mapInArrow(run, "conv long, digest binary, chars long, part int, place long, first boolean"), "trie-turns")
    before = _offsets(placed.withColumn("n", F.col("place")), "n", lambda a, b: a + b, 0)
    constant = F.split(F.lit(",".join(map(str, before or [0]))), ",").cast("array<bigint>")
    moved = F.when(F.col("first"), F.get(constant, F.col("part"))).otherwise(F.lit(0))
    return placed.select("conv", (F.col("place") + moved).alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, pos, digest, chars, len): each conversation with the head of its family's first one, and a row at pos 0."""
    sizes = materialize(turns.groupBy("conv").agg(F.max("pos").alias("n")), "trie-sizes")
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS))
    base = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    info = (
        sizes.withColumns({"base": F.col("conv") - F.col("conv") % FAMILY, "h": head}).join(base, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
        .select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    )
    info = materialize(info, "trie-lengths")
    heads = turns.where(F.col("pos") < HEADS).withColumnRenamed("conv", "from")
    borrowed = info.join(heads, (F.col("base") == F.col("from")) & (F.col("pos") <= F.col("taken"))).select("conv", "pos", "digest", "chars", "len")
    own = turns.join(info, "conv").where("pos > h").select("conv", F.expr("taken + pos - h").alias("pos"), "digest", "chars", "len")
    start = info.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"), "len")
    return borrowed.unionByName(own).unionByName(start)


def paths(rows: DataFrame) -> DataFrame:
    """(conv, pos, chars, len, node, parent, slot): the trie node that each first ``pos`` turns lead to."""

    def hashed(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        carry, first = (None, np.zeros(2, np.uint64)), None
        for b in batches:
            owner, pos = b.column(0).to_numpy(), b.column(1).to_numpy()
            first = owner[0] if first is None else first
            with np.errstate(over="ignore"):
                term = S.mix(_lanes(b.column(2)) ^ S.mix(pos.astype(np.uint64)[:, None] * _LANES))
                term[pos == 0] = 0
                total, carry = _run_sums(owner, term, carry)
                up = total - term
            yield pa.record_batch(
                [b.column(0), b.column(1), b.column(3), b.column(4), _binary(total), _binary(up),
                 pa.array(np.full(len(owner), part), pa.int32()), pa.array(owner == first)],
                ["conv", "pos", "chars", "len", "node", "parent", "part", "first"],
            )

    schema = "conv long, pos long, chars long, len long, node binary, parent binary, part int, first boolean"
    given = rows.select("conv", "pos", "digest", "chars", "len")
    local = _sorted_pass(given, [F.col("conv"), F.col("pos")], hashed, schema, "trie-paths")

    def add(a: bytes, b: bytes) -> bytes:
        with np.errstate(over="ignore"):
            return (np.frombuffer(bytes(a), np.uint64) + np.frombuffer(bytes(b), np.uint64)).tobytes()

    before = np.frombuffer(b"".join(_offsets(local.withColumn("place", F.col("pos")), "node", add, ROOT)), np.uint64).reshape(-1, 2)

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            plus = before[b.column("part").to_numpy()] * b.column("first").to_numpy(zero_copy_only=False).astype(np.uint64)[:, None]
            with np.errstate(over="ignore"):
                node, up = _lanes(b.column("node")) + plus, _lanes(b.column("parent")) + plus
            slot = (S.mix(node[:, 0] ^ node[:, 1]) % np.uint64(SLOTS)).astype(np.int32)
            yield pa.record_batch([*b.columns[:4], _binary(node), _binary(up), pa.array(slot)], ["conv", "pos", "chars", "len", "node", "parent", "slot"])

    out = local.mapInArrow(shifted, "conv long, pos long, chars long, len long, node binary, parent binary, slot int")
    return materialize(out, "trie-rows")


def trie_nodes(rows: DataFrame, budget: int, band: int) -> DataFrame:
    """(node, parent, depth, chars, shard, conv, n_convs); ``shard`` is the topmost node of the node's shard."""
    banded = rows.withColumn("band", F.floor(F.col("pos") / band))
    below = F.least(F.col("len"), (F.col("band") + 1) * band - 1) - F.col("pos")
    loads = banded.groupBy("slot").agg(F.sum(below).alias("n")).where(F.col("n") > budget).select("slot", F.lit(True).alias("large"))
    marked = banded.join(materialize(loads, "trie-large"), "slot", "left")  # at most SLOTS rows
    within = Window.partitionBy("conv", "band")  # at most ``band`` rows
    here = F.struct("pos", "node")
    small = F.min(F.when(F.col("large").isNull(), here)).over(within)
    placed = marked.withColumns({"top": F.min(here).over(within), "small": small}).withColumn(
        "shard", F.when(F.col("pos") >= F.col("small.pos"), F.col("small.node")).otherwise(F.col("top.node"))
    )
    keys = ["node", "parent", "pos", "chars", "shard"]
    nodes = placed.groupBy(*keys).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"))
    return materialize(nodes.withColumnRenamed("pos", "depth"), "trie-nodes")


class MessageQueue:
    """Priority queue of messages (key, leaves, saved, children) to the level above, taken in the order of their keys.

    Messages pushed while a level is worked off belong to the next; ``next_level`` seals them. Beyond ``most`` rows they
    are added up by key, sorted and spilled as a run under ``folder``; runs are read back block by block.
    """

    def __init__(self, folder: str, most: int):
        self.folder, self.most = folder, most
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = self.number = 0
        self.filling: list = []
        self.runs: list = []

    def push(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.held.append((keys, values))
        self.rows += len(keys)
        if self.rows >= self.most:
            self._combine()
            if self.rows >= self.most // 2:
                self._spill()

    def _combine(self) -> None:
        self.held = [_added([k for k, _ in self.held], [v for _, v in self.held])] if self.held else []
        self.rows = sum(len(k) for k, _ in self.held)

    def _spill(self) -> None:
        system, name = pafs.FileSystem.from_uri(self.folder)
        if not self.number:
            system.create_dir(name, recursive=True)
        self.number += 1
        name = f"{name}/{self.number}"
        keys, values = self.held.pop()
        schema = pa.schema([("key", pa.binary(16)), *((c, pa.int64()) for c in ("leaves", "saved", "children"))])
        with system.open_output_stream(name) as sink, pa.ipc.new_stream(sink, schema) as writer:
            for at in range(0, len(keys), 65536):
                cut = slice(at, at + 65536)
                size = len(keys[cut])
                key = pa.Array.from_buffers(pa.binary(16), size, [None, pa.py_buffer(keys[cut].tobytes())])
                writer.write_batch(pa.record_batch([key, *(pa.array(values[cut, k]) for k in range(3))], schema=schema))
        self.filling.append(_Run(system, name))
        self.rows = 0

    def next_level(self) -> None:
        self._combine()
        for run in self.runs:
            run.close()
        self.runs = self.filling + [_Run(held=x) for x in self.held]
        self.filling, self.held, self.rows = [], [], 0

    def take(self, upto: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Messages with keys up to ``upto``, added up by key."""
        got = [part for run in self.runs for part in run.take(upto)]
        return _added([k for k, _ in got], [v for _, v in got])

    def close(self) -> None:
        self.next_level()
        for run in self.runs:
            run.close()
        if self.number:
            system, name = pafs.FileSystem.from_uri(self.folder)
            system.delete_dir(name)


def _added(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, "S16"), np.zeros((0, 3), np.int64)
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[start], np.add.reduceat(value, start, axis=0) if len(key) else value


class _Run:
    """Sorted messages in memory or in a spilled file."""

    def __init__(self, system=None, name: str = "", held=None):
        self.file = system.open_input_stream(name) if system else None
        self.blocks = iter(pa.ipc.open_stream(self.file)) if system else iter(())
        self.held = held

    def take(self, upto: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        while True:
            if self.held is None:
                block = next(self.blocks, None)
                if block is None:
                    return
                self.held = _keys(block.column(0)), np.column_stack([block.column(k).to_numpy() for k in (1, 2, 3)])
            keys, values = self.held
            n = int(np.searchsorted(keys, np.bytes_(upto), "right"))
            if n:
                yield keys[:n], values[:n]
            self.held = (keys[n:], values[n:]) if n < len(keys) else None
            if self.held is not None:
                return

    def close(self) -> None:
        if self.file:
            self.file.close()


def _forward(batches: Iterator[pa.RecordBatch], folder: str, most: int, all_nodes: bool) -> Iterator[pa.RecordBatch]:
    """Nodes (depth, node, parent, shard, leaves, saved, children, ...) deepest first; their totals, or those of shard roots."""
    context = TaskContext.get()
    queue = MessageQueue(f"{folder}/{context.taskAttemptId() if context else 0}", most)
    level = None
    for batch in batches:
        depth = batch.column("depth").to_numpy()
        edge = [0, *(np.flatnonzero(np.diff(depth)) + 1), len(depth)]
        for a, b in zip(edge, edge[1:]):
            if a == b:
                continue
            if depth[a] != level:
                # levels without a node in between can't have messages
                queue.next_level()
                level = depth[a]
            part = batch.slice(a, b - a)
            key, up, shard = (_keys(part.column(c)) for c in ("node", "parent", "shard"))
            total = np.column_stack([part.column(c).to_numpy() for c in ("leaves", "saved", "children")])
            got, sums = queue.take(key[-1])
            total[np.searchsorted(key, got)] += sums
            total[total[:, 2] == 0, 0] = 1
            inner = key != shard
            if inner.any():
                value = total[inner].copy()
                value[:, 2] = 1
                queue.push(*_added([up[inner]], [value]))
            out = np.ones(len(key), bool) if all_nodes else ~inner
            if out.any():
                pick = pa.array(out)
                yield pa.record_batch(
                    [part.column("node").filter(pick), *(pa.array(total[out, k]) for k in range(3))], ["node", "leaves", "saved", "children"]
                )
    queue.close()


def _totals(nodes: DataFrame, folder: str, deal: int, most: int, all_nodes: bool, label: str) -> DataFrame:
    own = nodes.select(
        F.col("depth"), "node", "parent", "shard", F.coalesce("leaves", F.lit(0)).alias("leaves"),
        (F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("chars")).alias("saved"), F.coalesce("children", F.lit(0)).alias("children"),
    )
    dealt = own.repartition(deal, "shard").sortWithinPartitions(F.desc("depth"), "node")
    run = dealt.mapInArrow(lambda b: _forward(b, folder, most, all_nodes), "node binary, leaves long, saved long, children long")
    return materialize(run, label)


def _shard_totals(roots: DataFrame) -> DataFrame:
    """Totals of whole subtrees from the shards' own: (node, up, leaves, saved) with ``up`` the shard above."""
    state = roots
    while not state.where("up is not null").isEmpty():
        more = state.where("up is not null").groupBy("up").agg(F.sum("leaves").alias("plus"), F.sum("saved").alias("plus_saved"))
        more = more.withColumnRenamed("up", "to")
        # a shard whose ancestor has none above itself has nothing to look up
        above = state.where("up is not null").select(F.col("node").alias("mid"), F.col("up").alias("far"))
        state = materialize(
            state.join(more, F.col("node") == F.col("to"), "left").join(above, F.col("up") == F.col("mid"), "left")
            .select("node", F.col("far").alias("up"), (F.col("leaves") + F.coalesce("plus", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("plus_saved", F.lit(0))).alias("saved")),
            "trie-shards",
        )
    return state


def _ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end: ids in order, joined in segments, then hashed one by one."""

    def joined(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, ids = _keys(b.column(0)), b.column(1).to_numpy()
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            at = [i for a, z in zip(edge, edge[1:]) for i in range(a, z, SEGMENT_IDS)]
            text = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(at, [*at[1:], len(ids)])]
            yield pa.record_batch([b.column(0).take(pa.array(at)), pa.array(ids[at]), pa.array(text, pa.string())], ["node", "low", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = None, None
        for b in batches:
            out = []
            for node, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if node != own:
                    if own is not None:
                        out.append((own, state.hexdigest()))
                    own, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.record_batch([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["node", "ends_sha256"])
        if own is not None:
            yield pa.record_batch([pa.array([own], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    last = rows.where("pos = len").select("node", "conv")
    parts = _sorted_pass(last, [F.col("node"), F.col("conv")], joined, "node binary, low long, ids string", "trie-ends")
    return parts.repartition("node").sortWithinPartitions("node", "low").mapInArrow(hashed, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                budget: int = BUDGET, band: int = BAND, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per trie node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256."""
    spark = conversations.sparkSession
    rows = paths(rebuilt(numbered_turns(conversations, conv, turn, role, text)))
    nodes = trie_nodes(rows, budget, band)
    folder = shared_uri(spark, scratch_path(spark, "trie-queue"))
    deal = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() // (4 * budget)))
    roots = nodes.where("depth > 0 and node = shard")
    outer = roots.groupBy("parent").agg(F.count("*").alias("children")).withColumnRenamed("parent", "of")
    none = F.lit(0).cast("long")
    first = _totals(
        nodes.join(outer, F.col("node") == F.col("of"), "left").withColumns({"leaves": none, "saved": none}), folder, deal, queue_rows, False, "trie-partial"
    )
    homes = nodes.select(F.col("node").alias("above"), F.col("shard").alias("up"))
    linked = nodes.where("node = shard").select("node", F.when(F.col("depth") > 0, F.col("parent")).alias("parent"))
    tree = materialize(
        first.join(linked, "node").join(homes, F.col("parent") == F.col("above"), "left").select("node", "up", "leaves", "saved"), "trie-shards"
    )
    whole = _shard_totals(tree)
    sent = whole.join(roots.select("node", "parent"), "node").groupBy(F.col("parent").alias("of")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count("*").alias("children")
    )
    total = _totals(nodes.join(sent, F.col("node") == F.col("of"), "left"), folder, deal, queue_rows, True, "trie-totals")
    parents = nodes.select(F.col("node").alias("above"), F.col("conv").alias("parent_conv_id"))
    above = F.when(F.col("depth") > 0, F.col("parent"))
    return (
        nodes.select("node", above.alias("parent"), "depth", "conv", "n_convs").join(total, "node").join(_ends(rows), "node", "left")
        .join(parents, F.col("parent") == F.col("above"), "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )

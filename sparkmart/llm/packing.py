"""Best-two-fit packing of token sequences into sequences of ``CAPACITY`` tokens.

Only lengths matter, so the packing is planned on counts by length: at most ``CAPACITY`` numbers, however large the
corpus. A plan is a list of patterns (which lengths share a sequence, how often). Each pattern is filled greedily, always
with the longest that still fits; then its smallest document is replaced by the two unpacked ones that fill the gap it
leaves most tightly, as long as that leaves less room. A pattern is used as often as the counts allow, which uses up a
length, so there are about as many patterns as lengths.

Documents get their places by their rank among those of equal length. Ranks come from (partition, length) counts that
are summed up over the partitions, so no length, however frequent, meets in one task. Full pieces of long documents need
no plan: each is a sequence of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkmart.llm.byte_tokens import END, encoder
from sparkmart.llm.frames import col
from sparkmart.runtime import materialize

CAPACITY = 1024


def greedy(counts: np.ndarray, room: int, most: int) -> list[int]:
    """The longest lengths that fit, one after another; ``most`` is the longest looked at. ``counts`` isn't changed."""
    left, out = counts, {}
    length = min(room, most)
    while length > 0:
        free = int(left[length]) - out.get(length, 0)
        if free > 0:
            take = min(free, room // length)
            out[length] = out.get(length, 0) + take
            room -= take * length
        length = min(length - 1, room)
    return [n for n, k in sorted(out.items(), reverse=True) for _ in range(k)]


def _two(counts: np.ndarray, used: dict[int, int], room: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum that fits into ``room``; of equal sums that with the longest one."""
    free = counts.copy()
    for length, k in used.items():
        free[length] -= k
    have = np.flatnonzero(free[: room + 1] > 0)
    have = have[have > 0]
    best, pair = 0, None
    below = np.concatenate(([0], np.maximum.accumulate(np.where(free[: room + 1] > 0, np.arange(min(room + 1, len(free))), 0)[1:])))
    for a in have[::-1]:
        if 2 * a < best:
            break
        b = int(below[min(room - a, a)]) if room - a > 0 else 0
        if b == a and free[a] < 2:
            b = int(below[a - 1])
        if b and a + b > best:
            best, pair = int(a + b), (int(a), b)
            if best == room:
                break
    return pair


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths, times) that use up ``counts`` (index: length, 0 to ``capacity``)."""
    counts = counts.astype(np.int64).copy()
    out = []
    while (have := np.flatnonzero(counts)).size:
        longest = int(have[-1])
        lengths = [longest]
        rest = counts.copy()
        rest[longest] -= 1
        lengths += greedy(rest, capacity - longest, capacity)
        while len(lengths) > 1 and sum(lengths) < capacity:
            smallest = lengths[-1]
            used: dict[int, int] = {}
            for n in lengths[:-1]:
                used[n] = used.get(n, 0) + 1
            pair = _two(counts, used, capacity - sum(lengths) + smallest)
            if pair is None or sum(pair) <= smallest:
                break
            lengths = sorted([*lengths[:-1], *pair], reverse=True)
        own = np.bincount(lengths, minlength=len(counts))
        times = int((counts[own > 0] // own[own > 0]).min())
        counts -= own * times
        out.append((lengths, times))
    return out


class Places:
    """Where the document with a given rank among its length goes: lookup tables that grow with patterns only."""

    def __init__(self, patterns: list[tuple[list[int], int]], capacity: int = CAPACITY):
        taken = np.zeros(capacity + 1, np.int64)
        rows, sequence = [], 0
        for lengths, times in patterns:
            offset = 0
            for length in dict.fromkeys(lengths):
                k = lengths.count(length)
                rows.append((length, int(taken[length]), sequence, k, offset))
                taken[length] += k * times
                offset += k * length
            sequence += times
        rows.sort()
        self.count = sequence
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.length, self.rank, self.sequence, self.many, self.offset = (np.ascontiguousarray(x) for x in table.T)
        self.edge = np.searchsorted(self.length, np.arange(capacity + 2))

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset."""
        at = np.empty(len(length), np.int64)
        for n in np.unique(length):
            here = length == n
            low, high = self.edge[n], self.edge[n + 1]
            at[here] = low + np.searchsorted(self.rank[low:high], rank[here], "right") - 1
        inner = rank - self.rank[at]
        return self.sequence[at] + inner // self.many[at], self.offset[at] + inner % self.many[at] * length


def byte_ids(texts: list[str | None]) -> list[bytes]:
    """Ids of each text and the id that ends a document."""
    encode, end = encoder().encode, np.array([END], "<u4").tobytes()
    return [encode(t or "") + end for t in texts]


def pieces(docs: DataFrame, id_column: str, text: str, capacity: int, ids: Callable[[list], list[bytes]], with_ids: bool) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, its partition (part) and its rank among equal lengths there.

    ``with_ids`` adds the token ids themselves.
    """
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("piece", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "part", "rank")]
        + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    )
    given = docs.select(col(id_column).alias("id"), col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                some = batch.slice(low, 512)
                out: list[tuple] = []
                cut_ids: list[np.ndarray] = []
                for row, raw in enumerate(ids(some.column(1).to_pylist())):
                    total = len(raw) // 4
                    start = 0
                    for piece in range(-(-total // capacity)):
                        length = (total % capacity or capacity) if piece == 0 else capacity
                        crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                        out.append((row, piece, start, length, crc, part, int(seen[length])))
                        if with_ids:
                            cut_ids.append(np.frombuffer(raw, "<u4", length, 4 * start).astype(np.int32))
                        seen[length] += 1
                        start += length
                columns = list(zip(*out))
                yield pa.record_batch(
                    [some.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
                    + [pa.array(c, pa.int64()) for c in columns[2:]]
                    + ([pa.array(cut_ids, pa.list_(pa.int32()))] if with_ids else []),
                    schema.names,
                )

    return given.mapInArrow(cut, schema)


def packed(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, ids: Callable[[list], list[bytes]] = byte_ids,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece of each row of ``docs``; ``with_ids`` adds ids.

    Documents of up to ``capacity`` tokens stay whole; longer ones are cut into pieces, the first of which may be
    shorter. ``ids`` turns texts into bytes of 32-bit ids and has at least one id a text. A null text counts as empty,
    a null or repeated id is kept as it is: each row is packed. An empty table gives an empty table.
    """
    rows = materialize(pieces(docs, id_column, text, capacity, ids, with_ids), "packing-pieces")
    per = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    run = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(per.select("part", "length", "n", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before")), "packing-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    full, counts[capacity] = int(counts[capacity]), 0
    places = Places(plan(counts, capacity), capacity)
    ranked = rows.join(before.drop("n"), ["part", "length"])
    columns = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = T.StructType([rows.schema[c] for c in columns] + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("at").to_numpy()
            sequence, offset = rank.copy(), np.zeros(len(rank), np.int64)
            short = length < capacity
            if short.any():
                sequence[short], offset[short] = places.of(length[short], rank[short])
                sequence[short] += full
            yield pa.record_batch([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], schema.names)

    return ranked.select(*columns, (F.col("rank") + F.col("before")).alias("at")).mapInArrow(place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of rows that ``packed`` gave ``with_ids``: the training sequences themselves.

    A group has the pieces of one sequence, at most its capacity of tokens.
    """
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda x: x["ids"])).alias("ids"))

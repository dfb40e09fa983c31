"""Records of delimited text whose quoted fields hold line breaks, read in splits.

Where a line begins, it is either outside of quotes, and then a record begins, or inside, and then it goes on. A split
can't know which, but it can say for both cases how its last line ends, which makes it a function from two states to two.
One scan gives these functions; put together in file order they give the state in which each split begins. A second
scan then cuts every split into records; a record that runs over a border comes in fragments, at most two per split,
which are put together apart. Both scans read as many splits as any text file has.

Quotes count where a field begins with one and until the field's closing quote; doubled ones don't close. Lines end with
a line feed, with or without a carriage return.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.runtime import materialize

_WHERE = "file string, start long, size long"


@lru_cache(maxsize=8)
def _patterns(sep: str) -> tuple[re.Pattern, re.Pattern]:
    """Lines that end inside quotes, from outside and from inside; possessive, so the time is linear."""
    s = re.escape(sep)
    rest = f'"(?:[^"{s}][^{s}]*+)?+'  # a closing quote and what may follow it in a careless file
    closed = f'(?:"(?:[^"]++|"")*+{rest}|[^"{s}][^{s}]*+)?+{s}'
    opened = '"(?:[^"]++|"")*+'
    outside = re.compile(f"(?:{closed})*+{opened}")
    inside = re.compile(f'(?:[^"]++|"")*+(?:{rest}{s}(?:{closed})*+{opened})?+')
    return outside, inside


def _ends_inside(line: str, inside: bool, sep: str) -> bool:
    if '"' not in line:
        return inside
    return _patterns(sep)[inside].fullmatch(line) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    block = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "size"))]
    return spark.read.text(path, lineSep="\n").select(*block, "value")


def may_have_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any line has an odd number of quotes; without one no quoted field holds a line break."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return not spark.read.text(path, lineSep="\n").where(quotes % 2 == 1).isEmpty()


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], pa.Array, bool]]:
    """Lines split by split in file order, with whether a split goes on from the batch before."""
    own = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        runs = pc.run_end_encode(batch.column(1))
        low = 0
        for high in runs.run_ends.to_pylist():
            at = (batch.column(0)[low].as_py(), batch.column(1)[low].as_py(), batch.column(2)[low].as_py())
            # equal starts of neighbouring files are told apart by their names
            names = batch.column(0).slice(low, high - low)
            if names[0] == names[-1]:
                yield at, batch.column(3).slice(low, high - low), at == own
                own = at
            else:
                for k in range(low, high):
                    one = (batch.column(0)[k].as_py(), at[1], batch.column(2)[k].as_py())
                    yield one, batch.column(3).slice(k, 1), one == own
                    own = one
            low = high


def _functions(batches: Iterator[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """Per split: whether it ends inside quotes if it begins outside, and if it begins inside."""
    own, state = None, [False, True]

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([x]) for x in (*own, *state)], ["file", "start", "size", "outside", "inside"])

    for at, lines, again in _by_split(batches):
        if not again:
            if own is not None:
                yield row()
            own, state = at, [False, True]
        for line in lines.to_pylist():
            if '"' in line:
                line = line.removesuffix("\r")
                both = [_ends_inside(line, False, sep), _ends_inside(line, True, sep)]
                state = [both[s] for s in state]
    if own is not None:
        yield row()


def _cut(batches: Iterator[pa.RecordBatch], begins: dict[tuple[str, int], tuple[int, bool]], sep: str) -> Iterator[pa.RecordBatch]:
    """Records (kind 0) and the fragments at the borders of splits: heads (1), tails (2) and middles (3)."""
    own, held, inside, headless = None, [], False, False
    names = ["file", "start", "kind", "first", "value"]
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        done = pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)
        out.clear()
        return done

    def close() -> None:
        if held:
            out.append((own[0], own[1], 3 if headless else 1, False, "\n".join(held)))

    for at, lines, again in _by_split(batches):
        if not again:
            close()
            if begins.get(at[:2], (None,))[0] != at[2]:
                raise RuntimeError("the input was split in another way between two scans; run the read again")
            own, held = at, []
            inside = headless = begins[at[:2]][1]
            top = at[1] == 0
        for line in lines.to_pylist():
            held.append(line)
            if '"' in line:
                inside = _ends_inside(line.removesuffix("\r"), inside, sep)
            if inside:
                continue
            text = held[0] if len(held) == 1 else "\n".join(held)
            held = []
            out.append((own[0], own[1], 2 if headless else 0, top, text.removesuffix("\r")))
            headless = top = False
            if len(out) >= 5000:
                yield batch()
    close()
    if out:
        yield batch()


def records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(value, first): every record as one text, and whether it is the first of its file; blank records are left out."""
    lines = _lines(spark, path)
    found = lines.mapInArrow(lambda b: _functions(b, sep), _WHERE + ", outside boolean, inside boolean").collect()  # one row per split
    begins: dict[tuple[str, int], tuple[int, bool]] = {}
    state, name = False, None
    for r in sorted(found, key=lambda r: (r["file"], r["start"])):
        state = state if r["file"] == name else False
        name = r["file"]
        begins[name, r["start"]] = (r["size"], state)
        state = r["inside"] if state else r["outside"]
    cut = lines.mapInArrow(lambda b: _cut(b, begins, sep), "file string, start long, kind int, first boolean, value string")
    rows = materialize(cut, "records")
    whole = rows.where("kind = 0").select("value", "first")
    if rows.where("kind > 0").isEmpty():
        return whole.where("trim(value) != ''")
    # at most two per split; a head begins a record, what follows up to the next head belongs to it
    before = Window.partitionBy("file").orderBy("start", F.col("kind") == 1)
    parts = rows.where("kind > 0").withColumn("record", F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).over(before))
    joined = parts.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("start", (F.col("kind") == 1).alias("head"), "value"))).alias("parts"), F.min("start").alias("start")
    )
    whole_again = joined.select(F.array_join(F.col("parts.value"), "\n").alias("value"), F.lit(False).alias("first"))
    return whole.unionByName(whole_again).where("trim(value) != ''")

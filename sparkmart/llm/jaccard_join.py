"""N-gram Jaccard self-join by grouped prefixes.

1. Texts become sets of hashed word shingles, block by block (a block is a run of rows of one input partition). Hashes
   go to buckets in packed, sorted runs; a bucket counts in how many texts each occurs and sends those that occur at
   least twice back to their blocks.
2. With its shingles in rising order of that count, a text can only be linked with one that shares a shingle of its
   prefix, the first ``size - ceil(t * size) + 1``. Shingles of one text only come first and can't be shared, so a text
   with enough of them drops out, and only shared shingles are indexed and compared.
3. Texts with equal sets are one class; classes with the same size and the same prefix are one group. Of the groups on
   a prefix shingle's list the smallest leads; a list's pairs all lie among the groups that its leader gathers.
4. Leaders are compared with the members of their groups; then, under each leader, members not yet connected with the
   leader's largest component are compared with all members of fitting size, in blocks. Overlaps are counted exactly
   inside a block pair, and only links that connect something new leave it. No pair is skipped but those already
   connected, so the components are those of the full join, and no list of all pairs is ever made.

Hashes: 64 bits for the size of a set and for its class, 48 bits for overlaps; two given texts disagree about an overlap
with a chance of about 1e-9. A null text or one without words has an empty set and is linked with nothing. Rows with a
null id are returned with a null component and take no part. Repeated rows and ids are joined like others.
``docs`` should be read from files (projections and filters allowed): blocks are numbered by partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import spans as S
from sparkmart.llm.components import components
from sparkmart.llm.frames import col
from sparkmart.llm.packed import pack, unpack
from sparkmart.runtime import materialize

WIDTH = 5
PERCENT = 75
BLOCK_SHINGLES = 1_500_000
SIDE = 256

_PARTS = "block long, bucket int, head binary, ids binary, sizes binary, marks binary, hashes binary, places binary"


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    return size - (size * percent + 99) // 100 + 1


def _parts(batches: Iterator[pa.RecordBatch], width: int, buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    """Shingle sets of whole texts as packed runs (block, bucket, hashes, places), and a head for each block."""
    context = TaskContext.get()
    low = (context.partitionId() if context else 0) << 32
    held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    rows = shingles = number = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, rows, shingles, number
        place, h = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
        order = np.argsort(h, kind="stable")
        place, h = place[order], h[order]
        bucket = ((h >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        block = low | number
        out = {k: [] for k in ("block", "bucket", "head", "ids", "sizes", "marks", "hashes", "places")}

        def add(b, head=None, sizes=None, marks=None, hashes=None, places=None):
            for k, v in zip(out, (block, b, head, None, sizes, marks, hashes, places)):
                out[k].append(v)

        ids = pa.chunked_array([x[0] for x in held]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as writer:
            writer.write_batch(pa.record_batch([ids], ["id"]))
        add(number % buckets, sink.getvalue().to_pybytes(), pack(np.concatenate([x[3] for x in held])),
            np.concatenate([x[4] for x in held]).tobytes())
        for b in range(buckets):
            at = slice(edge[b], edge[b + 1])
            if edge[b] < edge[b + 1]:
                add(b, hashes=pack(h[at].astype(np.int64)), places=pack(place[at]))
        held, rows, shingles, number = [], 0, 0, number + 1
        types = [pa.int64(), pa.int32()] + [pa.binary()] * 6
        return pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    for batch in batches:
        for part in S.chunks(batch, "text"):
            texts = S.texts_of(part.column(1))
            text, _, h = S.windows(S.words(texts, lower=True), width, short=True)
            order = np.lexsort((h, text))
            text, h = text[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
            text, h = text[new], h[new]
            size = np.bincount(text, minlength=len(texts))
            mark = np.zeros(len(texts), np.uint64)
            with np.errstate(over="ignore"):
                np.add.at(mark, text, S.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
                mark = S.mix(mark + S.mix(size.astype(np.uint64)))
            short = h >> np.uint64(16)
            once = np.ones(len(short), bool)
            once[1:] = (text[1:] != text[:-1]) | (short[1:] != short[:-1])
            held.append((part.column(0), text[once] + rows, short[once], size, mark))
            rows += len(texts)
            shingles += len(h)
            if shingles >= most:
                yield flush()
    if held:
        yield flush()


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of equal ``key``, which come one after another."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and rows[0][key] != row[key]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


_SHARED = "block long, head binary, sizes binary, marks binary, hashes binary, places binary, counts binary"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: hashes that at least two texts have, sent back block by block with their counts; heads pass."""
    schema = pa.schema([("block", pa.int64())] + [(k, pa.binary()) for k in ("head", "sizes", "marks", "hashes", "places", "counts")])
    for rows in _by_key(batches, "bucket"):
        for r in rows:
            if r["head"] is not None:
                yield pa.RecordBatch.from_pylist([{k: r.get(k) for k in schema.names}], schema)
        runs = [r for r in rows if r["hashes"] is not None]
        if not runs:
            continue
        hashes = [unpack(r["hashes"]) for r in runs]
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        first = np.concatenate(([True], h[order][1:] != h[order][:-1]))
        start = np.flatnonzero(first)
        times = np.empty(len(h), np.int64)
        times[order] = np.repeat(np.diff(np.append(start, len(h))), np.diff(np.append(start, len(h))))
        at = 0
        for r, own in zip(runs, hashes):
            n = times[at : at + len(own)]
            at += len(own)
            many = n > 1
            if many.any():
                row = {"block": r["block"], "hashes": pack(own[many]), "places": pack(unpack(r["places"])[many]), "counts": pack(n[many])}
                yield pa.RecordBatch.from_pylist([{k: row.get(k) for k in schema.names}], schema)


def _classified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Per block: every text with its size and class; those that can have links with group, prefix and shared set."""
    for rows in _by_key(batches, "block"):
        head = next(r for r in rows if r["head"] is not None)
        ids = pa.ipc.open_stream(head["head"]).read_all().column("id").combine_chunks()
        size, mark = unpack(head["sizes"]), np.frombuffer(head["marks"], np.int64)
        runs = [r for r in rows if r["hashes"] is not None]
        none = np.zeros(0, np.int64)
        h = np.concatenate([none, *(unpack(r["hashes"]) for r in runs)])
        place = np.concatenate([none, *(unpack(r["places"]) for r in runs)])
        times = np.concatenate([none, *(unpack(r["counts"]) for r in runs)])
        order = np.lexsort((h, times, place))
        h, place = h[order], place[order]
        edge = np.searchsorted(place, np.arange(len(size) + 1))
        have = np.diff(edge)
        reach = np.where(size > 0, prefix_length(size, percent) - (size - have), 0)  # shared shingles in the prefix
        group: list = [None] * len(size)
        prefix: list = [None] * len(size)
        tokens: list = [None] * len(size)
        for i in np.flatnonzero((reach > 0) & (have > 0)):
            own = h[edge[i] : edge[i + 1]]
            prefix[i] = own[: reach[i]]
            word = np.concatenate(([size[i]], prefix[i])).astype(np.uint64)
            with np.errstate(over="ignore"):
                spread = S.mix(word + np.arange(len(word), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                group[i] = int(S.mix(spread.sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])
            tokens[i] = pack(np.sort(own))
        step = 2000
        for a in range(0, len(size), step):
            cut = slice(a, a + step)
            yield pa.record_batch(
                [ids.slice(a, step), pa.array(size[cut], pa.int64()), pa.array([m if s else None for m, s in zip(mark[cut].tolist(), size[cut])], pa.int64()),
                 pa.array(group[cut], pa.int64()), pa.array(prefix[cut], pa.list_(pa.int64())), pa.array(tokens[cut], pa.binary())],
                ["id", "n_shingles", "class", "group", "prefix", "tokens"],
            )


def shingled(docs: DataFrame, id_column: str, text: str, width: int, percent: int, block: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, n_shingles, class, group, prefix, tokens) per row, written."""
    given = docs.select(col(id_column).alias("id"), col(text).alias("text"))
    deal = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 2 * deal  # more input comes with more partitions
    parts = given.mapInArrow(lambda b: _parts(b, width, buckets, block), _PARTS)
    shared = parts.repartition(deal, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared, _SHARED)
    out = f"id {given.schema['id'].dataType.simpleString()}, n_shingles long, class long, `group` long, prefix array<long>, tokens binary"
    done = shared.repartition(deal, "block").sortWithinPartitions("block").mapInArrow(lambda b: _classified(b, percent), out)
    return materialize(done, "jaccard-sets")


def _links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Per block pair: exact overlaps of the left with the right side; the links that connect something new."""

    def grouped():
        rows: list[dict] = []
        key = None
        for batch in batches:
            for row in batch.to_pylist():
                at = (row["lead"], row["piece"])
                if rows and at != key:
                    yield rows
                    rows = []
                key = at
                rows.append(row)
        if rows:
            yield rows

    for rows in grouped():
        left = [r for r in rows if r["left"]]
        right = [r for r in rows if not r["left"]]
        if not left or not right:
            continue
        sets = [unpack(r["tokens"]) for r in right]
        size = np.array([r["size"] for r in right])
        all_tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        if len(left) > 1:
            order = np.argsort(all_tokens, kind="stable")
            all_tokens, owner = all_tokens[order], owner[order]
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while above.setdefault(x, x) != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        a_out, b_out = [], []
        for r in left:
            own = unpack(r["tokens"])
            if len(left) > 1:
                lo, hi = np.searchsorted(all_tokens, own), np.searchsorted(all_tokens, own, "right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(sets))
            else:
                near = np.minimum(np.searchsorted(own, all_tokens), len(own) - 1)
                both = np.bincount(owner[own[near] == all_tokens], minlength=len(sets))
            for k in np.flatnonzero(100 * both >= percent * (size + r["size"] - both)):
                if r["class"] != right[k]["class"]:
                    x, y = root(r["root"]), root(right[k]["root"])
                    if x != y:
                        above[x] = y
                        a_out.append(r["class"])
                        b_out.append(right[k]["class"])
        if a_out:
            yield pa.record_batch([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])


def _verified(pieces: DataFrame, classes: DataFrame, percent: int, label: str) -> DataFrame:
    """Links among (lead, piece, left, class, root), where a piece's left side is compared with its other rows."""
    sets = classes.select("class", "size", "tokens")
    deal = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.join(sets, "class").repartition(deal, "lead", "piece").sortWithinPartitions("lead", "piece")
    return materialize(dealt.mapInArrow(lambda b: _links(b, percent), "a long, b long"), label)


def linked(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between classes of ``shingled`` rows that span the components of the whole join."""
    able = rows.where(F.col("group").isNotNull() & F.col("id").isNotNull())
    classes = materialize(
        able.groupBy("class").agg(
            F.first("group").alias("group"), F.first("n_shingles").alias("size"), F.first("prefix").alias("prefix"), F.first("tokens").alias("tokens")
        ),
        "jaccard-classes",
    )
    groups = classes.groupBy("group").agg(F.count("*").alias("n"), F.min_by("prefix", "class").alias("prefix"))
    listed = groups.select("group", "n", F.explode("prefix").alias("shingle"))
    leads = listed.groupBy("shingle").agg(F.min("group").alias("lead"), F.sum("n").alias("n")).where("n > 1").drop("n")
    gathered = listed.drop("n").join(leads, "shingle").select("lead", "group").distinct()
    members = materialize(gathered.join(classes.select("group", "class", "size"), "group").select("lead", "group", "class", "size"), "jaccard-members")

    # the leader's first class against all
    first = members.where("lead = group").groupBy("lead").agg(F.min("class").alias("class"))
    count = members.groupBy("lead").agg(F.count("*").alias("n"))
    cut = F.ceil(F.col("n") / (2 * SIDE)).cast("int")
    stars = (
        first.join(count, "lead").select("lead", F.explode(F.sequence(F.lit(0), cut - 1)).alias("piece"), "class").withColumn("left", F.lit(True))
    ).unionByName(
        members.join(count, "lead").select("lead", F.pmod(F.hash("class"), cut).alias("piece"), "class").withColumn("left", F.lit(False))
    )
    star = _verified(stars.withColumn("root", F.col("class")), classes, percent, "jaccard-stars")
    root = components(star, "jaccard-roots")
    known = members.join(root, members["class"] == root.node, "left").select(
        "lead", "class", "size", F.coalesce("root", "class").alias("root")
    )
    known = materialize(known, "jaccard-known")

    # under each leader: what is outside its largest component against all of fitting size
    part = known.groupBy("lead", "root").agg(F.count("*").alias("n"))
    main = part.groupBy("lead").agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    open_rows = known.join(main.select("lead", F.col("top.root").alias("main")), "lead").withColumn(
        "band", F.floor(F.log("size") / F.lit(float(np.log(100 / percent) * 1.0001))).cast("int")
    )
    sizes = open_rows.groupBy("lead", "band").agg(F.count("*").alias("n"), F.sum(F.when(F.col("root") != F.col("main"), 1).otherwise(0)).alias("open"))
    blocks = sizes.select(
        "lead", "band", F.ceil(F.col("n") / (2 * SIDE)).cast("int").alias("rights"), F.ceil(F.col("open") / SIDE).cast("int").alias("lefts")
    )
    near = blocks.select("lead", F.col("band").alias("at"), "lefts").where("lefts > 0")
    pairs = near.join(blocks.drop("lefts"), "lead").where("abs(band - at) <= 1")
    name = lambda l, r: F.xxhash64("at", l, "band", r)
    lefts = (
        open_rows.where("root != main").withColumnRenamed("band", "at").join(pairs.select("lead", "at", "lefts", "band", "rights"), ["lead", "at"])
        .withColumn("l", F.pmod(F.hash("class"), F.col("lefts"))).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
        .select("lead", name("l", "r").alias("piece"), "class", "root", F.lit(True).alias("left"))
    )
    rights = (
        open_rows.join(pairs.select("lead", "at", "lefts", "band", "rights"), ["lead", "band"])
        .withColumn("r", F.pmod(F.hash("class"), F.col("rights"))).withColumn("l", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
        .select("lead", name("l", "r").alias("piece"), "class", "root", F.lit(False).alias("left"))
    )
    rest = _verified(lefts.unionByName(rights), classes, percent, "jaccard-rest")
    return star.unionByName(rest)


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component) per row of ``docs``; component is the smallest id reachable by links."""
    rows = shingled(docs, id_column, text, width, percent)
    roots = components(linked(rows, percent), "jaccard-components")
    low = rows.where(F.col("group").isNotNull() & F.col("id").isNotNull()).groupBy("class").agg(F.min("id").alias("low"))
    placed = low.join(roots, low["class"] == roots.node, "left").select("class", "low", F.coalesce("root", "class").alias("root"))
    least = placed.groupBy("root").agg(F.min("low").alias("component"))
    named = placed.join(least, "root").select(F.col("class").alias("of"), "component")
    joined = rows.join(named, (rows["class"] == named.of) & rows["group"].isNotNull() & rows.id.isNotNull(), "left")
    return joined.select("id", "n_shingles", F.coalesce("component", "id").alias("component"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that with the smallest id; rows without words or without id all stay.

    Rows are known by id and a digest of the text, so of two texts under one id each is judged by itself; of linked
    ones that with the smaller digest stays. Rows that repeat id and text count once.
    """
    mark = F.unhex(F.md5(F.coalesce(col(text), F.lit("")).cast("binary")))
    key = F.when(col(id_column).isNotNull(), F.struct(col(id_column).alias("id"), mark.alias("mark")))
    keyed = docs.select(key.alias("key"), col(text).alias("text"))
    found = materialize(jaccard_components(keyed, "key", "text"), "jaccard-found")
    same = (col(id_column) == F.col("gone.id")) & (mark == F.col("gone.mark"))
    # this list grows with the corpus: it is joined by a shuffle at every size
    gone = found.where("id != component").select(F.col("id").alias("gone")).distinct().hint("merge")
    kept = docs.join(gone, same, "left_anti")
    many = found.where("n_shingles > 0 and id = component").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("gone"))
    if many.isEmpty():
        return kept
    again = kept.join(many, same, "left_semi").dropDuplicates([id_column, text])
    return kept.join(many, same, "left_anti").unionByName(again)

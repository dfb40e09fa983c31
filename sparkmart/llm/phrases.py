"""Phrase collocations per language, counted in truncated suffix subtrees that are partitioned by word prefix.

1. Texts are lower-cased (A-Z), cut into pieces and words, and written as blocks of word numbers with their own
   dictionaries, one language a block. Words are known by a 64-bit hash of language and word; the table of all distinct
   words shows whether two of them share a hash, and then another seed is taken, so counts are exact. What is sent later
   are as many bits of the hash as tell the frequent words from all others, by the same table.
2. Vertical partitioning: a suffix (the words from some position on, at most ``DEPTH``, up to the end of its piece or
   the first rare word) belongs to the subtree of its first word. A prefix whose count exceeds a quarter of the memory
   budget is extended by one word, again and again; the resulting light prefixes are dealt into as many groups as keep
   the expected total of a group at half the budget. Heavy prefixes are marked in slots of a hash, counted per task, so
   the map of prefixes has a fixed bound; a light prefix in a marked slot is extended as well, which changes nothing.
3. Every task sends the suffixes of its blocks, equal ones counted first, to the groups in packed rows. A group sorts its suffixes,
   which is its depth-truncated subtree laid out flat: a node is a run with a common prefix, and its count is the sum
   of the leaves in the run. Nodes with at least ``least`` occurrences leave the group. Extended prefixes have their
   leaves in several groups; their own totals are sent and added up apart.
4. Cuts, scores and the test for longer phrases of the same count are joins on the table of nodes, in exact decimals.

The words of a suffix are tested for being frequent with a bit table of fixed size, which may let rare words through
but never stops a frequent one. Nulls: a null text is empty; a null language is ``und``. Repeated rows count each time;
an empty table gives no phrase. Only the text and language columns are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkmart.llm import spans as S
from sparkmart.llm.frames import col
from sparkmart.llm.packed import pack, unpack
from sparkmart.runtime import materialize

DEPTH = 5
LEAST = 100
TOP = 2000
BUDGET = 1 << 22
BLOCK_WORDS, ROUTE_WORDS = 1 << 19, 1 << 22
MOST_BITS, MOST_SLOTS = 1 << 26, 1 << 22
SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _STOP.copy()
_GAP[[32, 9]] = True
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_BLOCKS = "lang string, words array<string>, counts array<long>, hashes array<long>, ids binary"
_PACKED = "subtrees int, hashes binary, codes binary, heads binary, counts binary"


def words_of(texts: S.Texts) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts in order, and whether each begins a piece."""
    data = _LOWER[texts.data]
    gap = _GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[texts.offsets] = True
    start = np.flatnonzero(~gap & (np.concatenate(([True], gap[:-1])) | edge[:-1]))
    end = np.flatnonzero(~gap & (np.concatenate((gap[1:], [True])) | edge[1:])) + 1
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])])
    piece = np.searchsorted(np.flatnonzero(_STOP[data]), start)
    text = np.searchsorted(texts.offsets, start, side="right")
    first = np.ones(len(start), bool)
    first[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    return found, first


def _blocks(batches: Iterator[pa.RecordBatch], most: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Texts (lang, text) as blocks of one language: distinct words, counts, hashes; numbers of words, 0 before a piece."""
    held: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
    sizes: dict[str, int] = {}

    def flush(lang: str) -> pa.RecordBatch:
        parts = held.pop(lang)
        sizes.pop(lang)
        coded = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
        first = np.concatenate([p[1] for p in parts])
        code = coded.indices.to_numpy().astype(np.int64)
        ids = np.zeros(len(code) + int(first.sum()), np.int64)
        ids[np.arange(len(code)) + np.cumsum(first)] = code + 1
        head = lang.encode() + b"\0"
        distinct = coded.dictionary.cast(pa.string())
        # zero stands for a gap
        hashes = [xxhash.xxh3_64_intdigest(head + w, seed) or 1 for w in distinct.cast(pa.binary()).to_pylist()]
        signed = np.array(hashes, np.uint64).view(np.int64)
        counts = np.bincount(code, minlength=len(distinct))
        return pa.record_batch(
            [pa.array([lang]), pa.ListArray.from_arrays([0, len(distinct)], distinct), pa.ListArray.from_arrays([0, len(counts)], pa.array(counts, pa.int64())),
             pa.ListArray.from_arrays([0, len(signed)], pa.array(signed)), pa.array([pack(ids)], pa.binary())],
            ["lang", "words", "counts", "hashes", "ids"],
        )

    for batch in batches:
        langs = batch.column(0)
        for lang in pc.unique(langs).to_pylist():
            own = batch.filter(pc.equal(langs, lang))
            for part in S.chunks(own, "text"):
                found, first = words_of(S.texts_of(part.column(1)))
                if len(found):
                    held.setdefault(lang, []).append((found, first))
                    sizes[lang] = sizes.get(lang, 0) + len(found)
                if sizes.get(lang, 0) >= most:
                    yield flush(lang)
                elif sum(sizes.values()) >= 4 * most:
                    yield flush(max(sizes, key=sizes.get))
    for lang in list(held):
        yield flush(lang)


def _distinct_words(blocks: DataFrame) -> DataFrame:
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts", "hashes")).alias("w"))
    return each.groupBy("lang", F.col("w.words").alias("word"), F.col("w.hashes").alias("hash")).agg(F.sum("w.counts").alias("n"))


def encoded(docs: DataFrame, text: str, lang: str, block: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Written blocks and the written table of all distinct words (lang, word, hash, n), no hash of which repeats."""
    given = docs.select(F.coalesce(col(lang), F.lit("und")).alias("lang"), col(text).alias("text"))
    for seed in range(8):
        blocks = materialize(given.mapInArrow(lambda b, seed=seed: _blocks(b, block, seed), _BLOCKS), "phrase-blocks")
        words = materialize(_distinct_words(blocks), "phrase-words")
        if words.groupBy("hash").count().where("count > 1").isEmpty():
            return blocks, words
    raise RuntimeError("word hashes collide under every seed")


class Partition:
    """Which words are frequent, which prefixes are heavy, and the group of every other prefix."""

    def __init__(self, frequent: np.ndarray, slots: int, groups: int, bits: int):
        self.frequent, self.slots, self.groups = frequent, slots, groups
        #: the bits of a hash that tell frequent words from all others
        self.bits = np.uint64(bits)
        self.marks: dict[int, np.ndarray] = {}

    def suffixes(self, ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """Word codes with room for ``DEPTH`` words behind the last, hashes by code, prefix hashes by depth, lengths.

        Codes count the block's frequent words from 1; 0 is a gap, a rare word included.
        """
        at = hashes & np.uint64(len(self.frequent) * 8 - 1)
        known = (self.frequent[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        renumber = np.zeros(len(hashes) + 1, np.int64)
        renumber[1:][known] = np.arange(1, int(known.sum()) + 1)
        codes = np.concatenate((renumber[ids], np.zeros(DEPTH, np.int64)))
        of = np.concatenate(([np.uint64(0)], hashes[known]))
        n = len(ids)
        value = of[codes]
        prefix = [value[:n]]
        length = (codes[:n] > 0).astype(np.int8)
        with np.errstate(over="ignore"):
            for d in range(1, DEPTH):
                length += (length == d) & (codes[d : d + n] > 0)
                prefix.append(S.mix(prefix[-1] * _FACTOR + value[d : d + n]))
        return codes, of, prefix, length

    def marked(self, depth: int, prefix: np.ndarray) -> np.ndarray:
        return self.marks[depth][(prefix & np.uint64(self.slots - 1)).astype(np.int64)]

    def mark(self, depth: int, at: list[int]) -> None:
        self.marks[depth] = np.zeros(self.slots, bool)
        self.marks[depth][at] = True


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and hashes of each block."""
    for batch in batches:
        hashes, ids = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield unpack(ids[i].as_py()), hashes[i].values.to_numpy(zero_copy_only=False).view(np.uint64)


def _slot_counts(batches: Iterator[pa.RecordBatch], plan: Partition, depth: int) -> Iterator[pa.RecordBatch]:
    """Occurrences by slot of prefixes of ``depth`` words whose shorter prefixes are all marked."""
    total = np.zeros(plan.slots, np.int64)
    for ids, hashes in _rows(batches):
        _, _, prefix, length = plan.suffixes(ids, hashes)
        at = np.flatnonzero(length >= depth)
        for d in range(1, depth):
            at = at[plan.marked(d, prefix[d - 1][at])]
        total += np.bincount((prefix[depth - 1][at] & np.uint64(plan.slots - 1)).astype(np.int64), minlength=plan.slots)
    slot = np.flatnonzero(total)
    yield pa.record_batch([pa.array(slot, pa.int64()), pa.array(total[slot], pa.int64())], ["slot", "n"])


def _ordered(codes: list[np.ndarray], first: list[np.ndarray], most: int) -> np.ndarray:
    """Order of rows by ``first`` and then their codes (columns of numbers up to ``most``)."""
    bits = int(most).bit_length()
    if 3 * bits <= 63:
        b = np.int64(bits)
        keys = []
        for columns in (codes[:3], codes[3:]):
            key = columns[0].astype(np.int64)
            for c in columns[1:]:
                key <<= b
                key |= c
            keys.append(key)
        codes = keys
    return np.lexsort([*reversed(codes), *reversed(first)])


def _changes(columns: list[np.ndarray], n: int) -> np.ndarray:
    """Rows that differ from the row before in any column."""
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _narrow(of: np.ndarray) -> type:
    """Type of the codes of so many words."""
    return np.uint16 if len(of) <= 1 << 16 else np.int32


def _routes(ids: np.ndarray, hashes: np.ndarray, plan: Partition) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of a block: word codes by depth, hashes by code, groups, and depths of their light prefixes.

    Totals of marked prefixes have depth 0.
    """
    codes, of, prefix, length = plan.suffixes(ids, hashes)
    depth = np.ones(len(ids), np.int8)
    pos, cut, group, light = [], [], [], []

    def add(at: np.ndarray, upto: np.ndarray, d: int, kind: int) -> None:
        pos.append(at)
        cut.append(upto)
        group.append((prefix[d - 1][at] % np.uint64(plan.groups)).astype(np.int32))
        light.append(np.full(len(at), kind, np.int8))

    for d in range(1, DEPTH):
        if d not in plan.marks:
            break
        heavy = np.flatnonzero((depth == d) & (length >= d))
        heavy = heavy[plan.marked(d, prefix[d - 1][heavy])]
        depth[heavy] = d + 1
        if d > 1:  # single words are counted already
            add(heavy, np.full(len(heavy), d, np.int8), d, 0)
    for d in range(1, DEPTH + 1):
        sent = np.flatnonzero((depth == d) & (length >= max(d, 2)))
        add(sent, length[sent], d, d)
    at, upto = np.concatenate(pos), np.concatenate(cut)
    path = np.stack([np.where(upto > d, codes[at + d], 0).astype(_narrow(of)) for d in range(DEPTH)])
    return path, of, np.concatenate(group), np.concatenate(light)


def _squeezed(codes: np.ndarray) -> bytes:
    """Columns of small numbers byte by byte, compressed: frequent words keep their byte, so the rest is short."""
    wide = np.dtype("<u2" if codes.max(initial=0) < 65536 else "<u4")
    planes = codes.astype(wide).view(np.uint8).reshape(len(codes), -1, wide.itemsize).transpose(0, 2, 1)
    return bytes([wide.itemsize]) + zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unsqueezed(data: bytes, columns: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(columns, data[0], -1)
    return np.ascontiguousarray(raw.transpose(0, 2, 1)).view(f"<u{data[0]}").reshape(columns, -1).astype(np.int32)


def _routed(batches: Iterator[pa.RecordBatch], plan: Partition, most: int) -> Iterator[pa.RecordBatch]:
    """Packed suffixes by group, of as many blocks as have ``most`` words together, equal ones counted."""
    held: list[tuple[np.ndarray, ...]] = []
    words = 0

    def flush() -> pa.RecordBatch:
        of = np.unique(np.concatenate([h[1] for h in held]) & plan.bits)  # the gap's 0 comes first
        to, light = (np.concatenate([h[k] for h in held]) for k in (2, 3))
        path = np.empty((DEPTH, len(to)), _narrow(of))
        at = 0
        while held:
            own, hashes, *_ = held.pop(0)
            path[:, at : at + own.shape[1]] = np.searchsorted(of, hashes & plan.bits).astype(path.dtype)[own]
            at += own.shape[1]
        # by group first, then each group by itself: keys and copies of one group are held at a time
        order = np.argsort(to.astype(np.uint16) if plan.groups <= 1 << 16 else to, kind="stable")
        to, light = to[order], light[order]
        for column in path:  # row by row, so that no second copy is held
            column[:] = column[order]
        del order
        edge = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1], [True]))) if len(to) else []
        out = []
        for a, b in zip(edge, edge[1:]):
            order = _ordered(list(path[:, a:b]), [light[a:b]], len(of))
            own, depth = path[:, a:b][:, order], light[a:b][order]
            start = np.flatnonzero(_changes([depth, *own], len(order)))
            times = np.diff(np.append(start, len(order)))
            own, depth = own[:, start], depth[start]
            used, code = np.unique(own, return_inverse=True)
            code = code.reshape(DEPTH, -1)
            out.append((int(to[a]), pack(of[used].astype(np.int64)), _squeezed(np.concatenate((depth[None], code[1:]))), pack(code[0]), pack(times)))
        return pa.record_batch(
            [pa.array([x[0] for x in out], pa.int32()), *(pa.array([x[k] for x in out], pa.binary()) for k in (1, 2, 3, 4))],
            ["subtrees", "hashes", "codes", "heads", "counts"],
        )

    for ids, hashes in _rows(batches):
        held.append(_routes(ids, hashes, plan))
        words += len(ids)
        if words >= most:
            yield flush()
            words = 0
    if held:
        yield flush()


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    own, rows = None, []
    for row in chain.from_iterable(b.to_pylist() for b in batches):
        if rows and row["subtrees"] != own:
            yield rows
            rows = []
        own = row["subtrees"]
        rest = _unsqueezed(row["codes"], DEPTH)
        path = np.concatenate((unpack(row["heads"]).astype(np.int32)[None], rest[1:]))
        rows.append((unpack(row["hashes"]), path, unpack(row["counts"]), rest[0].astype(np.int8)))
    if rows:
        yield rows


def _nodes(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Per group: its suffixes in order, a flat subtree; the nodes (path, n) with at least ``least`` occurrences.

    Words are known by the kept bits of their hashes here.
    """
    for rows in _by_group(batches):
        known, code = np.unique(np.concatenate([np.zeros(1, np.int64), *(r[0] for r in rows)]), return_inverse=True)
        code = code.astype(np.int32)  # the gap's 0 is the smallest
        base = np.cumsum([1, *(len(r[0]) for r in rows)])
        path = np.concatenate([code[b:][r[1]] for b, r in zip(base, rows)], axis=1)
        times, light = (np.concatenate([r[k] for r in rows]) for k in (2, 3))
        rows.clear()
        order = _ordered(list(path), [light], len(known))
        for column in path:
            column[:] = column[order]
        times, light = times[order], light[order]
        del order
        for depth in np.unique(light).tolist():
            cut = slice(*np.searchsorted(light, [depth, depth + 1]))
            tree, leaves = path[:, cut], times[cut]
            for d in range(max(depth, 2), DEPTH + 1):
                # a depth of 0 marks totals of extended prefixes, which count for themselves only
                start = np.flatnonzero(_changes(list(tree if depth == 0 else tree[:d]), tree.shape[1]))
                total = np.add.reduceat(leaves, start)
                here = (tree[d - 1][start] > 0) & (total >= least)
                if depth == 0 and d < DEPTH:
                    here &= tree[d][start] == 0
                flat = known[tree[:d, start[here]].T.ravel()]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, d), pa.int32()), pa.array(flat, pa.int64()))
                yield pa.record_batch([lists, pa.array(total[here], pa.int64())], ["path", "n"])


def _power(n: float) -> int:
    return 1 << max(10, int(n - 1).bit_length())


def _bits(words: DataFrame, least: int) -> int:
    """A mask of the hashes under which no words that are frequent, alone or together, look alike; fewer bits are fewer bytes to send."""
    for width in (40, 48, 56, 63):
        mask = (1 << width) - 1
        short = words.groupBy(F.col("hash").bitwiseAND(F.lit(mask)).alias("short")).agg(F.count("*").alias("words"), F.sum("n").alias("n"))
        # zero stands for a gap
        if short.where((F.col("n") >= least) & ((F.col("words") > 1) | (F.col("short") == 0))).isEmpty():
            return mask
    raise RuntimeError("frequent words look alike under 63 bits of their hashes")


def _plan(blocks: DataFrame, words: DataFrame, least: int, budget: int) -> Partition:
    """Vertical partitioning: marks heavy prefixes, level by level, until none is left."""
    often = words.where(F.col("n") >= least)
    size = often.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    heavy = max(budget // 4, 1)
    bits = min(MOST_BITS, _power(64 * (size["n"] + 1)))
    slots = min(MOST_SLOTS, _power(64 * (size["total"] + 1) / heavy))
    table = np.zeros(bits // 64, np.int64)
    at = F.col("hash").bitwiseAND(F.lit(bits - 1))
    one = F.expr("shiftleft(1L, cast(hash & 63L as int))")
    # at most MOST_BITS / 64 rows
    got = often.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    table[got["at"].to_numpy()] = got["bits"].to_numpy()
    plan = Partition(table.view(np.uint8), slots, max(1, -(-2 * size["total"] // budget)), _bits(words, least))
    slot = F.col("hash").bitwiseAND(F.lit(slots - 1)).alias("slot")
    counts = often.groupBy(slot).agg(F.sum("n").alias("n"))
    for depth in range(1, DEPTH):
        full = [r["slot"] for r in counts.where(F.col("n") > heavy).select("slot").collect()]  # at most ``slots`` numbers
        if not full:
            break
        plan.mark(depth, full)
        if depth + 1 < DEPTH:
            rows = blocks.select("hashes", "ids").mapInArrow(lambda b, d=depth + 1: _slot_counts(b, plan, d), "slot long, n long")
            counts = rows.groupBy("slot").agg(F.sum("n").alias("n"))
    return plan


def counted(blocks: DataFrame, words: DataFrame, least: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """(path, n) for every phrase of up to ``DEPTH`` words with at least ``least`` occurrences, and its words (hash, lang, word, n).

    Paths are hashes of words, as many bits as tell the frequent ones apart.
    """
    plan = _plan(blocks, words, least, budget)
    deal = max(plan.groups, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = blocks.select("hashes", "ids").mapInArrow(lambda b: _routed(b, plan, ROUTE_WORDS), _PACKED)
    nodes = sent.repartition(deal, "subtrees").sortWithinPartitions("subtrees").mapInArrow(
        lambda b: _nodes(b, least), "path array<long>, n long"
    )
    short = F.col("hash").bitwiseAND(F.lit(int(plan.bits)))
    single = words.where(F.col("n") >= least).select(short.alias("hash"), "lang", "word", "n")
    single = materialize(single, "phrase-frequent")
    return materialize(nodes.unionByName(single.select(F.array("hash").alias("path"), "n")), "phrase-nodes"), single


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, budget: int = BUDGET,
                 block: int = BLOCK_WORDS) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` the language's words; the score is
    floor(1000 * a * n / (l * r)). Phrases inside a longer one with the same count are left out. Order: score and ``a``
    descending, then the phrase by its bytes.
    """
    blocks, words = encoded(docs, text, lang, block)
    counts, frequent = counted(blocks, words, least, budget)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = counts.where(F.size("path") > 1).withColumnRenamed("n", "a")
    longer = (
        phrases.where(F.size("path") > 2)
        .select(F.explode(F.array(F.expr("slice(path, 1, size(path) - 1)"), F.expr("slice(path, 2, size(path) - 1)"))).alias("path"), "a")
        .groupBy("path").agg(F.max("a").alias("most"))
    )
    own = phrases.join(longer, "path", "left").where("most is null or most < a").drop("most")
    tongue = frequent.select(F.col("hash").alias("head"), "lang")
    own = materialize(own.withColumn("head", F.col("path")[0]).join(tongue, "head").drop("head").join(totals, "lang"), "phrase-candidates")
    cuts = own.withColumn("k", F.explode(F.expr("sequence(1, size(path) - 1)")))
    parts = (
        cuts.join(counts.select(F.col("path").alias("left"), F.col("n").alias("l")), F.expr("slice(path, 1, k)") == F.col("left"))
        .join(counts.select(F.col("path").alias("right"), F.col("n").alias("r")), F.expr("slice(path, k + 1, size(path))") == F.col("right"))
    )
    number = lambda c: F.col(c).cast("decimal(19,0)")
    above = (number("a") * number("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    below = (number("l") * number("r")).cast("decimal(38,0)")
    scored = parts.withColumns({"above": above.cast("decimal(38,0)"), "below": below}).withColumn("score", F.expr("above div below"))
    best = scored.groupBy("path", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = materialize(best.select("path", "lang", "a", "n", "cut.score", "cut.l", "cut.r"), "phrase-scores")
    spelled = (
        best.select("path", F.posexplode("path").alias("place", "hash")).join(frequent.select("hash", "word"), "hash")
        .groupBy("path").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("parts"))
        .select("path", F.concat_ws(" ", F.col("parts.word")).alias("phrase"))
    )
    named = best.join(spelled, "path").withColumn("salt", F.pmod(F.hash("path"), F.lit(SALTS)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each slice of a language first, so that no task sees all phrases of one language
    some = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast(T.LongType()).alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Encoding and decoding with a word-splitting BPE vocabulary by a table of distinct words.

Texts are split at ASCII white space, which this vocabulary's normalizer and split pattern never reach across. A block
(a run of rows of one input partition) writes its texts as positions in its own list of distinct words; the words go to
buckets by their hash, where each distinct word is encoded once, with the tokenizer itself, and the ids go back to the
blocks, in the order in which the words came. There they are joined to the texts by position.

Decoding takes rows of ids, wherever they come from, and joins each id to the row of the vocabulary at its position, a
table of fixed size; the pieces found are put together as the tokenizer does.

Only words, ids and positions cross shuffles, in compressed runs. The two passes over the input number blocks by
partition, so ``docs`` should be read from files (projections and filters allowed). A null text is encoded as an empty
one: no ids. Null or repeated ids stay; each row is encoded. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from public_tokenizers import path
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sparkmart.llm.frames import col, with_column
from sparkmart.llm.packed import pack, unpack

VOCABULARY = "word_bpe_49k.json"
BLOCK_WORDS = 5_000_000


@lru_cache(maxsize=2)
def tokenizer(name: str) -> Tokenizer:
    loaded = Tokenizer.from_file(path(name))
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=2)
def vocabulary(name: str) -> pa.Array:
    """Piece of each id, null for an id without one; empty pieces are kept."""
    loaded = tokenizer(name)
    return pa.array([loaded.id_to_token(i) for i in range(max(loaded.get_vocab().values()) + 1)], pa.string())


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _loosen(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, dict[bytes, int], list[pa.Array], list[np.ndarray]]]:
    """(number, distinct words with their positions, ids, positions per text) of runs of rows, at least ``most`` words each.

    The number comes from the partition of the scan, so that both passes give a block the same one.
    """
    number = None
    place: dict[bytes, int] = {}
    ids, found, words = [], [], 0
    for batch in batches:
        if number is None and batch.num_rows:
            number = batch.column(2)[0].as_py() << 32
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            ids.append(part.column(0))
            for text in pc.fill_null(part.column(1), "").cast(pa.large_binary()).to_pylist():
                split = text.split()
                add = place.setdefault
                found.append(np.fromiter((add(w, len(place)) for w in split), np.int32, len(split)))
                words += len(split)
            if words >= most:
                yield number, place, ids, found
                number, place, ids, found, words = number + 1, {}, [], [], 0
    if ids:
        yield number, place, ids, found


_WORDS = "block long, bucket int, words binary, places binary"
_IDS = "block long, places binary, counts binary, ids binary, rows binary, lengths binary, positions binary"
_IDS_SCHEMA = pa.schema([("block", pa.int64())] + [(k, pa.binary()) for k in ("places", "counts", "ids", "rows", "lengths", "positions")])


def _words(batches: Iterator[pa.RecordBatch], buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    for number, place, _, _ in _blocks(batches, most):
        dealt: list[list[bytes]] = [[] for _ in range(buckets)]
        for w in place:
            dealt[crc32(w) % buckets].append(w)
        for bucket, own in enumerate(dealt):
            if own:
                own.sort()
                yield pa.record_batch(
                    [pa.array([number], pa.int64()), pa.array([bucket], pa.int32()), pa.array([_squeeze(b"\n".join(own))], pa.binary()),
                     pa.array([pack(np.fromiter((place[w] for w in own), np.int64, len(own)))], pa.binary())],
                    ["block", "bucket", "words", "places"],
                )


def _texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    step = 1000
    for number, _, ids, found in _blocks(batches, most):
        rows = pa.chunked_array(ids).combine_chunks()
        for low in range(0, len(found), step):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("id", rows.type)])) as writer:
                writer.write_batch(pa.record_batch([rows.slice(low, step)], ["id"]))
            some = found[low : low + step]
            flat = np.concatenate(some).astype("<u4")
            planes = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T)
            row = {"block": number, "rows": sink.getvalue().to_pybytes(), "lengths": pack(np.array([len(x) for x in some])), "positions": _squeeze(planes.tobytes())}
            yield pa.RecordBatch.from_pylist([{k: row.get(k) for k in _IDS_SCHEMA.names}], _IDS_SCHEMA)


def _encoded(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Ids of the words of each run; a word that several blocks of the bucket have is encoded once."""
    encode = tokenizer(name).encode_batch_fast
    known: dict[bytes, np.ndarray] = {}
    bucket = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                known, bucket = {}, row["bucket"]
            words = _loosen(row["words"]).split(b"\n")
            new = [w for w in words if w not in known]
            for low in range(0, len(new), 2000):
                some = new[low : low + 2000]
                for w, e in zip(some, encode([w.decode() for w in some], add_special_tokens=False)):
                    known[w] = np.array(e.ids, np.uint16)
            ids = [known[w] for w in words]
            out = {
                "block": row["block"], "places": row["places"], "counts": pack(np.array([len(x) for x in ids])),
                "ids": _squeeze(np.concatenate(ids).astype("<u2").tobytes()),
            }
            yield pa.RecordBatch.from_pylist([{k: out.get(k) for k in _IDS_SCHEMA.names}], _IDS_SCHEMA)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, one after another, their words before their texts: ids of each row."""
    block, runs, flat, start, count = None, [], None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != block:
                block, runs, flat = row["block"], [], None
            if row["rows"] is None:
                runs.append(row)
                continue
            if flat is None:
                place = np.concatenate([np.zeros(0, np.int64), *(unpack(r["places"]) for r in runs)])
                many = np.concatenate([np.zeros(0, np.int64), *(unpack(r["counts"]) for r in runs)])
                flat = np.concatenate([np.zeros(0, "<u2"), *(np.frombuffer(_loosen(r["ids"]), "<u2") for r in runs)]).astype(np.int32)
                runs = []
                begin = np.cumsum(many) - many
                start, count = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                start[place], count[place] = begin, many
            ids = pa.ipc.open_stream(row["rows"]).read_all().column("id").combine_chunks()
            raw = np.frombuffer(_loosen(row["positions"]), np.uint8)
            at = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()
            edge = np.concatenate(([0], np.cumsum(unpack(row["lengths"]))))
            low = 0
            while low < len(ids):  # rows of about a million words at a time
                high = max(low + 1, int(np.searchsorted(edge, edge[low] + 1_000_000)))
                high = min(high, len(ids))
                own = at[edge[low] : edge[high]]
                n = count[own]
                total = np.concatenate(([0], np.cumsum(n)))
                gathered = flat[np.repeat(start[own] - total[:-1], n) + np.arange(total[-1])]
                offsets = total[edge[low : high + 1] - edge[low]]
                yield pa.record_batch(
                    [ids.slice(low, high - low), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(gathered, pa.int32()))], ["id", "ids"]
                )
                low = high


def _blocks_to_join(docs: DataFrame, id_column: str, text: str, name: str, block: int) -> tuple[DataFrame, list[T.StructField]]:
    given = docs.select(col(id_column).alias("id"), col(text).alias("text"), F.spark_partition_id().alias("part"))
    deal = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = given.mapInArrow(lambda b: _words(b, deal, block), _WORDS)
    ids = words.repartition(deal, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: _encoded(b, name), _IDS)
    texts = given.mapInArrow(lambda b: _texts(b, block), _IDS)
    both = ids.unionByName(texts).repartition(deal, "block").sortWithinPartitions("block", F.col("rows").isNotNull())
    return both, [T.StructField("id", given.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]


def encoded(docs: DataFrame, id_column: str = "doc_id", text: str = "text", name: str = VOCABULARY, block: int = BLOCK_WORDS) -> DataFrame:
    """(id, ids) per row of ``docs``: the token ids of its whole text."""
    both, fields = _blocks_to_join(docs, id_column, text, name, block)
    return both.mapInArrow(_joined, T.StructType(fields))


def round_trip(docs: DataFrame, id_column: str = "doc_id", text: str = "text", name: str = VOCABULARY, block: int = BLOCK_WORDS) -> DataFrame:
    """(id, ids, decoded) per row of ``docs``: what ``encoded`` gives, and what ``decoded`` makes of it, in one task."""
    both, fields = _blocks_to_join(docs, id_column, text, name, block)
    return both.mapInArrow(lambda b: _pieces(_joined(b), 1, name), T.StructType([*fields, T.StructField("decoded", T.StringType())]))


def _pieces(batches: Iterator[pa.RecordBatch], at: int, name: str) -> Iterator[pa.RecordBatch]:
    pieces = vocabulary(name)
    for batch in batches:
        lists = batch.column(at).cast(pa.list_(pa.int64()))
        filled = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        low = 0
        while low < batch.num_rows:  # rows of about a million ids at a time
            begin = filled[low - 1] if low else 0
            high = min(batch.num_rows, max(low + 1, int(np.searchsorted(filled, begin + 1_000_000))))
            some = lists.slice(low, high - low)
            owner, flat = pc.list_parent_indices(some).to_numpy(), some.flatten()
            known = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(pieces))), False)
            found = pieces.take(flat.filter(known))  # the join: an id is the position of its piece
            have = found.is_valid()
            many = np.bincount(owner[known.to_numpy(zero_copy_only=False)][have.to_numpy(zero_copy_only=False)], minlength=len(some))
            edge = pa.array(np.concatenate(([0], np.cumsum(many))), pa.int64())
            text = pc.binary_join(pa.LargeListArray.from_arrays(edge, found.drop_null().cast(pa.large_string())), pa.scalar(" ", pa.large_string()))
            text = pc.if_else(some.is_valid(), text, None).cast(pa.string())
            yield with_column(batch.slice(low, high - low), "decoded", text)
            low = high


def decoded(rows: DataFrame, ids: str = "ids", name: str = VOCABULARY) -> DataFrame:
    """``rows`` and the text that the column ``ids``, arrays of ids, decodes to (``decoded``).

    Null ids and ids that the vocabulary lacks are passed over, as the tokenizer does; a null array gives a null text, an
    empty one an empty text. A column ``decoded`` of the rows is replaced. Nothing is shuffled.
    """
    kept = rows.drop("decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())])
    at = kept.columns.index(ids)
    return kept.mapInArrow(lambda b: _pieces(b, at, name), schema)

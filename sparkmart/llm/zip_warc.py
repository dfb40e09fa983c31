"""WARC records in ZIP packages: written, located through the ZIP directory and an index member, read by byte range.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, whose records are gzip members of
their own, and ``indexes/index.cdxj`` with one line per record (key, time, JSON with offset and length). The reader takes
the end-of-directory record from the file's tail, ZIP64 fields included, walks the central directory, finds where stored
members' data begin, reads the index and turns its entries into byte ranges. Ranges are dealt out over tasks, which read
neighbouring ones together; nothing is extracted and no package is read as a whole.

Files are reached through pyarrow's file systems by their URI (``file:``, ``hdfs:``, ``s3:``, ``gs:``), so the folder
must be shared by all executors. A task writes under a name of its own attempt, and only names that finished tasks have
returned count, so a lost executor's leftovers are never read.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.frames import col, shared_uri
from sparkmart.runtime import materialize, scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 256 << 20
SMALLEST_REVISIT = 100
RANGE_BYTES, GAP = 1 << 20, 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page: str | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(record_id: str | None) -> str | None:
    return record_id[10:-1] or None if record_id else None


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool, date: str) -> bytes:
    """One WARC 1.1 record: a response with its payload, or a revisit with the headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(f"%{ord(c):02X}" if c < " " else c for c in url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Fields of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *names = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    field = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in names)}
    block = rest[: int(field["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next((int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    return {
        "page": _page(field.get("warc-record-id")), "type": field["warc-type"], "url": field.get("warc-target-uri"),
        "payload": payload if field["warc-type"] == "response" else None, "payload_bytes": length,
        "declared": field.get("warc-payload-digest", "").removeprefix("sha256:") or None, "refers_to": _page(field.get("warc-refers-to")),
    }


def marked(pages: DataFrame, id_column: str, url: str, payload: str) -> DataFrame:
    """(page, url, payload, digest, refers_to, revisit) per row of ``pages``.

    Of rows with equal payloads of at least ``SMALLEST_REVISIT`` bytes that with the smallest id is the response, the
    others revisit it. Rows that share the smallest id are responses all; a null id is larger than any other. A null
    payload is empty, a null URL an empty one. Digests are grouped without the payloads.
    """
    body = F.coalesce(col(payload), F.lit(""))
    rows = pages.select(col(id_column).alias("page"), col(url).alias("url"), body.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    narrow = rows.where(F.octet_length("payload") >= SMALLEST_REVISIT).select("page", "digest")
    first = narrow.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    again = narrow.join(first, "digest").where(~F.col("page").eqNullSafe(F.col("first"))).distinct()
    again = again.select(F.struct("page", "digest", "first").alias("again"))
    return rows.join(again, rows.page.eqNullSafe(F.col("again.page")) & (rows.digest == F.col("again.digest")), "left").select(
        F.col("page").cast("string").alias("page"), "url", F.col("payload").cast("binary").alias("payload"), "digest",
        F.col("again.first").cast("string").alias("refers_to"), F.col("again").isNotNull().alias("revisit"),
    )


class _Package:
    """One open package; records go straight to the data member."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, name = pafs.FileSystem.from_uri(self.uri)
        self.sink = system.open_output_stream(name)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, row: dict, date: str) -> None:
        packer = zlib.compressobj(2, zlib.DEFLATED, 31)
        raw = packer.compress(record(row["page"], row["url"], row["payload"], row["digest"], row["refers_to"], row["revisit"], date)) + packer.flush()
        self.data.write(raw)
        entry = {"offset": self.at, "length": len(raw), "filename": DATA.rpartition("/")[2]}
        self.index.append(f"{_record_id(row['page'])} {date} {json.dumps(entry)}\n")
        self.at += len(raw)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(INDEX, "w") as member:
            for line in self.index:
                member.write(line.encode())
        self.zip.close()
        self.sink.close()
        return self.uri, len(self.index), self.at


def write_packages(rows: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", most: int = PACKAGE_BYTES) -> DataFrame:
    """Write ``marked`` rows below ``folder``; (uri, records, bytes) of each finished package, written as a table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                for row in batch.slice(low, 100).to_pylist():
                    package = package or _Package(folder)
                    package.add(row, date)
                    if package.at >= most:
                        done.append(package.close())
                        package = None
        if package:
            done.append(package.close())
        if done:
            uri, records, size = zip(*done)
            yield pa.record_batch([pa.array(uri), pa.array(records, pa.int64()), pa.array(size, pa.int64())], ["uri", "records", "bytes"])

    hadoop = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return materialize(rows.mapInArrow(write, "uri string, records long, bytes long"), "warc-packages")


def _tail(file: pa.NativeFile, size: int) -> tuple[int, int, int]:
    """(place, length, entries) of the central directory, from the end record or its ZIP64 form."""
    low = max(0, size - 65_557 - 20)
    file.seek(low)
    end = file.read(size - low)
    at = end.rfind(b"PK\x05\x06")
    while at >= 0 and (at + 22 > len(end) or at + 22 + struct.unpack_from("<H", end, at + 20)[0] != len(end)):
        at = end.rfind(b"PK\x05\x06", 0, at + 3)  # the mark can occur in the comment
    if at < 0:
        raise ValueError("no end of central directory")
    entries, length, place = struct.unpack_from("<HII", end, at + 10)
    if at >= 20 and end[at - 20 : at - 16] == b"PK\x06\x07":
        file.seek(struct.unpack_from("<Q", end, at - 12)[0])
        wide = file.read(56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory where its locator points")
        entries, length, place = struct.unpack_from("<QQQ", wide, 32)
    return place, length, entries


def members(file: pa.NativeFile) -> Iterator[dict]:
    """(name, method, stored bytes, size, local header) of each entry of the central directory."""
    place, length, entries = _tail(file, file.size())
    file.seek(place)
    directory = file.read(length)
    at = 0
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, size, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack_from("<HH", extra)
            if tag == 1:  # ZIP64: those fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                size = next(wide) if size == 0xFFFFFFFF else size
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        yield {"name": name, "method": method, "packed": packed, "size": size, "header": header}
        at += 46 + n_name + n_extra + n_note


def data_start(file: pa.NativeFile, member: dict) -> int:
    """Where a stored member's bytes begin: behind its local header, whose extra field can differ from the directory's."""
    if member["method"] != zipfile.ZIP_STORED:
        raise ValueError(f"{member['name']} is not stored")
    file.seek(member["header"])
    local = file.read(30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("no local header where the directory points")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return member["header"] + 30 + n_name + n_extra


def _index_lines(file: pa.NativeFile, low: int, size: int) -> Iterator[bytes]:
    rest, done = b"", 0
    while done < size:
        file.seek(low + done)
        part = file.read(min(1 << 20, size - done))
        done += len(part)
        *lines, rest = (rest + part).split(b"\n")
        yield from lines
    if rest:
        yield rest


def _scanned(file: pa.NativeFile, low: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of a data member without an index, read once in order."""
    at, done, part = 0, 0, b""
    gz, begin = zlib.decompressobj(31), 0
    while done < size or part:
        if not part:
            file.seek(low + done)
            part = file.read(min(1 << 20, size - done))
            done += len(part)
        gz.decompress(part)
        at = done - len(gz.unused_data)
        part = gz.unused_data
        if gz.eof:
            yield begin, at - begin
            gz, begin = zlib.decompressobj(31), at


def ranges(packages: DataFrame) -> DataFrame:
    """(uri, offset, length) of every record of the packages, offsets counted from the start of the package.

    Members below ``archive/`` that an index names are taken from it, others are scanned for their records.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, name = pafs.FileSystem.from_uri(uri)
                with system.open_input_file(name) as file:
                    found = {m["name"]: m for m in members(file)}
                    start = {k: data_start(file, m) for k, m in found.items() if k.startswith("archive/")}
                    unseen, out = set(start), []

                    def full(out):
                        return pa.record_batch([pa.array([uri] * len(out)), *(pa.array(c, pa.int64()) for c in zip(*out))], ["uri", "offset", "length"])

                    for k in (k for k in found if k.startswith("indexes/") and k.endswith(".cdxj")):
                        for line in _index_lines(file, data_start(file, found[k]), found[k]["size"]):
                            entry = json.loads(line[line.index(b"{") :])
                            of = f"archive/{entry['filename']}"
                            unseen.discard(of)
                            out.append((start[of] + int(entry["offset"]), int(entry["length"])))
                            if len(out) == 10_000:
                                yield full(out)
                                out = []
                    for k in sorted(unseen):
                        out += [(start[k] + low, n) for low, n in _scanned(file, start[k], found[k]["size"])]
                    if out:
                        yield full(out)

    deal = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packages.select("uri").repartition(deal, "uri").mapInArrow(locate, "uri string, offset long, length long")


def read_records(packages: DataFrame) -> DataFrame:
    """(page, type, url, payload, payload_bytes, declared, refers_to) of every record of the packages (column ``uri``)."""
    schema = pa.schema(
        [("page", pa.string()), ("type", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("declared", pa.string()), ("refers_to", pa.string())]
    )

    def runs(batches):
        """(uri, neighbouring ranges) of at most about ``RANGE_BYTES`` together."""
        uri, own = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if own and (r["uri"] != uri or r["offset"] > own[-1][0] + own[-1][1] + GAP or r["offset"] + r["length"] - own[0][0] > RANGE_BYTES):
                    yield uri, own
                    own = []
                uri = r["uri"]
                own.append((r["offset"], r["length"]))
        if own:
            yield uri, own

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for uri, own in runs(batches):
            if uri != opened:
                if file:
                    file.close()
                system, name = pafs.FileSystem.from_uri(uri)
                opened, file = uri, system.open_input_file(name)
            file.seek(own[0][0])
            raw = file.read(own[-1][0] + own[-1][1] - own[0][0])
            rows = [parsed(gzip.decompress(raw[low - own[0][0] : low - own[0][0] + n])) for low, n in own]
            yield pa.RecordBatch.from_pylist(rows, schema)
        if file:
            file.close()

    deal = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    where = ranges(packages).withColumn("run", F.floor(F.col("offset") / RANGE_BYTES))
    dealt = where.repartition(deal, "uri", "run").sortWithinPartitions("uri", "offset").select("uri", "offset", "length")
    return dealt.mapInArrow(read, "page string, type string, url string, payload binary, payload_bytes long, declared string, refers_to string")


def round_trip(pages: DataFrame, id_column: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` into packages in a new folder of the shared scratch area and read their records."""
    folder = shared_uri(pages.sparkSession, scratch_path(pages.sparkSession, "warc"))
    return read_records(write_packages(marked(pages, id_column, url, payload), folder))

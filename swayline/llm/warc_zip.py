"""WARC records in ZIP packages: writing packages with stored members, and reading records by range.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj`` (place and length of every record),
both stored, with ZIP64 directories. Packages are written by Spark's own text sink, so any store and the commit of retried tasks
work as for other tables: a package is cut into chunks at line feeds, each chunk is a row, and the sink puts the line feeds back;
the last one is the package's ZIP comment.

Reading never unpacks a member. From a package's end come the directory, its ZIP64 form if need be, then the stored members and the
index; record ranges are dealt over tasks in blocks of about ``block_bytes`` and fetched by range. Members without an index are
read front to back, range by range. Compressed (not stored) members and files that are no package raise ValueError.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
CHUNK = 1 << 20
FULL = 0xFFFFFFFF
RANGE = 1 << 20   # fetched at a time from members without known places
TOLD = 1 << 20    # unpacked bytes of records told at a time
RECORD = ("record_id string, uri string, record_type string, refers_to string, payload_bytes long, payload_digest string, "
          "payload binary")


# writing

def _record(record_id: str, uri: str, kind: str, refers_to: str | None, size: int, digest: str, payload: bytes) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Target-URI: {uri}",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode("utf-8", "surrogatepass")
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Package:
    """The bytes of one package, in order, from records as they come; it remembers index lines only."""

    def __init__(self) -> None:
        self.at, self.entries = 0, []

    def out(self, data: bytes) -> bytes:
        self.at += len(data)
        return data

    def open(self, name: str) -> bytes:
        self.name, self.header, self.crc, self.size = name.encode(), self.at, 0, 0
        # Flag 8: size and checksum follow the data.
        return self.out(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 8, 0, 0, 33, 0, FULL, FULL, len(self.name), 20)
                        + self.name + struct.pack("<HHQQ", 1, 16, 0, 0))

    def data(self, data: bytes) -> bytes:
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        return self.out(data)

    def close(self) -> bytes:
        self.entries.append((self.name, self.crc, self.size, self.header))
        return self.out(struct.pack("<IIQQ", 0x08074B50, self.crc, self.size, self.size))

    def directory(self) -> bytes:
        start = self.at
        entries = b"".join(
            struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 8, 0, 0, 33, crc, FULL, FULL, len(name), 28, 0, 0, 0, 0, FULL)
            + name + struct.pack("<HHQQQ", 1, 24, size, size, header) for name, crc, size, header in self.entries)
        n = len(self.entries)
        end64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(entries), start)
        locator = struct.pack("<IIQI", 0x07064B50, 0, start + len(entries), 1)
        return entries + end64 + locator + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, FULL, FULL, 1) + b"\n"


def _stream(batches: Iterator[pa.RecordBatch], package: _Package) -> Iterator[bytes]:
    index, opened = [], False
    for batch in batches:
        for row in zip(*batch.columns):  # one record's payload is a Python object at a time
            row = [value.as_py() for value in row]
            if not opened:
                opened = True
                yield package.open(DATA)
            raw = _record(*row)
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress(raw) + packer.flush()
            index.append(json.dumps({"url": row[1], "offset": package.size, "length": len(data), "digest": "sha1:" + row[5]}))
            yield package.data(data)
    if opened:
        yield package.close()
        yield package.open(INDEX)
        for line in index:
            yield package.data(line.encode() + b"\n")
        yield package.close()
        yield package.directory()


def _chunks(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Chunks that, each followed by a line feed, make up the stream, which ends in one."""
    held: list[bytes] = []
    size = 0
    for data in stream:
        held.append(data)
        size += len(data)
        if size >= CHUNK:
            whole = b"".join(held)
            cut = whole.rfind(b"\n")
            if cut >= 0:
                yield whole[:cut]
                whole = whole[cut + 1:]
            held, size = [whole], len(whole)
    whole = b"".join(held)
    if whole:
        yield whole[:-1]


def write_packages(records: DataFrame, folder: str) -> None:
    """One package per partition of ``records`` (the columns of ``RECORD``; payloads are the full ones also for revisits, or empty)."""
    names = [x.split()[0] for x in RECORD.split(", ")]

    def package(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(_stream(batches, _Package())):
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.binary())], ["chunk"])

    chunks = records.select(*names).mapInArrow(package, "chunk binary")
    chunks.select(F.col("chunk").cast("string").alias("value")).write.option("lineSep", "\n").text(folder)


def with_revisits(records: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``records`` (``key``, ``uri``, ``payload``) as rows to write: of equal payloads of at least ``least_bytes`` bytes, the record with
    the largest key is the response and the others revisit it. Null payloads are empty; a null key is smaller than any other;
    rows that share the largest key, or have no key at all, are all responses."""
    named = records.select(
        "key", F.coalesce("uri", F.lit("")).alias("uri"), F.coalesce("payload", F.lit(b"")).alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    # What revisits what is found out without payloads; these then meet a row for each revisit, spread by key.
    large = named.filter(F.col("payload_bytes") >= least_bytes).select("key", F.col("payload_digest").alias("digest"))
    first = large.groupBy(F.col("digest").alias("of")).agg(F.max("key").alias("kept"), F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("kept").isNotNull())
    again = (large.join(first, F.col("digest") == F.col("of")).filter(~F.col("key").eqNullSafe(F.col("kept")))
             .select(F.col("key").alias("mine"), "digest", "kept").distinct())
    urn = lambda c: F.concat(F.lit("urn:record:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    joined = named.join(again.hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("mine")) & (F.col("payload_digest") == F.col("digest")), "left")
    revisit = F.col("kept").isNotNull()
    return joined.select(
        urn("key").alias("record_id"), "uri", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, urn("kept")).alias("refers_to"), "payload_bytes", "payload_digest",
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))


# reading

def _open(path: str):
    uri = re.sub(r"^file:/+", "file:///", path)
    store, name = fs.FileSystem.from_uri(uri)
    return store.open_input_file(name)


def _at(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


def directory(file, size: int) -> list[tuple[str, int, int, int]]:
    """Name, method, place of the local header and stored size of each member, from the central directory or its ZIP64 form."""
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = _at(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or FULL in (length, start):
        if end < 20 or tail[end - 20:end - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        place = struct.unpack_from("<Q", tail, end - 12)[0]
        signature, _, _, _, _, _, _, count, length, start = struct.unpack("<IQHHIIQQQQ", _at(file, place, 56))
        if signature != 0x06064B50:
            raise ValueError("no ZIP64 end of directory")
    raw, at, members = _at(file, start, length), 0, []
    for _ in range(count):
        (signature, _, _, _, method, _, _, _, packed, plain, name_size, extra_size, comment_size, _, _, _,
         header) = struct.unpack_from("<IHHHHHHIIIHHHHHII", raw, at)
        if signature != 0x02014B50:
            raise ValueError("broken ZIP directory")
        name = raw[at + 46:at + 46 + name_size].decode("utf-8", "replace")
        extra = raw[at + 46 + name_size:at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            kind, size_of = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the fields that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{size_of // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL else plain
                packed = next(wide) if packed == FULL else packed
                header = next(wide) if header == FULL else header
            extra = extra[4 + size_of:]
        members.append((name, method, header, packed))
        at += 46 + name_size + extra_size + comment_size
    return members


def _member_start(file, header: int) -> int:
    local = _at(file, header, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("no local header where the directory says")
    name_size, extra_size = struct.unpack_from("<HH", local, 26)
    return header + 30 + name_size + extra_size


def _lines(file, start: int, size: int) -> Iterator[str]:
    """The lines of a stored member, read range by range."""
    rest = b""
    for at in range(0, size, RANGE):
        *lines, rest = (rest + _at(file, start + at, min(RANGE, size - at))).split(b"\n")
        yield from (x.decode() for x in lines if x.strip())
    if rest.strip():
        yield rest.decode()


def locate(file, size: int, block_bytes: int) -> Iterator[tuple[int, list[int] | None, list[int] | None, int]]:
    """Blocks of records: start of the archive member, places and lengths in it (null: not indexed), bytes."""
    members = directory(file, size)
    archives = {m[0]: m for m in members if m[0].startswith("archive/") and m[0].endswith((".warc", ".warc.gz"))}
    if any(m[1] for m in archives.values()):
        raise ValueError("an archive member is compressed; only stored members can be read by range")
    starts = {name: _member_start(file, m[2]) for name, m in archives.items()}
    open_blocks: dict[str, tuple[list[int], list[int]]] = {}
    indexed = set()
    for name, method, header, stored in members:
        if name.startswith("indexes/") and method == 0:
            for line in _lines(file, _member_start(file, header), stored):
                entry = json.loads(line[line.index("{"):])
                owner = "archive/" + (entry.get("filename") or next(iter(archives)).removeprefix("archive/"))
                if owner not in archives:
                    continue
                indexed.add(owner)
                offsets, lengths = open_blocks.setdefault(owner, ([], []))
                if lengths and sum(lengths) + int(entry["length"]) > block_bytes:
                    yield starts[owner], offsets, lengths, sum(lengths)
                    offsets, lengths = open_blocks[owner] = [], []
                offsets.append(int(entry["offset"]))
                lengths.append(int(entry["length"]))
    for owner, (offsets, lengths) in open_blocks.items():
        if offsets:
            yield starts[owner], offsets, lengths, sum(lengths)
    for name in archives:
        if name not in indexed:
            yield starts[name], None, None, archives[name][3]


class _Ranges:
    """A stretch of a file, fetched range by range; only what was not taken yet is held."""

    def __init__(self, file, start: int, size: int):
        self.file, self.at, self.end, self.held = file, start, start + size, b""

    def more(self) -> bool:
        if self.at >= self.end:
            return False
        size = min(RANGE, self.end - self.at)
        self.held += _at(self.file, self.at, size)
        self.at += size
        return True


def _plain(data: _Ranges | bytes) -> Iterator[bytes]:
    """Records of a gzip or plain sequence, front to back; one record is held at a time."""
    if isinstance(data, bytes):
        data = _Ranges(io.BytesIO(data), 0, len(data))
    data.more()
    if data.held[:2] == b"\x1f\x8b":
        while data.held or data.more():
            unpacker, parts = zlib.decompressobj(31), []
            while True:
                parts.append(unpacker.decompress(data.held))
                data.held = unpacker.unused_data
                if unpacker.eof or not data.more():
                    break
            yield b"".join(parts)
            del parts
    else:
        while data.held or data.more():
            while b"\r\n\r\n" not in data.held and data.more():
                pass
            head = data.held.index(b"\r\n\r\n") + 4
            size = head + int(_headers(data.held[:head])["content-length"])
            while len(data.held) < size and data.more():
                pass
            yield data.held[:size]
            data.held = data.held[size:]
            while True:
                data.held = data.held.lstrip(b"\r\n")
                if data.held or not data.more():
                    break


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def parse_record(raw: bytes) -> tuple | None:
    """The columns of ``RECORD``; of a revisit, size and digest of the full payload are those it states. None: another type."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    if kind == "response":
        size, digest = len(payload), sha1(payload).hexdigest()
    else:
        size, digest = int(_headers(http).get("content-length", 0)), fields["warc-payload-digest"].removeprefix("sha1:")
    refers = fields.get("warc-refers-to")
    return (fields["warc-record-id"].strip("<>"), fields.get("warc-target-uri"), kind, refers and refers.strip("<>"), size, digest, payload)


def read_packages(spark: SparkSession, folder: str, block_bytes: int = 1 << 20, with_payload: bool = True) -> DataFrame:
    """The response and revisit records (``RECORD``) of all packages in ``folder``, a place that pyarrow's file systems can open. Without
    ``with_payload`` that column is null; size and digest are still those of the whole payload."""
    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("path", "length")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _open(path) as file:
                    for block in locate(file, length, block_bytes):
                        yield pa.RecordBatch.from_pylist([dict(zip(("path", "start", "offsets", "lengths", "bytes"), (path, *block)))], blocks)

    blocks = pa.schema([("path", pa.string()), ("start", pa.int64()), ("offsets", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int64())), ("bytes", pa.int64())])
    places = (files.mapInArrow(plan, "path string, start long, offsets array<long>, lengths array<long>, bytes long")
              .repartition(spark.sparkContext.defaultParallelism * 4))
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int64() if " long" in x else pa.binary() if " binary" in x else pa.string() for x in RECORD.split(", ")]

    def raws(place: dict) -> Iterator[bytes]:
        with _open(place["path"]) as file:
            if place["offsets"] is None:
                yield from _plain(_Ranges(file, place["start"], place["bytes"]))
            else:
                for offset, length in zip(place["offsets"], place["lengths"]):
                    yield next(_plain(_Ranges(file, place["start"] + offset, length)))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)
        for batch in batches:
            for row in range(batch.num_rows):
                found, size = [], 0
                for raw in raws(batch.slice(row, 1).to_pylist()[0]):
                    record = parse_record(raw)
                    if record:
                        found.append(record if with_payload else (*record[:-1], None))
                        size += len(raw) if with_payload else 200
                    if size >= TOLD:
                        yield told()
                        found, size = [], 0
                if found:
                    yield told()

    return places.mapInArrow(records, RECORD)

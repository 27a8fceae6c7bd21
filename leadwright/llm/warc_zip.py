"""WARC records in ZIP archives: writing, and reading by range without extraction.

An archive holds ``archive/data.warc.gz``, one gzip member per record, stored without further compression, and
``indexes/index.cdxj``, a line per record with its place. Sizes and places stand in ZIP64 records, which the reader
follows wherever the classic fields are saturated, in the directory end, the directory and the local headers.

Reading has two steps. ``record_ranges`` opens each archive at its end, parses the directory (also of archives by other
tools), finds the stored WARC members and their indexes and returns runs of consecutive records of about
``range_bytes``; a member without an index is one run. ``read_records`` reads the runs, spread over the tasks, and
parses their records one after the other; nothing is unpacked to disk and a task holds one run.

Files are opened through Arrow's file systems by the URI of the folder, so local, HDFS and object store folders
work alike. Tasks name archives uniquely and the names of finished tasks are written as a table; what a lost attempt
has left is never read.

Defined cases: a null html is an empty payload; null urls become an empty target; of equal payloads of at least
``min_bytes`` bytes those with the largest page_id are responses and the others revisits of it; a null page_id ranks
lowest; empty tables give no archive and no record; further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools
from leadwright.session import shared_dir

MIN_BYTES, ARCHIVE_BYTES, RANGE_BYTES = 1000, 32 << 20, 2 << 20
_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_RECORD = ("uri string, page_id long, record_type string, refers_to long, payload_digest string, payload binary")


def _open(folder: str):
    """File system and path of a folder named by URI or plainly."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


# --- records -----------------------------------------------------------------------------------------------------

def _id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page(record_id: str | None) -> int | None:
    tail = (record_id or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which carries the HTTP head and the digest but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _id(page_id)),
              ("WARC-Target-URI", uri), ("WARC-Date", "2024-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if refers_to is not None:
        fields += [("WARC-Refers-To", _id(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[dict]:
    """The records in a run of gzip members, or of plain records."""
    pending = data
    if data[:2] == b"\x1f\x8b":
        plain = []
        while pending[:2] == b"\x1f\x8b":
            inflate = zlib.decompressobj(31)
            plain.append(inflate.decompress(pending))
            if not inflate.eof:
                raise ValueError("a record is cut off")
            pending = inflate.unused_data
        runs = plain
    else:
        runs = [data]
    for run in runs:
        at = 0
        while at < len(run):
            head_end = run.index(b"\r\n\r\n", at)
            lines = run[at:head_end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = int(fields["content-length"])
            block = run[head_end + 4:head_end + 4 + size]
            if len(block) != size:
                raise ValueError("a record is cut off")
            payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
            yield {"fields": fields, "payload": payload}
            at = head_end + 4 + size + 4


# --- archives ----------------------------------------------------------------------------------------------------

def zip64_bytes(members: list[tuple[str, bytes]]) -> bytes:
    """An archive of stored members, with sizes and places in ZIP64 records throughout."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        at, crc, n = len(out), zlib.crc32(data), name.encode()
        out += struct.pack("<4s5H3L2H", b"PK\3\4", 45, 0, 0, 0, 0x5821, crc, _FULL32, _FULL32, len(n), 20) + n
        out += struct.pack("<2H2Q", 1, 16, len(data), len(data)) + data
        directory += struct.pack("<4s6H3L5H2L", b"PK\1\2", 45, 45, 0, 0, 0, 0x5821, crc, _FULL32, _FULL32, len(n), 28, 0, 0, 0, 0, _FULL32)
        directory += n + struct.pack("<2H3Q", 1, 24, len(data), len(data), at)
    start, end = len(out), len(out) + len(directory)
    tail = struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, len(members), len(members), len(directory), start)
    tail += struct.pack("<4sLQL", b"PK\6\7", 0, end, 1)
    tail += struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, _FULL16, _FULL16, _FULL32, _FULL32, 0)
    return bytes(out + directory) + tail


def _range(file, at: int, size: int) -> bytes:
    file.seek(at)
    data = file.read(size)
    if len(data) != size:
        raise ValueError("the archive is cut off")
    return data


def zip_members(file, size: int) -> dict[str, dict]:
    """name -> method, start of the data, stored size and full size, read from the directory of an open archive."""
    tail_at = max(0, size - 65_557)
    tail = _range(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\5\6")
    if end < 0:
        raise ValueError("no directory end: not a ZIP archive")
    count, length, start = struct.unpack_from("<H2L", tail, end + 10)
    if _FULL16 == count or _FULL32 in (length, start):
        locator = _range(file, tail_at + end - 20, 20)
        if locator[:4] != b"PK\6\7":
            raise ValueError("the ZIP64 locator is missing")
        record = _range(file, struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\6\6":
            raise ValueError("the ZIP64 directory end is missing")
        count, length, start = struct.unpack_from("<3Q", record, 32)
    directory, at, found = _range(file, start, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\1\2":
            raise ValueError("the directory is damaged")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full, name_len, extra_len, comment_len = struct.unpack_from("<2L3H", directory, at + 20)
        local, = struct.unpack_from("<L", directory, at + 42)
        name = directory[at + 46:at + 46 + name_len].decode()
        extra = directory[at + 46 + name_len:at + 46 + name_len + extra_len]
        wide = _zip64_values(extra)
        # The ZIP64 field holds the saturated values only, in this order.
        full, packed, local = (next(wide) if v == _FULL32 else v for v in (full, packed, local))
        head = _range(file, local, 30)
        if head[:4] != b"PK\3\4":
            raise ValueError("a local header is missing")
        own_name, own_extra = struct.unpack_from("<2H", head, 26)
        found[name] = {"method": method, "start": local + 30 + own_name + own_extra, "packed": packed, "full": full}
        at += 46 + name_len + extra_len + comment_len
    return found


def _zip64_values(extra: bytes) -> Iterator[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            yield from struct.unpack_from(f"<{size // 8}Q", extra, at + 4)
        at += 4 + size


# --- writing -----------------------------------------------------------------------------------------------------

def _writer(folder: str, archive_bytes: int):
    def save(data: bytearray, index: list[str]) -> tuple[str, int]:
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        with files.open_output_stream(f"{root}/{name}") as out:
            out.write(zip64_bytes([(_DATA, bytes(data)), (_INDEX, "\n".join([*index, ""]).encode())]))
        return f"{folder}/{name}", len(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index, done = bytearray(), [], []
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, refers = (batch.column(c)[i].as_py() for c in range(5))
                packed = gzip.compress(record_bytes(page, url, payload, digest, refers), 1, mtime=0)
                index.append(f"{_id(page)} 20240101000000 " + json.dumps({"offset": str(len(data)), "length": str(len(packed))}))
                data += packed
                if len(data) >= archive_bytes:
                    done.append(save(data, index))
                    data, index = bytearray(), []
        if index:
            done.append(save(data, index))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "records"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page (page_id, url, html); path and number of records of every archive."""
    folder = folder or f"{shared_dir(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    # Counting copies before the shuffle keeps a payload of a third of all pages to one row per task.
    copies = rows.filter(F.length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    copies = tools.materialise(copies, "payload-copies")
    marked = rows.join(copies, "digest", "left").select("page_id", "url", "payload", "digest", F.when(
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    return tools.materialise(marked.mapInArrow(_writer(folder, archive_bytes), "path string, records long"), "archives")


# --- reading -----------------------------------------------------------------------------------------------------

def _ranges(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, int, int]] = []
            for path in batch.column("path").to_pylist():
                files, name = _open(path)
                with files.open_input_file(name) as file:
                    members = zip_members(file, file.size())
                    places = _index_places(file, members)
                    for member, m in members.items():
                        if not member.startswith("archive/") or not member.endswith((".warc", ".warc.gz")):
                            continue
                        if m["method"] != 0:
                            raise ValueError(f"{path}: {member} is packed; records can't be read by range")
                        starts = sorted(p for name, p in places if name in ("", member.rpartition("/")[2])) or [0]
                        for a, b in zip(starts, [*starts[1:], m["full"]]):
                            if rows and rows[-1][0] == path and sum(rows[-1][1:]) == m["start"] + a and rows[-1][2] < range_bytes and a:
                                rows[-1] = (path, rows[-1][1], rows[-1][2] + b - a)
                            else:
                                rows.append((path, m["start"] + a, b - a))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.int64())], ["path", "start", "size"])

    return run


def _index_places(file, members: dict[str, dict]) -> list[tuple[str, int]]:
    """(file name or empty, offset) of the records that the indexes list; packed indexes are inflated."""
    places = []
    for name, m in members.items():
        if not name.startswith("indexes/"):
            continue
        data = _range(file, m["start"], m["packed"])
        if m["method"] == 8:
            data = zlib.decompress(data, -15)
        if data[:2] == b"\x1f\x8b":
            data = gzip.decompress(data)
        for line in data.decode().splitlines():
            at = line.find("{")
            if at >= 0 and not line.startswith("!"):
                entry = json.loads(line[at:])
                places.append((entry.get("filename", "").rpartition("/")[2], int(entry["offset"])))
    return places


def record_ranges(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, start, size of runs of records in the archives that the column ``path`` names."""
    return archives.select("path").repartition(tools.partitions(archives.sparkSession)).mapInArrow(
        _ranges(range_bytes), "path string, start long, size long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _RECORD.split(", ")]
    for batch in batches:
        for path, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size"))):
            files, name = _open(path)
            with files.open_input_file(name) as file:
                data = _range(file, start, size)
            rows = []
            for record in parse_records(data):
                f = record["fields"]
                digest = f.get("warc-payload-digest", "").rpartition(":")[2]
                digest = base64.b32decode(digest).hex() if len(digest) == 32 else digest.lower()
                if f["warc-type"] == "response":
                    found = hashlib.sha1(record["payload"]).hexdigest()
                    if digest and digest != found:
                        raise ValueError(f"{path}: the payload of {f.get('warc-record-id')} does not have its digest")
                    digest = found
                rows.append((f.get("warc-target-uri"), _page(f.get("warc-record-id")), f["warc-type"], _page(f.get("warc-refers-to")), digest,
                             record["payload"] if f["warc-type"] == "response" else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()))], names)


def read_records(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """uri, page_id, record_type, refers_to, payload_digest, payload (null for revisits) of every record."""
    ranges = record_ranges(archives, range_bytes)
    return ranges.repartition(tools.partitions(archives.sparkSession)).mapInArrow(_read, _RECORD)


def payload_facts(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; sizes of revisits are those of their response."""
    facts = tools.materialise(records.select("page_id", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest",
                                             "record_type", "refers_to"), "record-facts")
    referred = facts.filter("record_type = 'response'").join(
        facts.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("full_bytes"))
    return facts.join(referred, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")

"""WARC archives with a two-level capture index.

Writing: each task writes one archive file to the shared folder, a compressed member per record, under a name of its own, so that a
repeated attempt harms nothing: only files named by the rows of the attempt that counted are ever read. Of records with equal payloads of
at least ``min_bytes`` bytes, that with the smallest page_id is a response; the others are revisits that name it and hold no payload.

Index: captures are sorted by reversed-host key (``com,example)/path``) and page_id. A part of the index is a file of compressed blocks of ``BLOCK_LINES``
lines, ending in the part's sparse directory: first key, place and length of each block. The list of parts is all that is sent to tasks. A part
holds ``PART_LINES`` captures; beyond ``MAX_PARTS`` parts they grow instead of their list, which stays small enough to send. A lookup searches the list of parts, then a part's directory, then one block, each by
bisection, and reads the record's byte range alone.

A null html is an empty payload, a null url an empty key. A page without an id is a response that nothing refers to. Rows that repeat a page_id
with an equal payload are each a response if theirs is the smallest id. Other columns are not looked at. An empty table gives an empty index.
Paths are opened through pyarrow's file systems, so the shared folder may be local, HDFS or an object store.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.llm.common import stored
from ledgerlake.session import scratch

MIN_BYTES = 0
BLOCK_LINES = 1000
PART_LINES = 250_000
MAX_PARTS = 10_000
READ_BYTES = 128 << 20  # of members a task reads, and as many tasks as there are cores at least
LOOKUP_ROWS = 10_000
WINDOW_BYTES = 4 << 20  # read at once where records follow each other
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "page_id long, url_key string, record_type string, file string, offset long, length long"


@dataclass
class Index:
    """parts: first_key, first_id, file, directory_at, directory_length, and of its records their number and bytes."""

    folder: str
    parts: DataFrame


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def url_key(url: str | None) -> str:
    """Host labels reversed and comma-joined, then port, path and query; fragment, scheme and user are dropped, blanks escaped.

    The key is that of the url as a record holds it, so a url read from a record has the key of the one written.
    """
    text = _target(url)
    try:
        u = urlsplit(text)
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return _plain(text)
    if not host:
        return _plain(text)
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    other = f":{port}" if port and port not in (80, 443) else ""
    return _plain(f"{labels}{other}){u.path or '/'}" + (f"?{u.query}" if u.query else ""))


def _plain(text: str) -> str:
    """Without characters that would end a line, a field or a header."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _target(url: str | None) -> str:
    """A url as records hold it."""
    return _plain((url or "").strip())


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, hashed: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One compressed WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _target(url)),
        ("WARC-Payload-Digest", f"sha1:{hashed}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(refers_to)),
            ("WARC-Refers-To-Target-URI", _target(refers_url)),
            ("WARC-Refers-To-Date", DATE),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(head.encode() + block + b"\r\n\r\n") + member.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """A record's fields and its payload (empty for a revisit)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        file, out, at = "", None, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, refers_to, refers_url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        file = f"{uuid.uuid4().hex}.warc.gz"
                        system.create_dir(f"{root}/warc", recursive=True)
                        out = system.open_output_stream(f"{root}/warc/{file}", compression=None)
                    member = record(page_id, url, payload, digest(payload), refers_to, refers_url)
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    rows.append((page_id, url_key(url), kind, file, at, len(member)))
                    at += len(member)
                names = ["page_id", "url_key", "record_type", "file", "offset", "length"]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write a record per page (page_id, url, html) and return the captures, as stored."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    source = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumns(
        {"sha": F.sha1("payload"), "size": F.octet_length("payload")}
    )
    known = source.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
    first = known.groupBy("sha", "size").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stored(first.select("sha", "size", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")), "warc-first")
    again = F.col("page_id") != F.col("first_id")  # null where nothing is shared, or the page has no id
    rows = source.join(first, ["sha", "size"], "left").select(
        "page_id", "url", "payload", F.when(again, F.col("first_id")).alias("refers_to"), F.when(again, F.col("first_url")).alias("refers_url")
    )
    return stored(rows.mapInArrow(_write(folder), CAPTURE), "warc-captures")


_PART = pa.schema(
    [("first_key", pa.string()), ("first_id", pa.int64()), *[(n, pa.string() if n == "file" else pa.int64()) for n in ("file", "directory_at", "directory_length", "records", "bytes")]]
)


def _tasks(spark: SparkSession, rows: int, needed: float) -> int:
    """As many tasks as the work needs, and one per core where there are rows for them. Rows are small beside what they stand for, so their bytes tell nothing."""
    return max(1, min(rows, spark.sparkContext.defaultParallelism), math.ceil(needed))


def _write_part(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        lines: list[list] = []
        directory: list[list] = []
        out, file, at, records, size = None, "", 0, 0, 0

        def flush() -> int:
            data = zlib.compress("".join(json.dumps(x) + "\n" for x in lines).encode(), 6)
            out.write(data)
            directory.append([lines[0][0], lines[0][1], at, len(data)])
            return len(data)

        try:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        file = f"{uuid.uuid4().hex}.cdx"
                        system.create_dir(f"{root}/index", recursive=True)
                        out = system.open_output_stream(f"{root}/index/{file}", compression=None)
                    lines.append(list(row))
                    records, size = records + 1, size + row[5]
                    if len(lines) == BLOCK_LINES:
                        at += flush()
                        lines = []
            if lines:
                at += flush()
            if out is not None:
                data = zlib.compress(json.dumps(directory).encode(), 6)
                out.write(data)
                yield pa.RecordBatch.from_pylist(
                    [{"first_key": directory[0][0], "first_id": directory[0][1], "file": file, "directory_at": at, "directory_length": len(data), "records": records, "bytes": size}],
                    schema=_PART,
                )
        finally:
            if out is not None:
                out.close()

    return run


def build_index(captures: DataFrame, folder: str) -> Index:
    """Sort captures by key and id into parts. A page without an id has -1 here, before all others."""
    keyed = captures.select("url_key", F.coalesce("page_id", F.lit(-1)).alias("page_id"), "record_type", "file", "offset", "length")
    lines = captures.count()
    parts = _tasks(captures.sparkSession, lines // BLOCK_LINES, min(lines / PART_LINES, MAX_PARTS))
    ordered = keyed.repartitionByRange(parts, "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    kinds = "first_key string, first_id long, file string, directory_at long, directory_length long, records long, bytes long"
    return Index(folder, stored(ordered.mapInArrow(_write_part(folder), kinds), "warc-parts"))


class _Files:
    """Byte ranges of files, read a window at a time where they follow each other."""

    def __init__(self, folder: str) -> None:
        self.system, self.root = _open(folder)
        self.path, self.file, self.start, self.window = "", None, 0, b""

    def read(self, path: str, at: int, length: int, ahead: int = 0) -> bytes:
        if path != self.path:
            if self.file is not None:
                self.file.close()
            self.path, self.file, self.start, self.window = path, self.system.open_input_file(f"{self.root}/{path}"), 0, b""
        if not self.start <= at or at + length > self.start + len(self.window):
            self.start, self.window = at, self.file.read_at(max(length, ahead), at)
        return self.window[at - self.start : at - self.start + length]


def _scan(folder: str):
    """All captures of the parts given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder)
        for batch in batches:
            for file, at, length in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                for _, _, block, size in json.loads(zlib.decompress(files.read(f"index/{file}", at, length))):
                    yield _captures(json.loads(x) for x in zlib.decompress(files.read(f"index/{file}", block, size)).splitlines())

    return run


def _captures(lines) -> pa.RecordBatch:
    names = ["url_key", "page_id", "record_type", "file", "offset", "length"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*lines, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def captures(index: Index) -> DataFrame:
    """The whole index as rows."""
    parts = index.parts.count()
    spread = index.parts.repartitionByRange(_tasks(index.parts.sparkSession, parts, parts), "file")
    return spread.mapInArrow(_scan(index.folder), "url_key string, page_id long, record_type string, file string, offset long, length long")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_url string"


def _described(member: bytes) -> dict:
    """What a record says of itself. The payload of a response is hashed and held against the digest it was written with."""
    fields, payload = parse(member)
    number = lambda name: int(m[1]) if (m := re.search(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    own = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and digest(payload) != own:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what was written")
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": None if revisit else len(payload),
        "payload_digest": own,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "refers_url": fields.get("WARC-Refers-To-Target-URI"),
    }


_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("refers_url", pa.string())]
)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder)
        for batch in batches:
            places = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            rows = [_described(files.read(f"warc/{file}", at, length, WINDOW_BYTES)) for file, at, length in places]
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    return run


def read_records(index: Index) -> DataFrame:
    """Every record of the archives, found through the index, read in the order of the files."""
    places = captures(index).select("file", "offset", "length")
    size = index.parts.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = _tasks(index.parts.sparkSession, size["records"], size["bytes"] / READ_BYTES)
    return places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(_read(index.folder), RECORD)


def _lookup(folder: str, parts: list[tuple]):
    """For each wanted (url, page_id or null): its captures, found by bisection at three levels, and the records themselves."""
    starts = [(key, first) for key, first, *_ in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, archives = _Files(folder), _Files(folder)
        part, directory, opens = -1, [], []
        for batch in batches:
            for url, page_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key = url_key(url)
                low = (key, -1 if page_id is None else page_id)
                high = (key, float("inf") if page_id is None else page_id)
                rows = []
                for p in range(max(bisect_left(starts, low) - 1, 0), bisect_right(starts, high)):
                    if p != part:
                        _, _, file, at, length = parts[p]
                        directory = json.loads(zlib.decompress(files.read(f"index/{file}", at, length)))
                        part, opens = p, [(k, i) for k, i, _, _ in directory]
                    for b in range(max(bisect_left(opens, low) - 1, 0), bisect_right(opens, high)):
                        _, _, at, length = directory[b]
                        lines = [json.loads(x) for x in zlib.decompress(files.read(f"index/{parts[p][2]}", at, length)).splitlines()]
                        names = [(x[0], x[1]) for x in lines]
                        for x in lines[bisect_left(names, low) : bisect_right(names, high)]:
                            rows.append({"asked_url": url, "asked_id": page_id} | _described(archives.read(f"warc/{x[3]}", x[4], x[5])))
                        if len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    return run


_FOUND = pa.schema([("asked_url", pa.string()), ("asked_id", pa.int64()), *_RECORD])


def lookup(index: Index, wanted: DataFrame, url_col: str = "url", id_col: str | None = None) -> DataFrame:
    """The records of the wanted urls (with id_col: of one page each): asked_url, asked_id and the columns of RECORD."""
    parts = index.parts.select("first_key", "first_id", "file", "directory_at", "directory_length").orderBy("first_key", "first_id").collect()
    asked = wanted.select(F.col(url_col).alias("asked_url"), (F.col(id_col) if id_col else F.lit(None)).cast("long").alias("asked_id"))
    rows = asked.count()
    spread = asked.repartitionByRange(_tasks(index.parts.sparkSession, rows, rows / LOOKUP_ROWS), "asked_url", "asked_id").sortWithinPartitions("asked_url", "asked_id")
    return spread.mapInArrow(_lookup(index.folder, [tuple(p) for p in parts]), "asked_url string, asked_id long, " + RECORD)


def archive(pages: DataFrame, spark: SparkSession, min_bytes: int = MIN_BYTES) -> Index:
    """Write the pages' archives and their index below a new folder of the shared one."""
    folder = scratch(spark, "warc")
    return build_index(write_archives(pages, folder, min_bytes), folder)


def resolved(index: Index) -> DataFrame:
    """Every record, a revisit with the payload size of the response it refers to, which the index looks up."""
    records = stored(read_records(index), "warc-records")
    targets = records.where("record_type = 'revisit'").select("refers_url", "refers_to").distinct()
    found = lookup(index, targets, "refers_url", "refers_to").where("record_type = 'response'")
    sizes = stored(found.groupBy(F.col("page_id").alias("target"), F.col("payload_digest").alias("target_digest")).agg(F.max("payload_bytes").alias("target_bytes")), "warc-targets")
    here: Column = (F.col("refers_to") == F.col("target")) & (F.col("payload_digest") == F.col("target_digest"))
    return records.join(sizes, here, "left").select(
        "page_id", F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )

"""WARC archives in seekable Zstandard bundles: written, indexed, read back, and fetched record by record.

A bundle is a file of independent Zstandard frames, each of some whole records, and a seek table in a last,
skippable frame: the compressed and plain size of every frame, then the number of frames (the seekable format of the
Zstandard project). Any Zstandard tool reads a bundle as one WARC file. The index, a Parquet table, maps each
record identifier to bundle, frame and offset in the plain frame, so a record costs one frame.

Of equal payloads one record, that of the largest page_id, is the response; the others are revisits that name it and
carry no payload. Payloads are equal when their SHA-256 digests and sizes are; the SHA-1 label follows the payload.
The winners of payloads that occur more than once are broadcast while there are at most ``BROADCAST_ROWS``. Beyond that the frequent
ones (fewer than ``HOT``) are broadcast, and all others meet their rows by a hash join whose built side holds digests only.

A record's block is an HTTP message, with headers alone in a revisit, so the size of a payload is read from the archive.

A task names its bundles at random and its index rows count only when Spark commits them, so a repeated or lost
attempt leaves unnamed files at most, which no reader opens.

Defined results: null payloads are empty; empty payloads are equal payloads as any other; a null url is empty; a
null page_id is below every other one and is null again when read; of rows equal in page_id and payload that win, one (that of
the smallest url) is the response. Other columns are not read. An empty table gives archives without bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.textbatch import prepare, release
from rankloom.session import fresh_path, staged

#: Plain bytes after which a frame ends, and compressed bytes after which a bundle ends.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
#: A payload of more than this share of the rows is frequent; so there are at most as many.
HOT = 1000
#: Winners (digest, two numbers) that may be broadcast.
BROADCAST_ROWS = 200_000
#: Tasks that read an archive.
MAX_TASKS = 10_000
# Fixed values of the seekable format and of WARC.
SKIPPABLE, SEEKABLE, TABLE_HEAD, TABLE_FOOT = 0x184D2A5E, 0x8F92EAB1, "<II", "<IBI"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST = -(1 << 63)
INDEX = "record_id string, bundle string, frame int, offset long, length long, record_type string, page_id long"
RECORDS = (
    "record_id string, record_type string, page_id long, url string, payload_digest string, payload_bytes long, "
    "refers_to_record string, refers_to long, payload binary"
)


class Archive(NamedTuple):
    """A folder of bundles, and the index of their records."""

    bundles: str
    index: DataFrame


# ---- records


def digest_label(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def response_id(payload: bytes) -> str:
    """The identifier of the only response with this payload."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, hashlib.sha256(payload).hexdigest())}"


def message(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def uri(url: str) -> str:
    """White space and control characters escaped, so that a field stays on its line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(frame: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record that starts at ``at``, and where the next one starts."""
    head = frame.index(b"\r\n\r\n", at)
    version, *lines = frame[at:head].decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"no WARC record at {at}")
    fields = dict(line.split(": ", 1) for line in lines)
    start = head + 4
    end = start + int(fields["Content-Length"])
    if frame[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} has no end")
    return fields, frame[start:end], end + 4


# ---- bundles


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame with (compressed, plain) sizes of all frames."""
    body = np.array(sizes, "<u4").reshape(-1, 2).tobytes() + struct.pack(TABLE_FOOT, len(sizes), 0, SEEKABLE)
    return struct.pack(TABLE_HEAD, SKIPPABLE, len(body)) + body


def frame_spans(read: Callable[[int, int], bytes], size: int) -> np.ndarray:
    """Start and end in the file of every frame, by the seek table at its end; ``read(at, n)`` gives bytes."""
    foot = struct.calcsize(TABLE_FOOT)
    count, descriptor, magic = struct.unpack(TABLE_FOOT, read(size - foot, foot))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8  # with or without checksums
    start = size - foot - count * width
    table = np.frombuffer(read(start, count * width), "<u4").reshape(count, width // 4)
    ends = np.cumsum(table[:, 0], dtype=np.int64)
    if count and ends[-1] != start - 8:
        raise ValueError("seek table does not fit the file")
    return np.stack([ends - table[:, 0], ends], axis=1)


class Bundles:
    """Writes records to bundles below a folder; ``close`` ends the last one."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int, level: int = 3) -> None:
        self.folder, self.frame_bytes, self.bundle_bytes = folder, frame_bytes, bundle_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.out = None
        self.buffer = bytearray()

    def add(self, data: bytes) -> tuple[str, int, int]:
        """Bundle, frame and offset of the record."""
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.out, self.sizes, self.written = open_output(f"{self.folder}/{self.name}"), [], 0
        place = (self.name, len(self.sizes), len(self.buffer))
        self.buffer += data
        if len(self.buffer) >= self.frame_bytes:
            self._end_frame()
            if self.written >= self.bundle_bytes:
                self._end_bundle()
        return place

    def _end_frame(self) -> None:
        packed = self.packer.compress(bytes(self.buffer))
        self.out.write(packed)
        self.sizes.append((len(packed), len(self.buffer)))
        self.written += len(packed)
        self.buffer = bytearray()

    def _end_bundle(self) -> None:
        self.out.write(seek_table(self.sizes))
        self.out.close()
        self.out = None

    def close(self) -> None:
        if self.out is not None:
            if self.buffer:
                self._end_frame()
            self._end_bundle()


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder in the shared store."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def open_output(uri: str) -> pa.NativeFile:
    store, path = store_of(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)


# ---- who is the response


def payload_keys(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(
        F.coalesce(F.col(page_id).cast("long"), F.lit(LEAST)).alias("pid"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload")
    ).withColumn("key", F.concat(F.unhex(F.sha2("payload", 256)), F.to_binary(F.lpad(F.hex(F.octet_length("payload")), 16, "0"), F.lit("hex"))))


def winners(keyed: DataFrame) -> DataFrame:
    """(key, keep, ties, size): the page_id that stays of equal payloads, its number of rows, and all rows."""
    each = keyed.groupBy("key", "pid").agg(F.count(F.lit(1)).alias("rows"))
    best = F.max(F.struct("pid", "rows")).alias("best")
    return each.groupBy("key").agg(best, F.sum("rows").alias("size")).select(
        "key", F.col("best.pid").alias("keep"), F.col("best.rows").alias("ties"), "size"
    )


def _decided(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row with ``keep`` and ``ties`` of its payload; null where no other row has it."""
    repeated = groups.filter("size > 1").select("key", "keep", "ties", "size")
    if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return keyed.join(F.broadcast(repeated.drop("size")), "key", "left")
    total = groups.agg(F.sum("size")).first()[0]
    frequent = F.col("size") * HOT > total
    marked = keyed.join(F.broadcast(repeated.filter(frequent).drop("size")), "key", "left")
    others = marked.filter("keep is null").drop("keep", "ties")
    others = others.join(repeated.filter(~frequent).drop("size").hint("shuffle_hash"), "key", "left")
    return marked.filter("keep is not null").unionByName(others)


def _single(decided: DataFrame, tied: bool) -> DataFrame:
    """(pid, url, payload, keep, response): one response per payload."""
    columns = ["pid", "url", "payload", "keep"]
    best = F.col("keep").isNull() | ((F.col("pid") == F.col("keep")) & (F.col("ties") == 1))
    plain = decided.select(*columns, best.alias("response"), "key", F.coalesce("ties", F.lit(1)).alias("ties"))
    if not tied:
        return plain.select(*columns, "response")
    # rows of one page_id and payload: counted per url, of which the smallest gives the response
    equal = F.coalesce((F.col("pid") == F.col("keep")) & (F.col("ties") > 1), F.lit(False))
    each = plain.filter(equal).groupBy("key", "pid", "keep", "url").agg(F.any_value("payload").alias("payload"), F.count(F.lit(1)).alias("rows"))
    first = plain.filter(equal).groupBy("key").agg(F.min("url").alias("first"))
    each = each.join(first, "key").withColumn("response", F.col("url") == F.col("first"))
    chosen = each.filter("response").select(*columns, "response")
    again = each.withColumn("rows", F.col("rows") - F.col("response").cast("long")).filter("rows > 0")
    again = again.select(*columns, F.lit(False).alias("response"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("col")
    return plain.filter(~equal).select(*columns, "response").unionByName(chosen).unionByName(again)


# ---- writing and reading


def write_archive(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None,
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> Archive:
    """A record per row, in bundles below ``folder`` (by default a new one in the shared folder), with their index."""
    spark = prepare(pages.sparkSession)
    folder = (folder or fresh_path(spark, "warc")).rstrip("/")
    keyed = payload_keys(pages, page_id, url, html)
    groups = staged(winners(keyed.select("key", "pid")), "payloads")
    tied = not groups.filter("ties > 1").isEmpty()
    rows = _single(_decided(keyed, groups), tied)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles = Bundles(f"{folder}/bundles", frame_bytes, bundle_bytes)
        for batch in batches:
            release()
            out = []
            for pid, target, payload, keep, response in zip(*(c.to_pylist() if i != 2 else c for i, c in enumerate(batch.columns))):
                payload = payload.as_buffer().to_pybytes()
                label, page = digest_label(payload), None if pid == LEAST else pid
                # fields named X- are of this library
                fields: list[tuple[str, object]] = [
                    ("WARC-Type", "response" if response else "revisit"),
                    ("WARC-Record-ID", f"<{response_id(payload)}>" if response else f"<urn:uuid:{uuid.uuid4()}>"),
                    ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri(target)), ("WARC-Payload-Digest", f"sha1:{label}"),
                    ("Content-Type", "application/http;msgtype=response"), ("X-Page-ID", page),
                ]
                if not response:
                    fields += [
                        ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{response_id(payload)}>"),
                        ("X-Refers-To-Page-ID", None if keep == LEAST else keep),
                    ]
                data = record(fields, message(len(payload)) + (payload if response else b""))
                out.append((fields[1][1][1:-1], *bundles.add(data), len(data), fields[0][1], page))
            yield _index_batch(out)
        bundles.close()

    path = f"{folder}/index"
    rows.select("pid", "url", "payload", "keep", "response").mapInArrow(run, INDEX).write.parquet(path)
    return Archive(f"{folder}/bundles", spark.read.parquet(path))


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 7
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = ["record_id", "bundle", "frame", "offset", "length", "record_type", "page_id"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind, label = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    head, payload = block.split(b"\r\n\r\n", 1)
    size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
    if kind == "response" and (len(payload) != size or digest_label(payload) != label):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its size and digest")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    response = fields.get("WARC-Refers-To")
    return (
        fields["WARC-Record-ID"][1:-1], kind, page and int(page), fields["WARC-Target-URI"], label, size, response and response[1:-1],
        refers and int(refers), payload if kind == "response" else None,
    )


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 9
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [field.split()[0] for field in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _frame_records(frames: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for packed in frames:
        frame, at, rows = zstandard.decompress(packed), 0, []
        while at < len(frame):
            fields, block, at = parse(frame, at)
            rows.append(_row(fields, block))
        yield _record_batch(rows)


def read_archive(archive: Archive) -> DataFrame:
    """Every record of the indexed bundles; a response whose payload does not fit its digest is an error."""
    folder = archive.bundles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                with _Bundle(f"{folder}/{bundle}") as source:
                    release()
                    yield from _frame_records(source.frame(i) for i in range(source.count))

    names = archive.index.select("bundle").distinct()
    # dealt by number, so that the few bytes of names do not end up in one task
    return names.repartition(max(1, min(names.count(), MAX_TASKS))).mapInArrow(run, RECORDS)


class _Bundle:
    """An open bundle; ``frame`` gives the compressed bytes of one frame."""

    def __init__(self, uri: str) -> None:
        store, path = store_of(uri)
        self.file = store.open_input_file(path)
        self.spans = frame_spans(lambda at, n: self.file.read_at(n, at), self.file.size())
        self.count = len(self.spans)

    def frame(self, i: int) -> bytes:
        start, end = self.spans[i].tolist()
        return self.file.read_at(end - start, start)

    def __enter__(self) -> _Bundle:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()


def fetch(archive: Archive, ids: DataFrame) -> DataFrame:
    """The records with the identifiers in the column ``record_id`` of ``ids``; only the frames that hold them are read."""
    wanted = archive.index.join(ids.select("record_id").distinct(), "record_id").select("bundle", "frame", "offset")
    folder = archive.bundles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, number, frame = None, None, None, b""
        for batch in batches:
            rows = []
            for bundle, i, offset in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    if source is not None:
                        source.file.close()
                    name, source, number = bundle, _Bundle(f"{folder}/{bundle}"), None
                if i != number:
                    number, frame = i, zstandard.decompress(source.frame(i))
                rows.append(_row(*parse(frame, offset)[:2]))
            yield _record_batch(rows)
        if source is not None:
            source.file.close()

    # the rows of one frame lie together, so it is read once
    tasks = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = wanted.repartition(tasks, "bundle").sortWithinPartitions("bundle", "frame", "offset")
    return placed.mapInArrow(run, RECORDS)


def archived_pages(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row, from the archives read back."""
    return read_archive(write_archive(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM p)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(s, 1 + (5 * i) // 4, 2) AS BIGINT) >> (3 - (5 * i) % 4)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM k
"""

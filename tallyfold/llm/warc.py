"""WARC: archives whose records are Zstandard frames of their own under one dictionary.

Every archive starts with a skippable frame that embeds the dictionary (built from a bounded sample of the archive's own
first records); every record is then compressed individually, so a reader can start at any record's offset.

Of records with equal payloads of at least `least` bytes, the one with the smallest key is the `response`; the others
are `revisit` records, which carry the digest, the length and the response's record id but no payload.

Archives are written to the shared folder under names that depend only on the task, by writing aside and renaming: a
task that runs again leaves the same file. Records and frames are streamed; a task holds one batch and one dictionary
sample.

Defined cases: a null or empty payload is 0 bytes (and is deduplicated like others if `least` is 0); a null URL is
written as an empty one, control characters in a URL are percent-encoded; rows with the same key are archived as often
as they occur; of several smallest rows with the same key each is a response; rows without a key are rejected; an empty
table makes no archive; only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import posixpath
import struct
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, scratch

#: The magic number of the skippable frame that holds a dictionary, and of a Zstandard frame.
DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
DICT_BYTES = 65_536
SAMPLE_BYTES = 2_000_000
#: So many digests (about 60 bytes each) may be broadcast; more are joined.
BROADCAST_DIGESTS = 200_000
#: Copies of the table of responses, so that the revisits of one hot payload meet it in many tasks.
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
RECORD_ID = "<urn:x-page:{}>"


def _open(path: str, mode: str):
    """A local path directly, any other URI through Arrow's file systems."""
    path = path.removeprefix("file://") if path.startswith("file:///") else path
    if "://" not in path:
        if mode == "wb":
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    if mode == "wb":
        system.create_dir(posixpath.dirname(inner), recursive=True)
        return system.open_output_stream(inner)
    return system.open_input_stream(inner)


def _rename(old: str, new: str) -> None:
    if "://" not in old or old.startswith("file:///"):
        os.replace(old.removeprefix("file://"), new.removeprefix("file://"))
        return
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(old)
    system.move(inner, fs.FileSystem.from_uri(new)[1])


def digest_of(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record with an HTTP header block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    url = "".join(c if 32 < ord(c) != 127 else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {RECORD_ID.format(key)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {RECORD_ID.format(refers_to)}"]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; from too few or too small samples, their last bytes as they are."""
    try:
        if sum(map(len, samples)) < 8 * 1024 or len(samples) < 16:
            raise zstandard.ZstdError("too few")
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 8), samples, k=256, d=8, steps=1)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict((b"".join(samples) or b"WARC/1.1")[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Records into one archive; the dictionary comes from the first ones."""

    def __init__(self, out: BinaryIO):
        self.out, self.held, self.size, self.compressor = out, [], 0, None

    def add(self, one: bytes) -> None:
        if self.compressor is not None:
            self.out.write(self.compressor.compress(one))
            return
        self.held.append(one)
        self.size += len(one)
        if self.size >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        dictionary = build_dictionary([x[:SAMPLE_BYTES] for x in self.held])
        raw = dictionary.as_bytes()
        self.out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
        for one in self.held:
            self.out.write(self.compressor.compress(one))
        self.held = []

    def close(self) -> None:
        if self.compressor is None and self.held:
            self._begin()


def read_archive(source: BinaryIO) -> Iterator[bytes]:
    """The records of an archive, one by one."""
    head = source.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICT_MAGIC:
        raise ValueError("no dictionary frame leads the archive")
    raw = source.read(size)
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    data, frame = b"", decompressor.decompressobj()
    found, fed = [], False
    while True:
        if not data and not (data := source.read(1 << 20)):
            break
        found.append(frame.decompress(data))
        fed = True
        if frame.eof:
            yield b"".join(found)
            data, found, fed, frame = frame.unused_data, [], False, decompressor.decompressobj()
        else:
            data = b""
    if fed:
        raise ValueError("the archive ends within a record")


def parse_record(one: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload)."""
    head, _, body = one.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = body[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():05d}.warc.zst"
        aside = f"{path}.{task.taskAttemptId()}.tmp"
        writer, records = None, 0
        out = None
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for at in range(batch.num_rows):
                key, url, payload, sha, refers_to = (c[at].as_py() for c in columns)
                if key is None:
                    raise ValueError("a page without a key can't be archived")
                if writer is None:
                    out = _open(aside, "wb")
                    writer = ArchiveWriter(out)
                writer.add(record(key, url, payload, base64.b32encode(sha).decode(), refers_to))
                records += 1
        if writer is not None:
            writer.close()
            out.close()
            _rename(aside, path)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records]})

    return run


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Archives of all pages below `folder`, one for each task; returns (path, records), already written.

    Payloads are not shuffled while the digests that occur more than once can be broadcast.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    own = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    marked = own.select("key", F.unhex(F.sha1("payload")).alias("sha"), F.octet_length("payload").alias("n"))
    first = cut(marked.where(F.col("n") >= least).groupBy("sha").agg(F.min("key").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("sha", "first"))
    hashed = own.withColumn("sha", F.unhex(F.sha1("payload")))
    if first.count() <= BROADCAST_DIGESTS:
        joined = hashed.join(F.broadcast(first), "sha", "left")
    else:
        salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = hashed.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["sha", "salt"], "left")
    refers_to = F.when((F.col("first") != F.col("key")) & (F.octet_length("payload") >= least), F.col("first"))
    return cut(joined.select("key", "url", "payload", "sha", refers_to.alias("refers_to")).mapInArrow(_writer(folder), "path string, records long"))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    page_of = lambda x: int(x.rpartition(":")[2].rstrip(">"))

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            with _open(path, "rb") as source:
                for one in read_archive(source):
                    fields, http, payload = parse_record(one)
                    digest = fields["WARC-Payload-Digest"].partition(":")[2]
                    size = int(http["Content-Length"])
                    if fields["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
                        raise ValueError(f"{path}: {fields['WARC-Record-ID']} does not hold what its header says")
                    refers_to = fields.get("WARC-Refers-To")
                    rows.append((page_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers_to and page_of(refers_to)))
                    if len(rows) >= 5_000:
                        yield flush(rows)
                        rows = []
            if rows:
                yield flush(rows)


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives in `archives` (path, ...): one archive per task; responses are verified."""
    paths = archives.select("path")
    spread = paths.repartition(max(1, archives.count()), "path")
    return spread.mapInArrow(_reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages into archives and back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_archives(write_archives(pages, scratch(spark, "warc")))


OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h FROM pages
), f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""

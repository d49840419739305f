"""Deterministic sharded WARC writer, and a reader of what it wrote.

Records are cut into shards by ranges of their key with about equal payload bytes, sorted within the shard and
written as one gzip member each. A shard's file is closed and the next one begun when its compressed size
reaches `file_bytes`. Everything in a file follows from the records: ids and digests are made anew from key and
payload, dates are a parameter, and shard borders come from exact sums over key blocks. So writing again, or
retrying a task, gives the same files.

A task writes each file under a temporary name of its own and renames it when it is whole; then the list of all
files, with record counts, sizes and digests, is written as a manifest under a temporary name and renamed. Readers
start from the manifest, so files that a lost attempt left behind are never read.

Of records with equal payloads of at least `min_revisit` bytes the one with the largest key is a response and the
others revisit it; shorter ones are all responses. Rows that repeat key and payload are records of their own, and
of the largest key all of them are responses. Null payloads count as empty. Records with a null key come first
(they are revisits where an equal payload has a key) and keep the null. An empty table gives an empty manifest.
The folder may be on any file system that pyarrow opens by its URI.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.session import materialize

SHARD_BYTES = 16 << 20
FILE_BYTES = 4 << 20
BLOCKS = 1 << 16
DATE = "2026-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
FILES = "shard long, name string, records long, bytes long, sha256 string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record with HTTP headers around the payload; a revisit carries headers only."""
    sha1 = digest(payload)
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        body += payload
    target = "".join(c for c in url or "" if c > " ") or "about:blank"
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{key}/{sha1}')}>",
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "WARC-Block-Digest": f"sha1:{digest(body)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
        "X-Payload-Length": str(len(payload)),
    }
    if key is not None:
        head["X-Record-Key"] = str(key)
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{refers_to}/{sha1}')}>"
        head["X-Refers-To-Key"] = str(refers_to)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time or a name."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class _Shard:
    """The files of one shard, one open at a time."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, file_bytes: int, attempt: str):
        self.store, self.folder, self.shard, self.file_bytes, self.attempt = store, folder, shard, file_bytes, attempt
        self.part, self.out = 0, None

    def add(self, data: bytes) -> tuple | None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.folder}/.{self.name}.{self.attempt}"
            self.out, self.records, self.size, self.sha = self.store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        packed = member(data)
        self.out.write(packed)
        self.sha.update(packed)
        self.records += 1
        self.size += len(packed)
        return self.close() if self.size >= self.file_bytes else None

    def close(self) -> tuple | None:
        if self.out is None:
            return None
        self.out.close()
        self.store.move(self.temporary, f"{self.folder}/{self.name}")
        self.out, self.part = None, self.part + 1
        return self.shard, self.name, self.records, self.size, self.sha.hexdigest()


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int, date: str) -> Iterator[pa.RecordBatch]:
    """Rows come by shard and key; before a key's records come the marks of those that are revisits."""
    store, path = fs.FileSystem.from_uri(folder)
    attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
    open_: _Shard | None = None
    marked_key, marks = None, {}
    done: list[tuple | None] = []
    for batch in batches:
        for shard, key, kind, url, body, sha, refers in zip(*(batch.column(i) for i in range(7)), strict=True):
            shard, key = shard.as_py(), key.as_py()
            if key != marked_key:
                marked_key, marks = key, {}
            if not kind.as_py():
                marks[sha.as_py()] = refers.as_py()
                continue
            if open_ is None or open_.shard != shard:
                done.append(open_.close() if open_ else None)
                open_ = _Shard(store, path, shard, file_bytes, attempt)
            payload = body.as_py()
            own = hashlib.sha1(payload).hexdigest() if marks else None
            done.append(open_.add(record(key, url.as_py(), payload, marks.get(own), own in marks, date)))
    done.append(open_.close() if open_ else None)
    rows = [r for r in done if r]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["shard", "name", "records", "bytes", "sha256"])


def _with_shards(records: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """Records with their shard, and the number of shards.

    Borders come from exact sums over at most BLOCKS blocks of equal key width, so there are no more shards
    than that, and what is collected and broadcast has a bound.
    """
    least, most = records.agg(F.min("key"), F.max("key")).first()
    least, width = least or 0, ((most or 0) - (least or 0)) // BLOCKS + 1
    block = F.coalesce(F.floor((F.col("key") - F.lit(least)) / width), F.lit(0)).cast("long")
    sums = records.groupBy(block.alias("block")).agg(F.sum(F.length("body") + 512).alias("bytes")).collect()
    shard, filled, rows = 0, 0, []
    for number, size in sorted(tuple(r) for r in sums):
        if filled >= shard_bytes:
            shard, filled = shard + 1, 0
        filled += size
        rows.append((number, shard))
    shards = records.sparkSession.createDataFrame(rows, "block long, shard long")
    return records.withColumn("block", block).join(F.broadcast(shards), "block").drop("block"), shard + 1


def write_archives(pages: DataFrame, folder: str, payload: str = "html", key: str = "page_id", url: str = "url", min_revisit: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE) -> list[str]:
    """Write every row as a record below `folder` (a URI) and return the manifest's files."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    records = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("body"))
    records, shards = _with_shards(records, shard_bytes)
    hashed = records.filter(F.length("body") >= min_revisit).select("key", "shard", F.sha1("body").alias("sha"))
    responses = hashed.groupBy("sha").agg(F.max("key").alias("refers"), F.count("*").alias("n")).filter("n > 1 and refers is not null").select("sha", "refers")
    marks = hashed.join(responses, "sha").filter("key is null or key < refers").distinct()
    null = F.lit(None)
    flow = records.select("shard", "key", F.lit(1).alias("kind"), "url", "body", null.cast("string").alias("sha"), null.cast("long").alias("refers")).union(
        marks.select("shard", "key", F.lit(0), null.cast("string"), null.cast("binary"), "sha", "refers")
    )
    # every task writes whole shards; equal rows are in order by all that a record is made of
    ordered = flow.repartition(shards, "shard").sortWithinPartitions("shard", "key", "kind", F.sha1("body"), "url")
    files = materialize(ordered.mapInArrow(lambda it: _write(it, folder, file_bytes, date), FILES), "warc_files")
    manifest = [r.asDict() for r in files.orderBy("name").toLocalIterator()]
    temporary = f"{path}/.manifest.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary, compression=None) as out:
        out.write("".join(json.dumps(m) + "\n" for m in manifest).encode())
    store.move(temporary, f"{path}/manifest.jsonl")
    return [m["name"] for m in manifest]


def _members(source, size: int = 1 << 18) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    inflate, held = zlib.decompressobj(31), []
    while data := source.read(size):
        while data:
            held.append(inflate.decompress(data))
            data = b""
            if inflate.eof:
                yield b"".join(held)
                data, inflate, held = inflate.unused_data, zlib.decompressobj(31), []
    if any(held):
        raise ValueError("an archive ends within a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; digests and lengths are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"a damaged record: {headers.get('WARC-Record-ID')}")
    payload = block.partition(b"\r\n\r\n")[2]
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{digest(payload)}":
        raise ValueError(f"a payload that is not its digest's: {headers['WARC-Record-ID']}")
    return headers, payload


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    store, path = fs.FileSystem.from_uri(folder)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * with_payload

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows, size = [], 0
            with store.open_input_stream(f"{path}/{name}", compression=None) as source:
                for data in _members(source):
                    h, payload = parse(data)
                    key, refers = h.get("X-Record-Key"), h.get("X-Refers-To-Key")
                    row = (key and int(key), int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], refers and int(refers), h["WARC-Target-URI"])
                    rows.append(row + (payload if h["WARC-Type"] == "response" else None,) * with_payload)
                    size += len(payload) * with_payload
                    if len(rows) >= 4096 or size >= 1 << 23:
                        yield batch_of(rows)
                        rows, size = [], 0
            yield batch_of(rows)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the manifest's files: page_id, payload_bytes, payload_digest, record_type, refers_to, url and,
    on demand, payload (null for revisits)."""
    files = spark.read.schema(FILES).json(f"{folder}/manifest.jsonl").select("name")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload
    return files.repartition(max(1, spark.sparkContext.defaultParallelism), "name").mapInArrow(lambda it: _read(it, folder, with_payload), schema)

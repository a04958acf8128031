"""WARC archives with a two-level capture index.

Writing: each task writes one archive of gzip members, one per record, and
tells where each record lies. Payloads that several pages share are kept once,
as the response of the page with the largest id; the others revisit it.

Index: entries are sorted by reversed-host URL key and id into shards. A shard
file holds compressed blocks of BLOCK entries; its sparse directory holds the
first key and the range of each block. A lookup bisects the shards' first keys
(one per shard, sent to every task), then the shard's directory, and then
range-reads one block and one record.

Archives and index lie in the shared scratch folder (or a given one) and are
opened through pyarrow file systems. File names carry the task attempt, so a
repeated task never touches another attempt's files.

Defined results: a null html is an empty payload; a null url has the empty key;
rows that share page_id and payload are all responses; rows without page_id
revisit the largest id of their payload, or are responses if there is none;
line breaks in a url are percent-encoded; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import input_bytes, new_path, shuffle_width, stash

BLOCK = 1000
DATE = "1970-01-01T00:00:00Z"
ENTRY = "key string, page_id long, url string, file string, at long, size long"
SHARD_BYTES = 64 << 20


def surt(url: str | None) -> str:
    """Key of a URL: host labels reversed, then port, path and query; no scheme or fragment."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port and (parts.scheme, parts.port) not in (("http", 80), ("https", 443)) else ""
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def _clean(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url, payload: bytes, digest: str, refers_to, target: str | None) -> bytes:
    """One uncompressed WARC record; ``refers_to`` makes it a revisit."""
    head = [f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()]
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if page_id is not None:
        fields.append(("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if refers_to is None:
        head.append(payload)
    else:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        if target is not None:
            fields.append(("WARC-Refers-To-Target-URI", _clean(target)))
    block = b"".join(head)
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    names = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{names}\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def deflate(raw: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def inflate(raw: bytes) -> bytes:
    return zlib.decompress(raw, 31)


def base32_of_hex(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _name(kind: str, end: str) -> str:
    task = TaskContext.get()
    return f"{kind}-{task.partitionId():05d}-{task.taskAttemptId()}{end}"


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name, at = _name("pages", ".warc.gz"), 0
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                rows = {k: [] for k in ("key", "page_id", "url", "file", "at", "size")}
                for page_id, url, html, digest, refers_to, target in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to", "target")), strict=True):
                    raw = deflate(record(page_id, url, html, base32_of_hex(digest), refers_to, target))
                    out.write(raw)
                    for k, v in zip(rows, (surt(url), page_id, url, name, at, len(raw)), strict=True):
                        rows[k].append(v)
                    at += len(raw)
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows))

    return run


def _build(folder: str):
    """Blocks and directory of one shard from its sorted entries; a row for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        name, at, held, directory = _name("index", ".cdx"), 0, [], []
        out = None

        def block() -> None:
            nonlocal at
            raw = zlib.compress("\n".join(json.dumps(x) for x in held).encode(), 6)
            out.write(raw)
            directory.append([*held[0][:2], at, len(raw)])
            at += len(raw)
            held.clear()

        for batch in batches:
            out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(list(row))
                if len(held) == BLOCK:
                    block()
        if out is None:
            return
        if held:
            block()
        out.close()
        with fs.open_output_stream(f"{root}/{name}.dir", compression=None) as side:
            side.write(zlib.compress(json.dumps(directory).encode(), 6))
        shard = TaskContext.get().partitionId()
        columns = zip(*[(shard, name, k, p, a, n) for k, p, a, n in directory], strict=True)
        kinds = (("shard", pa.int32()), ("name", pa.string()), ("key", pa.string()), ("page_id", pa.int64()), ("at", pa.int64()), ("size", pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[k for k, _ in kinds])

    return run


def _order(key: str, page_id) -> tuple:
    return (key.encode(), page_id is not None, page_id or 0)


@dataclass
class Archive:
    """Where archives and index lie. ``shards`` has the first entry and name of each shard."""

    folder: str
    shards: list[tuple[str, int | None, str]]

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """Lookups and range reads; keeps a few open files, directories and blocks."""

    def __init__(self, archive: Archive):
        self.fs, self.root = pafs.FileSystem.from_uri(archive.folder)
        self.names = [n for _, _, n in archive.shards]
        self.firsts = [_order(k, p) for k, p, _ in archive.shards]
        self.open = lru_cache(64)(lambda name: self.fs.open_input_file(f"{self.root}/{name}"))
        self.directory = lru_cache(16)(self._directory)
        self.block = lru_cache(32)(self._block)
        self.captured = lru_cache(4096)(self._captured)

    def bytes_at(self, name: str, at: int, size: int) -> bytes:
        return self.open(name).read_at(size, at)

    def _directory(self, name: str) -> tuple[list[tuple], list[tuple[int, int]]]:
        with self.fs.open_input_file(f"{self.root}/{name}.dir") as f:
            rows = json.loads(zlib.decompress(f.read()))
        return [_order(k, p) for k, p, _, _ in rows], [(a, n) for _, _, a, n in rows]

    def _block(self, name: str, at: int, size: int) -> list[list]:
        return [json.loads(x) for x in zlib.decompress(self.bytes_at(name, at, size)).split(b"\n")]

    def find(self, key: str, page_id) -> list | None:
        """Entry of a capture, by bisection of shards, directory and block."""
        want = _order(key, page_id)
        shard = bisect_right(self.firsts, want) - 1
        if shard < 0:
            return None
        firsts, places = self.directory(self.names[shard])
        entries = self.block(self.names[shard], *places[bisect_right(firsts, want) - 1])
        at = bisect_right(entries, want, key=lambda e: _order(e[0], e[1])) - 1
        return entries[at] if at >= 0 and _order(*entries[at][:2]) == want else None

    def record(self, entry: list) -> tuple[dict[str, str], bytes]:
        return parse(inflate(self.bytes_at(entry[3], entry[4], entry[5])))

    def _captured(self, key: str, page_id) -> tuple[int, str]:
        """Payload size and digest of a stored response."""
        entry = self.find(key, page_id)
        if entry is None:
            raise LookupError(f"no capture of page {page_id}")
        _, block = self.record(entry)
        payload = block.partition(b"\r\n\r\n")[2]
        return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()

    def page(self, entry: list) -> tuple:
        """(page_id, payload_bytes, payload_digest, record_type, refers_to) read from the archive."""
        fields, block = self.record(entry)
        refers_to = None
        if fields["WARC-Type"] == "revisit":
            refers_to = int(fields["WARC-Refers-To"][len("<urn:page:") : -1])
            size, digest = self.captured(surt(fields.get("WARC-Refers-To-Target-URI")), refers_to)
        else:
            payload = block.partition(b"\r\n\r\n")[2]
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"payload of page {entry[1]} does not have its digest")
        return entry[1], size, digest, fields["WARC-Type"], refers_to


def write_archive(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> tuple[Archive, DataFrame]:
    """Write ``pages(page_id, url, html)``; the archive and its index blocks, one row each."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    bodies = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("html")).withColumn("digest", F.sha1("html"))
    shared = bodies.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("c"))
    shared = stash(shared.where("c > 1").select("digest", F.col("last.page_id").alias("last"), F.col("last.url").alias("target")), "warc-shared")
    joined = bodies.join(shared, "digest", "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    rows = joined.select("page_id", "url", "html", "digest", F.when(revisit, F.col("last")).alias("refers_to"), F.when(revisit, F.col("target")).alias("target"))
    entries = stash(rows.mapInArrow(_write(folder), ENTRY), "warc-entries")
    shards = max(1, min(4096, max(shuffle_width(spark), input_bytes(entries) // SHARD_BYTES)))
    ordered = entries.repartitionByRange(shards, F.col("key").asc(), F.col("page_id").asc_nulls_first()).sortWithinPartitions(F.col("key").asc(), F.col("page_id").asc_nulls_first())
    blocks = stash(ordered.mapInArrow(_build(folder), "shard int, name string, key string, page_id long, at long, size long"), "warc-blocks")
    heads = blocks.groupBy("name").agg(F.min("shard").alias("shard"), F.min(F.struct("at", "key", "page_id")).alias("h")).collect()
    return Archive(folder, [(r.h.key, r.h.page_id, r.name) for r in sorted(heads, key=lambda r: r.shard)]), blocks


def _read(archive: Archive):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = archive.reader()
        for batch in batches:
            for name, at, size in zip(*(batch.column(c).to_pylist() for c in ("name", "at", "size")), strict=True):
                rows = [reader.page(e) for e in reader.block(name, at, size)]
                columns = zip(*rows, strict=True)
                kinds = (("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[k for k, _ in kinds])

    return run


def read_archive(archive: Archive, blocks: DataFrame) -> DataFrame:
    """Every capture, read back block by block; revisits are resolved by lookup."""
    spread = blocks.select("name", "at", "size").repartition(max(shuffle_width(blocks.sparkSession), 1))
    return spread.mapInArrow(_read(archive), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _lookup(archive: Archive):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = archive.reader()
        for batch in batches:
            found = []
            for url, page_id in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
                entry = reader.find(surt(url), page_id)
                found.append(reader.record(entry)[1].partition(b"\r\n\r\n")[2] if entry else None)
            yield pa.RecordBatch.from_arrays([batch.column("url"), batch.column("page_id"), pa.array(found, pa.binary())], names=["url", "page_id", "payload"])

    return run


def lookup(archive: Archive, wanted: DataFrame) -> DataFrame:
    """Stored payloads of ``wanted(url, page_id)``; empty for revisits, null for what is not there."""
    return wanted.select("url", "page_id").mapInArrow(_lookup(archive), "url string, page_id long, payload binary")

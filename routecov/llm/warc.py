"""Deterministic sharded WARC writer and reader.

Pages are ranked by id; a page's shard follows from the payload bytes before
it, so shards do not depend on partitions or executors.  One task writes a
shard in order, rolls files by compressed size, writes each under a temporary
name and renames it when complete.  The same shard always gives the same
bytes, so a task that runs twice replaces files with equal ones.  The manifest
is written last and is the commit: readers open only the files it names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov.session import scratch_path

from .common import cut_lineage, read_table, text_of
from .ordering import positions

#: Payloads shorter than this are always stored whole.
LEAST_REVISIT = 100
SHARD_BYTES = 32 << 20
ROLL_BYTES = 8 << 20
LEVEL = 4
MAX_READERS = 20_000
DATE = "1970-01-01T00:00:00Z"
_NAMES = uuid.UUID("6f1d3c1e-2f0b-5b0a-9a39-6d0a0c8f4b11")
_MANIFEST = pa.schema([("file", pa.string()), ("shard", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {digest}')}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


def page_record(page_id, url, payload: bytes, digest: str, size: int, refers_to, date: str = DATE) -> bytes:
    """One page as a response, or as a revisit of page ``refers_to`` with the same payload."""
    target = re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, digest)),
               ("WARC-Date", date), ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("WARC-Payload-Digest", "sha256:" + digest)]
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    return _record(headers, block)


class _Shard:
    """Files of one shard, each complete before it gets its name."""

    def __init__(self, store: fs.FileSystem, folder: str, shard: int, roll: int, level: int):
        self.store, self.folder, self.shard, self.roll, self.level = store, folder, shard, roll, level
        self.no, self.out, self.done = 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"pages-{self.shard:08d}-{self.no:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary-{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sum = 0, 0, hashlib.sha256()
            info = f"filename: {self.name}\r\nformat: WARC File Format 1.1\r\n".encode()
            self._put(_member(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("file", self.name)), ("WARC-Date", DATE),
                               ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info), self.level))
        self._put(member)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.shard, self.records, self.size, self.sum.hexdigest()))
            self.out, self.no = None, self.no + 1


def _shard_of(pages: pa.Array, starts: np.ndarray) -> pa.Array:
    """Shards of page ids by the first id of each shard; nulls belong to the first."""
    ids = pc.fill_null(pages, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    return pa.array(np.maximum(np.searchsorted(starts, ids, "right") - 1, 0), pa.int64())


def _responses(level: int, starts):
    """Each page with its shard and as a compressed response record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            made = [_member(page_record(page, url, html, digest, size, None), level) for page, url, digest, size, html in zip(*columns)]
            yield pa.RecordBatch.from_arrays([_shard_of(batch.column(0), starts.value), *batch.columns[:-1], pa.array(made, pa.binary())],
                                             ["shard", *batch.schema.names[:-1], "member"])
    return run


def _placed(starts):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_shard_of(batch.column(0), starts.value), *batch.columns], ["shard", *batch.schema.names])
    return run


def _write(uri: str, roll: int, level: int):
    """Writes one shard: its pages in order, each as a response or as a revisit."""
    def run(pages: pa.Table, revisits: pa.Table) -> pa.Table:
        if not pages.num_rows:
            return _MANIFEST.empty_table()
        store, folder = fs.FileSystem.from_uri(uri)
        shard = _Shard(store, folder, pages.column("shard")[0].as_py(), roll, level)
        refers = {(r["page_id"], r["digest"]): r["first"] for r in revisits.to_pylist()}
        rows = pages.select(["page_id", "digest", "url", "size"]).to_pylist()
        members = pages.column("member")
        for i in sorted(range(len(rows)), key=lambda i: (rows[i]["page_id"] is not None, rows[i]["page_id"] or 0, rows[i]["digest"], rows[i]["url"])):
            r = rows[i]
            first = refers.get((r["page_id"], r["digest"]))
            shard.add(members[i].as_py() if first is None else
                      _member(page_record(r["page_id"], r["url"], b"", r["digest"], r["size"], first), level))
        shard.close()
        return pa.Table.from_batches([_listed(shard.done)])
    return run


def _listed(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), _MANIFEST.types)], schema=_MANIFEST)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every gzip member of a stream."""
    data, part = b"", []
    inflate = zlib.decompressobj(31)
    while data or (data := stream.read(1 << 18)):
        part.append(inflate.decompress(data))
        data = inflate.unused_data
        if inflate.eof:
            head, _, rest = b"".join(part).partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines)
            size = int(headers["Content-Length"])
            if version != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
                raise ValueError("broken WARC record")
            yield headers, rest[:size]
            part, inflate = [], zlib.decompressobj(31)
    if part:
        raise ValueError("truncated WARC file")


_PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read(uri: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(uri)

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _PAGES.types)], schema=_PAGES)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for h, block in records(stream):
                        kind = h["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        if h["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
                            raise ValueError(f"block digest differs in {name}")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"payload digest differs in {name}")
                        page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page")
                        rows.append((int(page) if page else None, h["WARC-Target-URI"], size, digest, kind, int(refers) if refers else None,
                                     payload if payloads and kind == "response" else None))
                        held += len(payload)
                        if len(rows) >= 5000 or held > 1 << 24:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)
    return run


def write_archive(pages: DataFrame, uri: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, level: int = LEVEL) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files under ``uri`` and return the manifest as written there.

    ``uri`` is a folder on storage that all executors share, by a scheme that
    pyarrow opens.  Null html is an empty payload, a null url is named after
    the page, a null page_id is written first and never referred to.  Of equal
    payloads of at least 100 bytes the smallest page_id is a response and the
    others revisit it; repeated rows of that id are each a response.  Other
    columns are ignored; an empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    html = text_of("html")
    own = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"),
                       F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    narrow = cut_lineage(own.select("page_id", "digest", "size"))
    ranked, _, _ = positions(narrow, ["page_id", "digest"], "size")
    groups = narrow.where(F.col("size") >= LEAST_REVISIT).groupBy("digest", "size").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    revisits = narrow.join(groups, "digest").where("page_id is null or page_id != first").select("page_id", "digest", "first").distinct()
    firsts = ranked.groupBy(F.expr(f"before div {shard_bytes}").alias("shard")).agg(F.min("page_id").alias("start")).where(
        "start is not null").select("start").distinct().orderBy("start").collect()  # one id for each shard_bytes of payload
    starts = spark.sparkContext.broadcast(np.array([r["start"] for r in firsts], np.int64))
    members = own.select("page_id", "url", "digest", "size", F.col("html").cast("binary").alias("html")).mapInArrow(
        _responses(level, starts), "shard long, page_id long, url string, digest string, size long, member binary")
    placed = revisits.mapInArrow(_placed(starts), "shard long, page_id long, digest string, first long")
    store, folder = fs.FileSystem.from_uri(uri)
    store.create_dir(folder, recursive=True)
    # one shuffle of the pages, as compressed records; a group is a shard
    written = members.groupBy("shard").cogroup(placed.groupBy("shard")).applyInArrow(
        _write(uri, roll_bytes, level), "file string, shard long, records long, bytes long, sha256 string")
    written.write.mode("overwrite").parquet(f"{uri}/manifest")
    return spark.read.parquet(f"{uri}/manifest")


def read_archive(spark: SparkSession, uri: str, payloads: bool = True) -> DataFrame:
    """Pages of the files that the manifest names; digests and lengths are checked while reading."""
    manifest = spark.read.parquet(f"{uri}/manifest")
    ddl = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    tasks = max(1, min(manifest.count(), MAX_READERS))
    return manifest.select("file").repartition(tasks).mapInArrow(_read(uri, payloads), ddl)


def as_uri(path: str) -> str:
    return path if re.match(r"[a-z][a-z0-9+.-]*:/", path) else "file://" + path


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC files to the shared folder and read back."""
    uri = as_uri(scratch_path(spark, "warc"))
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    write_archive(read_table(spark, sf_dir, "pages"), uri)
    return read_archive(spark, uri, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

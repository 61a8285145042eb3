"""WARC archives: writing, normalising and reading.

Many tools leave archives that are one gzip stream over the whole file, in which no record can be reached without inflating all before
it. The normaliser inflates such a stream once, piece by piece, writes every record as a gzip member of its own and puts
an index of offsets beside the file, so that a reader can go straight to a record.

Archives live in the shared folder, each written by one task under a name of its own attempt; only names that a
finished task has reported count, so a lost executor or a second attempt leaves no half record behind.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabeval.llm.frames import arrow_map, picked, written
from tabeval.session import scratch_path

LEAST_SHARED = 100  # bytes; equal payloads of fewer bytes are stored again
FILE_BYTES = 64 << 20  # of records, before an archive is closed and the next one begun
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"  # archives repeat to the byte unless the caller names a date


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """A whole record. A revisit has no block; its headers describe the payload it stands for."""
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url else []), f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if kind == "revisit" else []),
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def headers_of(raw: bytes) -> dict[str, str]:
    first, *rest = raw.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:60]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in rest)}


def planned(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page_id, url, html, digest, size, first): ``first`` is the page whose record holds the payload."""
    rows = picked(pages, page_id=key, url=url, html=html).withColumn("payload", F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")))
    rows = rows.select("page_id", "url", "payload", F.sha2("payload", 256).alias("digest"), F.length("payload").cast("bigint").alias("size"))
    firsts = rows.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(firsts, "digest", "left")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """Write a record per page into archives that are one gzip stream each; returns their paths (path, records)."""
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        sink = packer = None
        made, count, filled = 0, 0, 0

        def closed() -> pa.RecordBatch:
            sink.write(packer.flush())
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], schema=schema)

        for batch in batches:
            for page, link, payload, digest, size, first in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "size", "first"))):
                page, first = page.as_py(), first.as_py()
                again = first is not None and page is not None and page != first
                if sink is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.gz"
                    sink, packer = system.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
                    made, count, filled = made + 1, 0, 0
                raw = record("revisit" if again else "response", page, link.as_py(), b"" if again else payload.as_py(), digest.as_py(), size.as_py(), first if again else None, date)
                sink.write(packer.compress(raw))
                count, filled = count + 1, filled + len(raw)
                if filled >= FILE_BYTES:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    return written(planned(pages, key, url, html).mapInArrow(run, "path string, records bigint"), "archives")


def inflated(source) -> Iterator[bytes]:
    """The content of a gzip file, one stream or many, in pieces."""
    engine, data = zlib.decompressobj(31), source.read(CHUNK)
    begun = False  # within a member
    while data:
        begun = True
        if piece := engine.decompress(data, CHUNK):
            yield piece
        if engine.eof:
            data = engine.unused_data or source.read(CHUNK)
            engine, begun = zlib.decompressobj(31), False
        else:
            data = engine.unconsumed_tail or source.read(CHUNK)
    if begun:
        yield engine.flush()
        if not engine.eof:
            raise ValueError("the gzip stream ends within a member")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, Iterator[bytes]]]:
    """(raw headers, pieces of the block) of every record; the block must be used up before the next record."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, b"")
        held.extend(piece)
        return bool(piece)

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if bytes(held).strip():
                    raise ValueError("the archive ends within a record's headers")
                return
        raw = bytes(held[:end])
        del held[: end + 4]
        left = int(headers_of(raw)["content-length"])

        def block(left: int = left) -> Iterator[bytes]:
            while left:
                if not held and not more():
                    raise ValueError("the archive ends within a record")
                part = bytes(held[:left])
                del held[: len(part)]
                left -= len(part)
                yield part
            while len(held) < 4:
                if not more():
                    raise ValueError("the archive ends within a record")
            del held[:4]

        yield raw, block()


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive of (path) with one gzip member per record and an index beside it: (path, index, records).

    An index line is JSON with offset, length, record id and type. Memory: one piece of a stream, whatever the record.
    """

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        attempt = TaskContext.get().taskAttemptId()
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        for path in batch.column("path").to_pylist():
            name = f"{path.rpartition('/')[2].removesuffix('.warc.gz')}-{attempt}"
            theirs, place = opened(path)
            lines = []
            with theirs.open_input_stream(place, compression=None) as source, system.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as sink:
                for raw, block in split_records(inflated(source)):
                    start, packer = sink.tell(), zlib.compressobj(6, zlib.DEFLATED, 31)
                    sink.write(packer.compress(raw + b"\r\n\r\n"))
                    for part in block:
                        sink.write(packer.compress(part))
                    sink.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    named = headers_of(raw)
                    lines.append(json.dumps({"offset": start, "length": sink.tell() - start, "id": named.get("warc-record-id"), "type": named.get("warc-type")}))
            with system.open_output_stream(f"{base}/{name}.idx", compression=None) as index:
                index.write("".join(line + "\n" for line in lines).encode())
            yield {"path": [f"{folder}/{name}.warc.gz"], "index": [f"{folder}/{name}.idx"], "records": [len(lines)]}

    # a stated number of tasks: rows as short as these would otherwise be put together in one
    spread = archives.select("path").repartition(max(1, archives.count()), F.col("path"))
    return written(arrow_map(spread, step, "path string, index string, records bigint"), "normalised")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of (path, index), each reached through its offset: page_id, payload (null for a revisit), payload_bytes,
    payload_digest, record_type, refers_to. A response's digest and length are taken from its payload."""

    def number(value: str | None) -> int | None:
        digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        names = ("page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
        for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist()):
            (system, place), (_, lines) = opened(path), opened(index)
            with system.open_input_stream(lines, compression=None) as source:
                entries = [json.loads(line) for line in source.read().splitlines()]
            rows: list[tuple] = []
            with system.open_input_file(place) as source:
                held = 0
                for entry in entries:
                    source.seek(entry["offset"])
                    raw = zlib.decompress(source.read(entry["length"]), 31)
                    head, _, rest = raw.partition(b"\r\n\r\n")
                    named = headers_of(head)
                    payload = rest[: int(named["content-length"])]
                    if named["warc-type"] == "revisit":
                        rows.append((number(named["warc-record-id"]), None, int(named["x-payload-length"]), named["warc-payload-digest"].removeprefix("sha256:"), "revisit", number(named["warc-refers-to"])))
                    else:
                        rows.append((number(named["warc-record-id"]), payload, len(payload), hashlib.sha256(payload).hexdigest(), named["warc-type"], None))
                    held += len(payload)
                    if held > 16 * CHUNK or len(rows) >= 5000:
                        yield dict(zip(names, map(list, zip(*rows))))
                        rows, held = [], 0
            if rows:
                yield dict(zip(names, map(list, zip(*rows))))

    spread = archives.select("path", "index").repartition(max(1, archives.count()), F.col("path"))
    return arrow_map(spread, step, "page_id bigint, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages, normalise the archives and read them back: one row per record, as ``read_archives`` gives it.

    Of records with equal payloads of at least LEAST_SHARED bytes, the one of the smallest key is a response and the others revisit it.
    Defined cases: null html is an empty payload; a null url has no target header; a null key is a response of its own with a
    null key; repeated rows of a response's key are responses too; an empty table gives no archives and no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    loose = write_archives(pages, f"{folder}/loose", key, url, html)
    return read_archives(normalise(loose, f"{folder}/members"))

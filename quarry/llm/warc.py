"""WARC archives with a two-level capture index.

Records are written as gzip members of their own, by as many tasks as there are partitions, one file for each task.
A capture is a record's place: file, offset, length. Captures are sorted by their URL key (the host reversed by its
parts, then the rest of the URL), dealt by ranges, and packed into compressed blocks of ``BLOCK_LINES``; each task
writes one index file, and beside it a sparse directory with the first key of each block.

A lookup finds the index files whose range holds the key, finds the blocks in their directory by binary search, reads
the blocks' byte ranges, finds the captures in them by binary search, and reads the records' byte ranges. Keys are dealt
by index file, so each task holds one directory at a time, and then by block, so the captures of one key, however many,
are read by many tasks; each gives its records on at a bound of rows and bytes. What the driver holds is one row for each
index file.

Files are written and read through ``pyarrow.fs``, by the scheme of the folder. Each task writes under a new name, and
only files that its finished rows name are ever read, so a task that is lost or run twice leaves no wrong record.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes (by SHA-1 and length) that with the largest page id
is a response and the others revisit it (repeated rows with that id are each a response); smaller ones are all
responses. Null payloads are empty, null URLs have the key ``)``. Repeated rows are records of their own. Empty tables
give an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BATCH_BYTES, arrow_map
from quarry.session import materialise, scratch_path

REVISIT_BYTES = 1000
BLOCK_LINES = 256
OPEN_FILES = 16
FOUND_ROWS = 512  # of a lookup's batch
DATE = "2000-01-01T00:00:00Z"  # pages carry no date of capture


def url_key(url: Column) -> Column:
    """The host's parts reversed, then the rest without fragment: ``com,example,www)/path?query``."""
    plain = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", "%20")
    host = F.lower(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", ""), "#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def decide(pages: DataFrame, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    """Each page with its payload's digest and, for a revisit, the page it refers to."""
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit(""))
    records = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    first = records.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "bytes")
    first = first.agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies")).filter("copies > 1")
    return records.join(first, ["digest", "bytes"], "left").select(
        "page_id", "url", "payload", "digest", "bytes", "first_id", url_key(F.col("url")).alias("key"), "copies"
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP header only."""
    target = re.sub(r"[\x00-\x20\x7f]", "%20", url or "urn:x-unknown")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-Id: {'' if refers_to is None else refers_to}")
    else:
        block += payload
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _header(data: bytes) -> tuple[str, dict[str, str], bytes]:
    head, _, body = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    return first, dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines), body


def parse(data: bytes, with_payload: bool = True) -> dict:
    """What a record says; its payload must have the digest that it names."""
    version, fields, rest = _header(data)
    block = rest[: int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    _, http, payload = _header(block)
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError("the payload differs from its digest")
    number = lambda text: int(text) if text else None
    found = {
        "page_id": number(fields["X-Page-Id"]),
        "url": fields["WARC-Target-URI"],
        "record_type": kind,
        "payload_bytes": int(http["Content-Length"]),
        "payload_digest": digest,
        "refers_to": number(fields.get("X-Refers-To-Page-Id", "")),
    }
    if with_payload:
        found["payload"] = payload if kind == "response" else None
    return found


def gathered(records: Iterable[dict], rows: int = FOUND_ROWS, size: int = BATCH_BYTES) -> Iterator[list[dict]]:
    """The records in lists that end at so many rows, or when their payloads have so many bytes."""
    found, held = [], 0
    for one in records:
        found.append(one)
        held += len(one.get("payload") or b"")
        if len(found) >= rows or held >= size:
            yield found
            found, held = [], 0
    if found:
        yield found


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the records of ``decide``; the captures ``key, page_id, file, offset, length``, written and read back."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        path, sink, offset = f"{base}/warc-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            if sink is None:
                files.create_dir(base, recursive=True)
                sink = files.open_output_stream(path, compression=None)
            places, lengths = [], []
            for row in batch.to_pylist():
                payload = row["payload"].encode()
                packed = gzip.compress(record(row["page_id"], row["url"], payload, row["digest"], row["first_id"], row["revisit"]), 6, mtime=0)
                sink.write(packed)
                places.append(offset)
                lengths.append(len(packed))
                offset += len(packed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("page_id"), pa.array([path] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(lengths, pa.int64())],
                names=["key", "page_id", "file", "offset", "length"],
            )
        if sink is not None:
            sink.close()

    written = records.transform(arrow_map, run, "key string, page_id long, file string, offset long, length long")
    return materialise(written, "captures")


def write_index(captures: DataFrame, folder: str) -> list[dict]:
    """Writes the index; its files with their first and last key, in the order of the keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        path, sink, offset, directory, lines, last = f"{base}/index-{uuid.uuid4().hex}", None, 0, [], [], None

        def flush() -> None:
            nonlocal offset, lines
            packed = gzip.compress("\n".join(json.dumps(line) for line in lines).encode(), 6, mtime=0)
            sink.write(packed)
            directory.append([lines[0][0], offset, len(packed)])
            offset, lines = offset + len(packed), []

        for batch in batches:
            if sink is None:
                files.create_dir(base, recursive=True)
                sink = files.open_output_stream(f"{path}.gz", compression=None)
            for row in batch.to_pylist():
                lines.append([row["key"], row["page_id"], row["file"], row["offset"], row["length"]])
                last = row["key"]
                if len(lines) == BLOCK_LINES:
                    flush()
        if sink is None:
            return
        if lines:
            flush()
        sink.close()
        with files.open_output_stream(f"{path}.directory.gz", compression="gzip") as out:
            out.write(json.dumps(directory).encode())
        if directory:
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([directory[0][0]]), pa.array([last])], names=["path", "first", "last"]
            )

    order = ["key", "page_id", "file", "offset"]
    parts = captures.repartitionByRange(*order).sortWithinPartitions(*order).transform(arrow_map, run, "path string, first string, last string")
    # one row for each task of the range exchange
    return sorted((r.asDict() for r in parts.collect()), key=lambda r: (r["first"], r["last"]))


def lookup(keys: DataFrame, index: list[dict], folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the distinct ``key``s, read from the archives by way of the index."""
    firsts, lasts, paths = ([part[n] for part in index] for n in ("first", "last", "path"))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, key = [], []
            for wanted in batch.column("key").to_pylist():
                for at in range(bisect_left(lasts, wanted), bisect_right(firsts, wanted)):
                    part.append(at)
                    key.append(wanted)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(key, pa.string())], names=["part", "key"])

    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    schema += ", payload binary" * with_payload
    arrow = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
        + [("payload", pa.binary())] * with_payload
    )

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pafs.FileSystem.from_uri(folder)
        part, directory, starts = None, [], []

        def places(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal part, directory, starts
            for at, wanted in zip(batch.column("part").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if at != part:
                    with files.open_input_stream(f"{paths[at]}.directory.gz", compression="gzip") as source:
                        directory = json.loads(source.read())
                    part, starts = at, [entry[0] for entry in directory]
                # a key may begin in the block before the first that starts with it
                for number in range(max(0, bisect_left(starts, wanted) - 1), bisect_right(starts, wanted)):
                    yield {"part": at, "at": directory[number][1], "length": directory[number][2], "key": wanted}

        for batch in batches:
            for found in gathered(places(batch)):
                yield pa.RecordBatch.from_pylist(found, schema=placed)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pafs.FileSystem.from_uri(folder)
        handles: dict[str, pa.NativeFile] = {}
        last, block, own = None, [], []

        def piece(path: str, offset: int, length: int) -> bytes:
            if path not in handles:
                if len(handles) >= OPEN_FILES:
                    handles.pop(next(iter(handles))).close()
                handles[path] = files.open_input_file(path)
            return gzip.decompress(handles[path].read_at(length, offset))

        def records(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal last, block, own
            for part, at, length, wanted in zip(*[batch.column(c).to_pylist() for c in placed.names], strict=True):
                if (part, at) != last:
                    text = piece(f"{paths[part]}.gz", at, length).decode()
                    last, block = (part, at), [json.loads(line) for line in text.split("\n")]
                    own = [line[0] for line in block]
                for line in block[bisect_left(own, wanted) : bisect_right(own, wanted)]:
                    yield parse(piece(*line[2:]), with_payload)

        for batch in batches:
            for found in gathered(records(batch)):
                yield pa.RecordBatch.from_pylist([{n: f[n] for n in names} for f in found], schema=arrow)
        for handle in handles.values():
            handle.close()

    placed = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("length", pa.int64()), ("key", pa.string())])
    dealt = keys.select("key").distinct().transform(arrow_map, route, "part int, key string")
    dealt = dealt.repartitionByRange("part", "key").sortWithinPartitions("part", "key")
    dealt = dealt.transform(arrow_map, blocks, "part int, at long, length long, key string")
    # a number of partitions, as adaptive execution would put the small rows of many blocks into one
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartitionByRange(tasks, "part", "at", "key").sortWithinPartitions("part", "at", "key")
    return dealt.transform(arrow_map, read, schema)


def archive(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html"
) -> tuple[DataFrame, list[dict], str]:
    """Writes archives and index of all pages: the captures, the index and the folder."""
    folder = scratch_path(pages.sparkSession, "warc")
    largest = F.col("page_id").eqNullSafe(F.col("first_id"))
    records = decide(pages, id_column, url_column, payload_column)
    captures = write_archives(records.withColumn("revisit", F.col("copies").isNotNull() & ~largest), folder)
    return captures, write_index(captures, folder), folder

"""Exact deduplication by Grace hashing.

Spark's shuffle deals the records into buckets by a hash of their content. A bucket is resolved by one
open-addressing table that compares complete contents. When a bucket does not fit the memory set for it, the
contents that found no place go to spill files, dealt by another hash, and each file is resolved in the same
way, recursively. Spill files lie in Spark's own spill folder of the executor and go with the task.

Copies are collapsed in every task before the shuffle by a table of the same kind, so that a content held by
any share of all rows reaches its bucket as one entry for each task, and its rows never meet in one place.

Texts are equal when identical after each run of ASCII white space became one space; null counts as empty. Of
equal texts the row with the smallest id stays (a null id counts as largest; of repeated rows with that id, one
stays). Empty tables give empty results; other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, blobs, carried, row_numbers
from quarry.session import materialise

#: Bytes of content that a table holds before it is flushed (before the shuffle) or spills (after it).
LOCAL_BYTES = 12 << 20
BUCKET_BYTES = 64 << 20
SPILL_FILES = 16
LAST = 1 << 63  # stands for a null id when ids are compared


def normalised(data: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    body = b" ".join(data.split())
    if not body:
        return b" " if data else b""
    return b" " * data[:1].isspace() + body + b" " * data[-1:].isspace()


class ContentTable:
    """Open addressing with linear probing. A slot names an entry; a hit needs equal hash and equal content."""

    def __init__(self, capacity: int = 1 << 10):
        self.slots = np.full(capacity, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def _slot(self, digest: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = digest & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == digest and self.contents[entry] == content:
                break
            at = (at + 1) & mask
        return at

    def find(self, digest: int, content: bytes) -> int:
        """The entry with this content, or -1."""
        return int(self.slots[self._slot(digest, content)])

    def add(self, digest: int, content: bytes) -> int:
        if 2 * (len(self.contents) + 1) > len(self.slots):
            self._grow()
        entry = len(self.contents)
        self.slots[self._slot(digest, content)] = entry
        self.hashes.append(digest)
        self.contents.append(content)
        self.bytes += len(content)
        return entry

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.hashes):
            at = digest & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _rank(value: int | None) -> int:
    return LAST if value is None else value


def _collapse(limit: int):
    """Before the shuffle: a member for each row and an entry for each content of the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, names = row_numbers(), row_numbers()
        table, entries, held = ContentTable(), [], []  # entry: [name, hash, id, number, rows, batch, row]

        def flush(schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            by_batch: dict[int, list[list]] = {}
            for entry in entries:
                by_batch.setdefault(entry[5], []).append(entry)
            for at, found in by_batch.items():
                rows = held[at].take(pa.array([e[6] for e in found]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([e[0] for e in found], pa.int64()),
                        pa.array([e[2] for e in found], pa.int64()),
                        pa.array([e[3] for e in found], pa.int64()),
                        pa.array([e[1] - LAST for e in found], pa.int64()),
                        pa.array([e[4] for e in found], pa.int64()),
                        rows.column("text"),
                        rows.column("carried"),
                    ],
                    names=["rep", "id", "number", "hash", "n", "text", "carried"],
                )

        for batch in batches:
            held.append(batch)
            reps, own = [], []
            for row, (identity, data) in enumerate(zip(batch.column("id").to_pylist(), blobs(batch, "text"), strict=True)):
                content, number = normalised(data), next(numbers)
                digest = xxhash.xxh64_intdigest(content)
                at = table.find(digest, content)
                if at < 0:
                    at = table.add(digest, content)
                    entries.append([next(names), digest, identity, number, 0, len(held) - 1, row])
                entry = entries[at]
                entry[4] += 1
                if _rank(identity) < _rank(entry[2]):
                    entry[2], entry[3], entry[5], entry[6] = identity, number, len(held) - 1, row
                reps.append(entry[0])
                own.append(number)
            nothing = len(reps)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(reps, pa.int64()),
                    batch.column("id").cast(pa.int64()),
                    pa.array(own, pa.int64()),
                    pa.nulls(nothing, pa.int64()),
                    pa.nulls(nothing, pa.int64()),
                    pa.nulls(nothing, batch.column("text").type),
                    pa.nulls(nothing, batch.column("carried").type),
                ],
                names=["rep", "id", "number", "hash", "n", "text", "carried"],
            )
            if sum(b.nbytes for b in held) > limit:
                yield from flush(batch.schema)
                table, entries, held = ContentTable(), [], []
        if held:
            yield from flush(held[0].schema)

    return run


def _spill_folder() -> str | None:
    """Where Spark lets this executor's tasks spill."""
    folders = [f for f in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if f and os.path.isdir(f)]
    return folders[0] if folders else None


def _resolve(limit: int, with_rows: bool):
    """After the shuffle: for each entry what stays of its content, from tables over complete contents."""

    def result(table: ContentTable, found: list[list], rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # found, by content: [id, number, rep, rows, reps, row number in rows]
        columns: list[list] = [[] for _ in range(6)]
        for content, (identity, number, rep, n, reps, _) in zip(table.contents, found, strict=True):
            digest = hashlib.sha256(content).hexdigest()
            for each in reps:
                for column, value in zip(columns, (each, identity, number, n, digest, each == rep), strict=True):
                    column.append(value)
        arrays = [
            pa.array(values, kind)
            for values, kind in zip(
                columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True
            )
        ]
        names = ["rep", "keep_id", "keep_number", "group_size", "sha256", "stays"]
        if with_rows and rows:
            # the text and other columns of the row that stays, null in its content's other entries
            own = pa.Table.from_batches(rows).combine_chunks()
            places: list[int | None] = []
            for _, _, rep, _, reps, row in found:
                places += [row if each == rep else None for each in reps]
            taken = own.take(pa.array(places, pa.int64())).combine_chunks()
            for name in ("text", "carried"):
                column = taken.column(name)
                arrays.append(column.chunk(0) if column.num_chunks else pa.nulls(0, column.type))
                names.append(name)
        for at in range(0, len(columns[0]), 4096):
            yield pa.RecordBatch.from_arrays([a.slice(at, 4096) for a in arrays], names=names)

    def bucket(batches: Iterable[pa.RecordBatch], depth: int, folder: str) -> Iterator[pa.RecordBatch]:
        table, found, rows, n_rows = ContentTable(), [], [], 0
        files: dict[int, tuple] = {}
        for batch in batches:
            spilled: dict[int, list[int]] = {}
            taken: list[int] = []
            columns = [batch.column(c).to_pylist() for c in ("rep", "id", "number", "n")]
            for row, (rep, identity, number, n, data) in enumerate(zip(*columns, blobs(batch, "text"), strict=True)):
                content = normalised(data)
                digest = xxhash.xxh64_intdigest(content)
                at = table.find(digest, content)
                if at < 0 and table.bytes >= limit:
                    to = xxhash.xxh64_intdigest(content, seed=depth + 1) % SPILL_FILES
                    spilled.setdefault(to, []).append(row)
                    continue
                if at < 0:
                    at = table.add(digest, content)
                    found.append([identity, number, rep, 0, [], n_rows + len(taken)])
                    taken.append(row)
                entry = found[at]
                entry[3] += n
                entry[4].append(rep)
                if (_rank(identity), number) < (_rank(entry[0]), entry[1]):
                    entry[0], entry[1], entry[2], entry[5] = identity, number, rep, n_rows + len(taken)
                    taken.append(row)
            if with_rows and taken:
                rows.append(batch.select(["text", "carried"]).take(pa.array(sorted(set(taken)))))
                n_rows += len(rows[-1])
            for to, picked in spilled.items():
                if to not in files:
                    path = f"{folder}/{uuid.uuid4().hex}.arrow"
                    files[to] = (path, pa.ipc.new_file(path, batch.schema))
                files[to][1].write_batch(batch.take(pa.array(picked)))
        for _, writer in files.values():
            writer.close()
        yield from result(table, found, rows)
        del table, found, rows
        for path, _ in files.values():
            with pa.ipc.open_file(path) as reader:
                yield from bucket((reader.get_batch(i) for i in range(reader.num_record_batches)), depth + 1, folder)
            os.remove(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(prefix="grace-", dir=_spill_folder()) as folder:
            yield from bucket(batches, 0, folder)

    return run


def exact_groups(
    df: DataFrame, id_column: str, text_column: str, carry: list[str] | None = None, bucket_bytes: int = BUCKET_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Rows and contents of a table.

    The first result has a row for each input row: ``rep, id, number`` (of the row, unique). The second has a row
    for each ``rep`` with ``keep_id, keep_number, group_size, sha256, stays``; with ``carry`` the one entry of each
    content that stays also has the text and a struct of the named columns of its row.
    """
    source = df.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        carried(df, carry or []).alias("carried"),
    )
    kind = source.schema["carried"].dataType.simpleString()
    collapsed = source.transform(
        arrow_map,
        _collapse(LOCAL_BYTES),
        f"rep long, id long, number long, hash long, n long, text string, carried {kind}",
    )
    if carry is None:
        collapsed = materialise(collapsed.drop("carried").withColumn("carried", F.struct(F.lit(None).alias("none"))), "exact")
    entries = collapsed.filter("n is not null")
    schema = "rep long, keep_id long, keep_number long, group_size long, sha256 string, stays boolean"
    resolved = entries.repartition("hash").transform(
        arrow_map,
        _resolve(bucket_bytes, carry is not None),
        schema + (f", text string, carried {kind}" if carry is not None else ""),
    )
    return collapsed.filter("n is null").select("rep", "id", "number"), resolved


def exact_dedup(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each input row: ``id, keep_id, group_size, kept, text_sha256`` (of the normalised text)."""
    rows, contents = exact_groups(df, id_column, text_column)
    return rows.join(contents, "rep").select(
        "id",
        "keep_id",
        "group_size",
        (F.col("number") == F.col("keep_number")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input."""
    others = [c for c in df.columns if c not in (id_column, text_column)]
    _, contents = exact_groups(df, id_column, text_column, carry=[id_column, *others])
    return contents.filter("stays").select(
        *[
            F.col("text").alias(c) if c == text_column else F.col(f"carried.`{c}`").alias(c)
            for c in df.columns
        ]
    )

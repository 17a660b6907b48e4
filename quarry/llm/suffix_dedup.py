"""Removes repeated byte strings, found in a sparse suffix array by bucket-pointer refinement.

Every ``LENGTH``-byte string has a smallest hash among those of its ``GRAM``-byte grams. Suffixes are put into initial
buckets by that gram, one for each stretch of neighbouring strings that share its place (about one position in
seventy), so equal strings are in equal buckets and never in one stretch. A bucket with one stretch is done: none of its strings is repeated. Stretches that
are equal as a whole are repeated as a whole. What is left of a bucket, its different stretches, is refined: their
suffixes are ranked by their first eight bytes, and each bucket of equal ranks is sorted by the rank of the suffix
eight bytes later, the ranks that come out serve as pointers for sixteen bytes, and so on to the full length. A suffix
that is alone in its bucket keeps its rank and is not sorted again. Ranks are of the bytes themselves, so strings are
found equal only if they are. Whole stretches of one bucket are compared by 64 bits of a hash of them.

Spark deals the stretches to their buckets in packed blocks of one row for each task and part. Stretches that are equal
within a task are sent once, so copies that are a third of all rows come as one stretch from each task. A bucket with
many different stretches is refined in chunks, and strings that are alone in their chunk are compared across chunks by
a distributed aggregate of 128 bits of two hashes of them.

Texts of any length are looked at in pieces of ``PIECE`` strings, about 40 bytes of memory for each byte of a piece. A
chunk that is refined takes about 35 bytes for each of its bytes, and is closed before a further bucket exceeds its
bound.

Strings never go across documents. Null texts count as empty. Repeated rows are copies of each other; a null id is an
id. Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, blobs, row_numbers
from quarry.session import materialise

LENGTH = 200  # bytes of a repeated string
GRAM = 64  # bytes of an initial bucket
CHUNK_BYTES = 4 << 20  # refined at once
PIECE = 1 << 20  # strings of a text that are looked at together
PLACE_BITS = np.uint64(21)  # of the place of a gram in a piece
CHUNK_STRETCHES = 8192  # of one bucket
TASK_BYTES = 24 << 20  # of texts whose stretches are packed together
ROWS = 1 << 15  # of a packed block; a row number in it fits 16 bits
LOW48 = np.uint64((1 << 48) - 1)
ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def gram_hashes(codes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """The hash of the gram at each position: hashes of halves are joined, by the binary digits of the size."""
    level, span, whole, done = _mixed(codes.astype(np.uint64) + np.uint64(seed)), 1, None, 0
    while True:
        if size & span:
            if whole is None:
                whole, done = level, span
            else:
                count = len(codes) - done - span + 1
                whole, done = _mixed(whole[:count]) * ODD + level[done : done + count], done + span
        if 2 * span > size:
            return _mixed(whole)
        count = len(codes) - 2 * span + 1
        level, span = _mixed(level[:count]) * ODD + level[span : span + count], 2 * span


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    return np.minimum(values[: len(values) - (size - span)], values[size - span :])


def stretches(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First string, number of strings, and bucket of each stretch of a text.

    The strings of a stretch have their smallest gram at one place (the first of equals), so no two of them are equal.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for begin in range(0, len(data) - length + 1, PIECE):
        hashes = gram_hashes(np.frombuffer(data, np.uint8)[begin : begin + PIECE + length - 1], gram)
        # as many bits for the place in any text: the choice depends on nothing but the string
        placed = hashes >> PLACE_BITS << PLACE_BITS | np.arange(len(hashes), dtype=np.uint64)
        place = window_minima(placed, length - gram + 1) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))
        starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        found.append((starts + begin, np.diff(np.r_[starts, len(place)]), hashes[place[starts].astype(np.int64)]))
    return tuple(np.concatenate(columns) for columns in zip(*found, strict=True))


def repeated_strings(texts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """For each byte of the joined texts, whether the string that begins there begins elsewhere too, within a text.

    Bucket-pointer refinement: see the module's text. Positions and ranks have 32 bits; a round's keys are sorted by one
    index array and freed before the next ones are made.
    """
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    total = int(ends[-1]) if texts else 0
    found = np.zeros(total, bool)
    if not total:
        return found
    codes = np.frombuffer(b"".join(texts) + bytes(length + 8), np.uint8)
    depth, top = 8, 0
    keys = np.zeros(total, np.uint64)
    for at in range(depth):
        keys <<= np.uint64(8)
        keys |= codes[at : at + total]
    del codes
    ranks = np.zeros(total + length, np.uint32)
    active = np.arange(total, dtype=np.uint32)
    while len(active):
        order = np.argsort(keys)
        keys, active = keys[order], active[order]
        del order
        new = np.ones(len(keys) + 1, bool)  # with an end
        np.not_equal(keys[1:], keys[:-1], out=new[1:-1])
        del keys
        bucket = np.cumsum(new[:-1], dtype=np.uint32)
        bucket += np.uint32(top)
        ranks[active] = bucket
        top = int(bucket[-1])
        del bucket
        active = active[~(new[:-1] & new[1:])]
        if depth == length:
            break
        step = min(depth, length - depth)
        depth += step
        if depth == length:
            active = active[ends[np.searchsorted(ends, active, side="right")] - active >= length]
        keys = ranks[active].astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= ranks[active + np.uint32(step)]
    found[active] = True
    return found


PACKED = (("bucket", 6), ("whole", 8), ("row", 2), ("first", 4), ("local", 1), ("count", 1))


def _pack(bucket, whole, row, first, local, count) -> bytes:
    """Stretches by column; ``local`` says that the stretch has copies in its task."""
    cut = lambda values, size: np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()
    return b"".join(cut(v, size) for v, (_, size) in zip((bucket, whole, row, first, local, count - 1), PACKED, strict=True))


def _unpack(data: bytes) -> list[np.ndarray]:
    count, at, found = len(data) // sum(size for _, size in PACKED), 0, []
    for _, size in PACKED:
        values = np.zeros((count, 8), np.uint8)
        values[:, :size] = np.frombuffer(data, np.uint8, count * size, at).reshape(-1, size)
        found.append(values.reshape(-1).view("<u8"))
        at += count * size
    found[-1] = found[-1] + np.uint64(1)
    return found


SPANS = "number long, first long, count long"


def _sample(parts: int):
    """A row for each text, packed stretches for each part, and the stretches found repeated within the task."""
    kinds = {
        "part": pa.int32(), "number": pa.int64(), "id": pa.int64(), "hash": pa.int64(), "n_bytes": pa.int64(),
        "sha256": pa.string(), "data": pa.binary(),
    }

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()], names=list(kinds)
        )

    def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= TASK_BYTES:
                yield held
                held = []
        if held:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_numbers()
        for some in gathered(batches):
            for batch in pa.Table.from_batches(some).combine_chunks().to_batches(ROWS):
                texts = blobs(batch, "text")
                own = [next(numbers) for _ in texts]
                yield rows(
                    number=own, id=batch.column("id"), hash=batch.column("hash"), n_bytes=[len(t) for t in texts],
                    sha256=[hashlib.sha256(t).hexdigest() for t in texts],
                )
                found = [stretches(t) for t in texts]
                if not sum(len(f[0]) for f in found):
                    continue
                row = np.repeat(np.arange(len(texts)), [len(f[0]) for f in found])
                first, count, bucket = (np.concatenate([f[i] for f in found]) for i in range(3))
                digest, ends = xxhash.xxh3_64_intdigest, first + count + LENGTH - 1
                whole = np.array(
                    [digest(texts[r][a:b]) for r, a, b in zip(row.tolist(), first.tolist(), ends.tolist(), strict=True)], np.uint64
                )
                bucket = bucket & LOW48
                order = np.lexsort((whole, bucket))
                row, first, count, bucket, whole = (x[order] for x in (row, first, count, bucket, whole))
                new = np.r_[True, (bucket[1:] != bucket[:-1]) | (whole[1:] != whole[:-1])]
                copies = np.diff(np.r_[np.flatnonzero(new), len(new)])
                again = np.repeat(copies > 1, copies)
                if again.any():
                    yield rows(
                        part=[-1], number=[own[0]],
                        data=[_pack(bucket[again], whole[again], row[again], first[again], again[again], count[again])],
                    )
                row, first, count, bucket, whole, again = (x[new] for x in (row, first, count, bucket, whole, again))
                to = (bucket % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                cuts = np.flatnonzero(np.r_[True, np.diff(to[order]) > 0])
                packed = [
                    _pack(*(x[o] for x in (bucket, whole, row, first, again, count))) for o in np.split(order, cuts[1:])
                ]
                yield rows(part=to[order][cuts], number=[own[0]] * len(packed), data=packed)

    return run, "part int, number long, id long, hash long, n_bytes long, sha256 string, data binary"


ACTIONS = SPANS + ", repeated boolean, bucket long, chunks int"


def _actions(chunk_stretches: int):
    """Of each part: the stretches that are repeated as a whole, and those that must be refined (with ``chunks``)."""


    def rows(number, first, count, repeated, bucket, chunks) -> Iterator[pa.RecordBatch]:
        columns = [
            (number, pa.int64()), (first.astype(np.int64), pa.int64()), (count.astype(np.int64), pa.int64()),
            (repeated, pa.bool_()), (bucket.astype(np.int64), pa.int64()), (chunks.astype(np.int32), pa.int32()),
        ]
        names = ["number", "first", "count", "repeated", "bucket", "chunks"]
        for at in range(0, len(number), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(v[at : at + (1 << 16)], k) for v, k in columns], names=names)

    def result(held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        blocks = [_unpack(data) for _, data in held]
        number = np.concatenate([base + b[2].astype(np.int64) for (base, _), b in zip(held, blocks, strict=True)])
        bucket, whole, first, local, count = (np.concatenate([b[i] for b in blocks]) for i in (0, 1, 3, 4, 5))
        local = local > 0
        order = np.lexsort((whole, bucket))
        number, bucket, whole, first, count, local = (x[order] for x in (number, bucket, whole, first, count, local))
        edge = np.r_[True, bucket[1:] != bucket[:-1]]
        new = edge | np.r_[True, whole[1:] != whole[:-1]]
        copies = np.diff(np.r_[np.flatnonzero(new), len(new)])
        # a stretch that is repeated in its own task has been noted there
        again = np.repeat(copies > 1, copies)
        kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(edge))
        sizes = np.diff(np.r_[np.flatnonzero(edge), len(edge)])
        different = np.repeat(kinds, sizes)
        chunks = np.where(new & (different > 1), -(-different // chunk_stretches), 0)
        out = (again & ~local) | (chunks > 0)
        yield from rows(number[out], first[out], count[out], (again | local)[out], bucket[out], chunks[out])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for to, base, data in zip(*(batch.column(c).to_pylist() for c in ("part", "number", "data")), strict=True):
                if to == -1:
                    bucket, _, row, first, _, count = _unpack(data)
                    yield from rows(base + row.astype(np.int64), first, count, np.ones(len(row), bool), bucket, np.zeros(len(row)))
                    continue
                if to != part and held:
                    yield from result(held)
                    held = []
                part = to
                held.append((base, data))
        if held:
            yield from result(held)

    return run


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each affected text: the text with its known spans, and the bytes of the stretches to refine."""
    kinds = {
        "id": pa.int64(), "hash": pa.int64(), "text": pa.binary(), "spans": pa.binary(), "bucket": pa.int64(),
        "chunk": pa.int32(), "chunks": pa.int32(), "first": pa.int64(), "stretch": pa.binary(),
    }

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()], names=list(kinds)
        )

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            texts, spans, cut = blobs(some, "text"), [], {c: [] for c in ("id", "hash", "bucket", "chunk", "chunks", "first", "stretch")}
            ids, hashes = some.column("id").to_pylist(), some.column("hash").to_pylist()
            for text, identity, hashed, actions in zip(texts, ids, hashes, some.column("actions").to_pylist(), strict=True):
                known = [(a["first"], a["count"]) for a in actions if a["repeated"]]
                spans.append(np.array(known, "<i8").tobytes())
                for a in actions:
                    if a["chunks"]:
                        stretch = text[a["first"] : a["first"] + a["count"] + LENGTH - 1]
                        values = (identity, hashed, a["bucket"], xxhash.xxh32_intdigest(stretch) % a["chunks"], a["chunks"], a["first"], stretch)
                        for name, value in zip(cut, values, strict=True):
                            cut[name].append(value)
            yield rows(id=ids, hash=hashes, text=texts, spans=spans)
            if cut["id"]:
                yield rows(**cut)


def _refine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of whole buckets (or chunks of them): runs of repeated strings, and strings to compare across chunks."""
    names = ["id", "hash", "first", "count", "bucket", "one", "other"]

    def rows(*columns) -> Iterator[pa.RecordBatch]:
        n = len(columns[0])
        arrays = [pa.nulls(n, pa.int64()) if c is None else pa.array(c.astype(np.int64), pa.int64()) for c in columns]
        whole = pa.RecordBatch.from_arrays(arrays, names=names)
        for at in range(0, n, 1 << 16):
            yield whole.slice(at, 1 << 16)

    def strings(some: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Two hashes of each string of these stretches."""
        codes = np.frombuffer(b"".join(h[6] for h in some), np.uint8)
        sizes = np.array([len(h[6]) for h in some])
        counts, starts = sizes - LENGTH + 1, np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(some)), counts)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[row] + inside
        one, other = (gram_hashes(codes, LENGTH, seed)[at].view(np.int64) for seed in (1, 0x51ED27))
        bucket, identity, hashed, first = (np.array([h[i] for h in some], np.int64)[row] for i in (0, 3, 4, 5))
        yield from rows(identity, hashed, first + inside, np.ones(len(row), np.int64), bucket, one, other)

    def result(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = repeated_strings([h[6] for h in held])
        starts = np.cumsum([0] + [len(h[6]) for h in held])
        # no string begins in the last bytes of a stretch, so no run goes on into the next one
        edges = np.flatnonzero(np.diff(np.r_[False, found, False]))
        del found
        a, b = edges[::2], edges[1::2]
        row = np.searchsorted(starts, a, side="right") - 1
        identity, hashed, first = (np.array([h[i] for h in held], np.int64)[row] for i in (3, 4, 5))
        yield from rows(identity, hashed, first + a - starts[row], b - a, None, None, None)
        some, size = [], 0
        for h in held:
            if h[2] > 1:
                some.append(h)
                size += len(h[6])
                if size >= CHUNK_BYTES // 16:
                    yield from strings(some)
                    some, size = [], 0
        if some:
            yield from strings(some)

    done, size, group, current, last = [], 0, None, 0, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "chunk", "chunks", "id", "hash", "first", "stretch")]
        for row in zip(*columns, strict=True):
            if row[:2] != group:
                done.extend(last)
                size += current
                group, last, current = row[:2], [], 0
            last.append(row)
            current += len(row[6])
            if done and size + current > CHUNK_BYTES:
                yield from result(done)
                done, size = [], 0
    done.extend(last)
    if done:
        yield from result(done)


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of bytes that the spans (first string, number of strings) cover."""
    if not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    begins, ends = spans[:, 0], np.maximum.accumulate(spans[:, 0] + spans[:, 1] + LENGTH - 1)
    new = np.r_[True, begins[1:] > ends[:-1]]
    return begins[new], ends[np.r_[new[1:], True]]


def _remove(with_kept: bool):
    names = ["id", "hash", "n_removed", "n_spans", "kept_sha256", "kept"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            rows = zip(*(batch.column(c).to_pylist() for c in ("id", "hash", "text", "spans", "found")), strict=True)
            for identity, hashed, text, known, found in rows:
                spans = np.frombuffer(known, "<i8").reshape(-1, 2)
                if found:
                    spans = np.concatenate([spans, np.array([(f["first"], f["count"]) for f in found], np.int64)])
                begins, ends = merged(spans)
                digest, kept, view = hashlib.sha256(), [], memoryview(text)
                for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(text)], strict=True):
                    digest.update(view[a:b])
                    if with_kept:
                        kept.append(view[a:b])
                values = (
                    identity, hashed, int((ends - begins).sum()), len(begins), digest.hexdigest(),
                    b"".join(kept) if with_kept else None,
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def remove_repeats(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    parts: int | None = None,
    chunk_stretches: int = CHUNK_STRETCHES,
    with_kept: bool = False,
) -> DataFrame:
    """A row for each input row: ``id, n_bytes, n_removed, n_spans, kept_sha256``; with ``with_kept`` the bytes as well.

    ``kept`` is null where nothing was removed. ``parts``: into how many parts the buckets are dealt, four times the
    session's shuffle partitions by default.
    """
    spark = df.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text, identity = F.col(f"`{text_column}`").cast("string"), F.col(f"`{id_column}`").cast("long")
    # rows that have the same key have the same id and text, and so the same result
    docs = df.select(identity.alias("id"), F.xxhash64(text, identity.isNull()).alias("hash"), text.alias("text"))
    run, schema = _sample(parts)
    sample = materialise(docs.transform(arrow_map, run, schema), "suffixes")
    rows = sample.filter("data is null").select("number", F.coalesce("id", F.lit(0)).alias("id"), F.col("id").alias("own_id"), "hash", "n_bytes", "sha256")
    blocks = sample.filter("data is not null").select("part", "number", "data")
    # what was found in a task goes where its rows are many; the parts go each to one task
    actions = (
        blocks.repartition("part", F.when(F.col("part") < 0, F.col("number")))
        .sortWithinPartitions("part")
        .transform(arrow_map, _actions(chunk_stretches), ACTIONS)
    )
    by_row = actions.groupBy("number").agg(F.collect_list(F.struct("first", "count", "repeated", "bucket", "chunks")).alias("actions"))
    keyed = by_row.join(rows.select("number", "id", "hash"), "number").groupBy("id", "hash")
    keyed = keyed.agg(F.flatten(F.collect_set("actions")).alias("actions"))
    keyed = materialise(keyed, "suffixes")
    affected = docs.withColumn("id", F.coalesce("id", F.lit(0))).join(keyed, ["id", "hash"])
    cut = materialise(
        affected.transform(
            arrow_map,
            _cut,
            "id long, hash long, text binary, spans binary, bucket long, chunk int, chunks int, first long, stretch binary",
        ),
        "suffixes",
    )
    refined = materialise(
        cut.filter("stretch is not null")
        .select("bucket", "chunk", "chunks", "id", "hash", "first", "stretch")
        .repartition("bucket", "chunk")
        .sortWithinPartitions("bucket", "chunk")
        .transform(arrow_map, _refine, "id long, hash long, first long, count long, bucket long, one long, other long"),
        "suffixes",
    )
    single = refined.filter("one is not null")
    key = ["bucket", "one", "other"]
    several = single.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    across = single.join(several, key, "left_semi").select("id", "hash", "first", "count")
    found = refined.filter("one is null").select("id", "hash", "first", "count").union(across)
    found = found.groupBy("id", "hash").agg(F.collect_list(F.struct("first", "count")).alias("found"))
    texts = cut.filter("text is not null").select("id", "hash", "text", "spans")
    removed = texts.join(found, ["id", "hash"], "left").transform(
        arrow_map,
        _remove(with_kept), "id long, hash long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    # repeated rows have one key and one result
    removed = (removed if with_kept else removed.drop("kept")).dropDuplicates(["id", "hash"])
    results = rows.join(removed, ["id", "hash"], "left")
    return results.select(
        F.col("own_id").alias("id"),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        *(["kept"] if with_kept else []),
    )

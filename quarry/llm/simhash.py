"""Near-duplicates by SimHash with covering locality-sensitive hashing.

A fingerprint has 64 bits: bit b is 1 if it is set in more than half of the XXH64 values (seed 42) of the text's
word shingles. Fingerprints at ``radius`` or fewer differing bits are linked.

Covering tables (Pagh, "Locality-sensitive hashing without false negatives"): every bit position gets a vector of
radius + 1 bits; table v keeps the bits whose vector has an odd product with v. The vectors of up to ``radius``
differing bits leave some v orthogonal to all of them, so every linked pair agrees in all bits that one of the
2^(radius+1) - 1 tables keeps: no link is missed.

Equal fingerprints are reduced to one before the tables. A bucket holds distinct fingerprints that differ only in
the bits its table drops. A bucket beyond ``BUCKET_ROWS`` is dealt again by covering tables over those dropped
bits; each level halves them, so the last buckets are small by nature and none is cut. Each bucket gives a
spanning forest of its links, not all pairs.

Null and empty texts have fingerprint zero and are linked like any other. Null ids count as largest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, blobs, carried, row_numbers
from quarry.llm.components import components
from quarry.session import materialise

BUCKET_ROWS = 2048
BLOCK = 1 << 16  # shingles hashed at once


def simhash(data: bytes, width: int = 4, seed: int = 42) -> int:
    """The fingerprint of a UTF-8 text; A-Z are lower-cased, words end at ASCII white space."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) < width:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, total, BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # 255 rows at a time fit the bytes of a word
        sums = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(hashes), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int, seed: int, column: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_numbers()
        for batch in batches:
            found = np.array([simhash(b, width, seed) for b in blobs(batch, column)], np.uint64).view(np.int64)
            own = [next(numbers) for _ in range(len(found))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(own, pa.int64()), pa.array(found, pa.int64()), batch.column("carried")],
                names=["id", "number", "fp", "carried"],
            )

    return run


def fingerprints(
    df: DataFrame, id_column: str, text_column: str, width: int = 4, seed: int = 42, carry: list[str] | None = None
) -> DataFrame:
    """``id, number, fp, carried`` for each row; number is unique, fp the 64 bits as a signed long."""
    carry = carry or []
    source = df.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        carried(df, carry).alias("carried"),
        *([] if text_column in carry else [F.col(f"`{text_column}`").alias(text_column)]),
    )
    kind = source.schema["carried"].dataType.simpleString()
    return source.transform(arrow_map, _fingerprints(width, seed, text_column), f"id long, number long, fp long, carried {kind}")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """For each table the bits that it keeps of the given positions."""
    tables = (1 << (radius + 1)) - 1
    vectors = {p: 1 + i % tables for i, p in enumerate(positions)}
    return [
        sum(1 << p for p, vector in vectors.items() if (vector & v).bit_count() % 2) for v in range(1, tables + 1)
    ]


def _forest(values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the radius connects: from each reached value to those it is the first to reach."""
    left = values
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            value = front.pop()
            near = np.bitwise_count(left ^ value) <= radius
            if near.any():
                reached = left[near]
                yield np.full(len(reached), value, np.uint64), reached
                front.extend(reached)
                left = left[~near]


def _bucket_links(radius: int, limit: int):
    """Rows come sorted by table and key. Gives links, and the rows of larger buckets dealt by further tables."""

    def links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray, runs: np.ndarray) -> Iterator[tuple]:
        """Whole buckets; runs: their starts and the end."""
        sizes = np.diff(runs)
        inside = np.repeat(sizes, sizes)
        place = np.arange(len(fp)) - np.repeat(runs[:-1], sizes)
        for lag in range(1, 8):  # small buckets: all pairs of up to eight rows, of all buckets at once
            at = np.flatnonzero((inside <= 8) & (place + lag < inside))
            if not len(at):
                break
            at = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= radius]
            yield fp[at], fp[at + lag]
        for run in np.flatnonzero(sizes > 8):
            yield from _forest(fp[runs[run] : runs[run + 1]], radius)

    def batch_of(a, b=None, mask=None, key=None) -> pa.RecordBatch:
        signed = lambda x: pa.nulls(len(a), pa.int64()) if x is None else pa.array(x.view(np.int64))
        return pa.RecordBatch.from_arrays([signed(a), signed(b), signed(mask), signed(key)], names=["a", "b", "mask", "key"])

    def dealt(mask: int, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        dropped = [p for p in range(64) if not mask >> p & 1]
        for further in covering_masks(dropped, radius):
            wider = np.uint64(mask | further)
            yield batch_of(fp, None, np.full(len(fp), wider, np.uint64), fp & wider)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.uint64)] * 3  # the last bucket, which may go on in the next batch
        large: tuple[int, int] | None = None  # a bucket that is beyond the limit

        def parts(columns: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal rest, large
            mask, key, fp = columns
            if not len(fp):
                return
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            if large is not None:
                if (int(mask[0]), int(key[0])) == large:
                    end = starts[1] if len(starts) > 1 else len(fp)
                    yield from dealt(large[0], fp[:end])
                    mask, key, fp = mask[end:], key[end:], fp[end:]
                    starts = starts[1:] - end
                    if not len(fp):
                        rest = [np.zeros(0, np.uint64)] * 3
                        return
                large = None
            runs = np.r_[starts, len(fp)]
            sizes = np.diff(runs)
            if not last:
                keep = runs[-2]
                rest = [mask[keep:], key[keep:], fp[keep:]]
                if sizes[-1] > limit and _may_deal(int(mask[-1])):
                    large = (int(mask[-1]), int(key[-1]))
                    yield from dealt(large[0], rest[2])
                    rest = [np.zeros(0, np.uint64)] * 3
                mask, key, fp, runs, sizes = mask[:keep], key[:keep], fp[:keep], runs[:-1], sizes[:-1]
            if not len(sizes):
                return
            again = [r for r in np.flatnonzero(sizes > limit) if _may_deal(int(mask[runs[r]]))]
            for r in again:
                yield from dealt(int(mask[runs[r]]), fp[runs[r] : runs[r + 1]])
            if again:
                drop = np.zeros(len(sizes), bool)
                drop[again] = True
                stay = ~np.repeat(drop, sizes)
                mask, key, fp = mask[stay], key[stay], fp[stay]
                runs = np.r_[0, np.cumsum(sizes[~drop])]
            for a, b in links(mask, key, fp, runs):
                if len(a):
                    yield batch_of(a, b)

        def _may_deal(mask: int) -> bool:
            return 64 - mask.bit_count() > 11  # else it has at most 2^11 distinct rows

        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("mask", "key", "fp")]
            yield from parts([np.concatenate(pair) for pair in zip(rest, new, strict=True)], False)
        yield from parts(rest, True)

    return run


def fingerprint_links(distinct: DataFrame, radius: int = 4, limit: int = BUCKET_ROWS) -> DataFrame:
    """Links ``u, v`` that connect the distinct fingerprints ``fp`` as all pairs within the radius would."""
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks(list(range(64)), radius)]
    rows = distinct.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    links = None
    while True:
        found = materialise(
            rows.repartition("mask", "key")
            .sortWithinPartitions("mask", "key", "fp")
            .transform(arrow_map, _bucket_links(radius, limit), "a long, b long, mask long, key long"),
            "simhash",
        )
        own = found.filter("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v"))
        links = own if links is None else links.union(own)
        rows = found.filter("mask is not null").select("mask", "key", F.col("a").alias("fp"))
        if rows.isEmpty():
            return links.distinct()


def near_groups(found: DataFrame, radius: int = 4) -> DataFrame:
    """For each distinct ``fp`` the row that stays of its component: ``fp, keep_id, keep_number``."""
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "number")
    classes = materialise(found.groupBy("fp").agg(F.min(order).alias("first")), "simhash")
    roots = components(fingerprint_links(classes.select("fp"), radius))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    keep = rooted.groupBy("root").agg(F.min("first").alias("keep"))
    return rooted.join(keep, "root").select(
        "fp", F.col("keep.id").alias("keep_id"), F.col("keep.number").alias("keep_number")
    )


def simhash_groups(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 4, width: int = 4, seed: int = 42
) -> DataFrame:
    """A row for each input row: ``id, fp`` and ``component_id``, the smallest id of its component."""
    found = materialise(fingerprints(df, id_column, text_column, width, seed).drop("carried"), "simhash")
    return found.join(near_groups(found, radius), "fp").select("id", "fp", F.col("keep_id").alias("component_id"))


def drop_near_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 4) -> DataFrame:
    """One row of each component, that with the smallest id, with the columns of the input."""
    found = materialise(fingerprints(df, id_column, text_column, carry=df.columns), "simhash")
    keep = near_groups(found.drop("carried"), radius).select(F.col("keep_number").alias("number")).distinct()
    return found.join(keep, "number", "left_semi").select(*[F.col(f"carried.`{c}`").alias(c) for c in df.columns])

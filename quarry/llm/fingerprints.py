"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds the polynomial hash of each of its prefixes, modulo two primes. From two of its
entries follows the hash of any span, so spans are compared in constant time and the longest common extension of
two places is found by binary search.

A fingerprint is the hash of the whole text and the ``SKETCH`` smallest of the mixed hashes of all its spans of
``SPAN`` bytes (the whole text if it is shorter). The likeness of two fingerprints estimates the share of spans that
the texts have in common: of the smallest hashes of both together, those in both. Equal texts have equal
fingerprints and likeness 1; an empty text (null counts as empty) is like an empty one only.

``edited_fingerprints`` puts each text beside the next one by descending id. Rows are dealt by ranges of the id and
read in order; what a range needs of the next one, its first text, comes from the ends of all ranges, of which there
is one for each task. Repeated ids are ordered by a hash of the text, null ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, blobs, carried
from quarry.session import materialise

PRIMES = (2147483647, 2147483629)  # below 2^31, so that products fit 64 bits
BASES = (1000003, 69069001)
SPAN = 32  # bytes
SKETCH = 64  # hashes kept
BLOCK = 1 << 16  # bytes between the entries of a prefix array that are kept


def _powers(invert: bool) -> np.ndarray:
    """Powers of the bases, or of their inverses, as many as a block with a span needs."""
    rows = []
    for prime, base in zip(PRIMES, BASES, strict=True):
        step, row = pow(base, -1, prime) if invert else base, np.ones(1, np.uint64)
        while len(row) < BLOCK + SPAN + 1:  # doubled: the second half is the first times base ^ length
            row = np.concatenate([row, row * np.uint64(pow(step, len(row), prime)) % np.uint64(prime)])
        rows.append(row[: BLOCK + SPAN + 1])
    return np.stack(rows)


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(False), _powers(True)


MODULI = np.array(PRIMES, np.uint64)[:, None]


class PrefixHashes:
    """The prefix arrays of a byte string, from which the hash of any span follows.

    Entry i is the hash of the first i bytes. Kept are the entries at the beginnings of blocks, the smallest span keys of
    each block, and the entries of the blocks used last; others are computed again from their block's first entry. So
    the arrays of a text of any length take the memory of two blocks.
    """

    def __init__(self, data: bytes, kept: PrefixHashes | None = None, cut: int = 0):
        """``kept`` and ``cut``: another one's entries hold for the first cut bytes, which are the same."""
        self.length, self.codes = len(data), np.frombuffer(data, np.uint8)
        self.marks = [np.zeros((len(PRIMES), 1), np.uint64)]
        self.sketches: list[np.ndarray] = []
        self._blocks: dict[int, np.ndarray] = {}
        if kept is not None:
            self.marks = kept.marks[: cut // BLOCK + 1]
            # spans that begin in these blocks end within the bytes that are the same
            same = max(0, (cut - SPAN + 1) // BLOCK)
            self.sketches = kept.sketches[:same]
            block = cut // BLOCK
            if block in kept._blocks and block == same:
                self._blocks[block] = kept._blocks[block][:, : cut - block * BLOCK + 1]
        for block in range(len(self.sketches), max(1, -(-self.length // BLOCK))):
            entries = self.entries(block)
            if len(self.marks) == block + 1 and (block + 1) * BLOCK < self.length:
                self.marks.append(entries[:, BLOCK : BLOCK + 1].copy())  # not a view that keeps the block
            self.sketches.append(smallest(self._keys(block, entries)))

    def entries(self, block: int) -> np.ndarray:
        """The entries from the beginning of a block to its end and a span further, or to the end of the bytes."""
        start = block * BLOCK
        end = min(start + BLOCK + SPAN, self.length)
        known = self._blocks.pop(block, None)
        if known is None:
            known = self.marks[block]
        at = start + known.shape[1] - 1
        if at < end:
            up, down = powers()
            n = end - at
            codes = self.codes[at:end].astype(np.uint64) + np.uint64(1)
            # below 2^31 each, at most 2^16 of products below 2^40, and then two products below 2^62
            inner = np.cumsum(codes * down[:, :n], axis=1) % MODULI
            known = np.concatenate([known, (known[:, -1:] * up[:, 1 : n + 1] + inner * up[:, :n]) % MODULI], axis=1)
        while len(self._blocks) > 1:
            self._blocks.pop(next(iter(self._blocks)))
        self._blocks[block] = known
        return known

    @property
    def sums(self) -> np.ndarray:
        """All entries, for short texts."""
        blocks = [self.entries(b)[:, : BLOCK if (b + 1) * BLOCK < self.length else None] for b in range(len(self.sketches))]
        return np.concatenate(blocks, axis=1)

    def entry(self, at: int) -> list[int]:
        block = max(0, min(at // BLOCK, len(self.sketches) - 1))
        return self.entries(block)[:, at - block * BLOCK].tolist()

    def span(self, start: int, length: int) -> int:
        """The hash of one span, 62 bits."""
        found, begin, end = 0, self.entry(start), self.entry(start + length)
        for row, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
            found = found << 31 | (end[row] - begin[row] * pow(base, length, prime)) % prime
        return found

    def common(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """The longest common extension of two places, by binary search over span hashes."""
        low, high = 0, min(self.length - start, other.length - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, middle) == other.span(other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def _keys(self, block: int, entries: np.ndarray) -> np.ndarray:
        """The mixed hashes of the spans that begin in a block; of a text shorter than a span that of the text."""
        if self.length < SPAN:
            return np.array([self.span(0, self.length) & 0x7FFFFFFF], np.uint64) if self.length else np.zeros(0, np.uint64)
        prime, row = np.uint64(PRIMES[0]), entries[0]
        count = max(0, min(BLOCK, len(row) - SPAN))
        factor = np.uint64(pow(BASES[0], SPAN, PRIMES[0]))
        found = (row[SPAN : SPAN + count] + prime - row[:count] * factor % prime) % prime
        return found * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)

    def sketch(self) -> np.ndarray:
        """The smallest distinct keys of all spans."""
        if len(self.sketches) == 1:
            return self.sketches[0]
        return np.unique(np.concatenate(self.sketches))[:SKETCH]


def smallest(keys: np.ndarray, count: int = SKETCH) -> np.ndarray:
    """The smallest distinct keys, ascending."""
    if not len(keys):
        return keys
    some = min(len(keys), 4 * count)
    while True:
        part = np.unique(np.partition(keys, some - 1)[:some]) if some < len(keys) else np.unique(keys)
        if len(part) >= count or some >= len(keys):
            return part[:count].copy()
        some = min(len(keys), 8 * some)


def likeness(one: tuple[int, np.ndarray], other: tuple[int, np.ndarray]) -> float:
    """Of two fingerprints: the share of common spans, from 0 to 1."""
    if one[0] == other[0]:
        return 1.0
    if not len(one[1]) or not len(other[1]):
        return 0.0
    both = np.union1d(one[1], other[1])[:SKETCH]
    return float(np.isin(both, np.intersect1d(one[1], other[1], assume_unique=True)).mean())


def as_bytes(fingerprint: tuple[int, np.ndarray]) -> bytes:
    """Eight bytes for the whole text, four for each hash of the sketch."""
    return fingerprint[0].to_bytes(8, "big") + fingerprint[1].astype(">u4").tobytes()


def as_text(packed: Column) -> Column:
    """Packed fingerprints as lower-case hex digits, a colon after the whole text's."""
    digits = F.lower(F.hex(packed))
    return F.concat(F.substring(digits, 1, 16), F.lit(":"), F.substr(digits, F.lit(17)))


class Fingerprinted:
    """A text with its prefix arrays and fingerprint."""

    def __init__(self, data: bytes, kept: Fingerprinted | None = None, cut: int = 0):
        self.data = data
        self.prefixes = PrefixHashes(data, kept and kept.prefixes, cut)
        whole = self.prefixes.span(0, len(data)) << 2 | min(len(data), 3) if data else 0
        self.fingerprint = (whole, self.prefixes.sketch())


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, "
    "near_next double, common_prefix long"
)
KINDS = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64())


def _compare(own: Fingerprinted, following: Fingerprinted) -> tuple:
    text = own.data.decode()
    other = edited(text, following.data[: 4 * (len(text) // 3)].decode(errors="ignore")).encode()
    cut = len(text[: len(text) - len(text) // 3].encode())
    changed = Fingerprinted(other, own, cut)
    return (
        len(text),
        hashlib.sha256(other).hexdigest(),
        as_bytes(own.fingerprint),
        as_bytes(changed.fingerprint),
        likeness(own.fingerprint, changed.fingerprint),
        likeness(own.fingerprint, following.fingerprint),
        own.prefixes.common(0, changed.prefixes, 0),
    )


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows whose next row is in the same range; the range's first text and last row besides."""
    from pyspark import TaskContext

    task, last, last_row = TaskContext.get().partitionId(), None, None

    def rows(kind: str, carried_rows: pa.Array, results: list[tuple | None], texts: list[bytes | None]):
        n = len(results)
        columns = zip(*[r or (None,) * len(KINDS) for r in results], strict=True) if n else [[]] * len(KINDS)
        return pa.RecordBatch.from_arrays(
            [pa.array([task] * n, pa.int32()), pa.array([kind] * n, pa.string()), carried_rows, pa.array(texts, pa.binary())]
            + [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)],
            names=["task", "kind", "carried", "text", *[c.split()[0] for c in RESULT.split(", ")]],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        texts, results = blobs(batch, "text"), []
        own_rows = batch.column("carried")
        for number, data in enumerate(texts):
            current = Fingerprinted(data)
            if last is None:
                yield rows("head", own_rows.slice(0, 1), [None], [data])
            else:
                results.append(_compare(last, current))
                if number == 0:
                    yield rows("row", last_row, results, [None])
                    results = []
            last = current
        last_row = own_rows.slice(batch.num_rows - 1, 1)
        yield rows("row", own_rows.slice(0, len(results)), results, [None] * len(results))
    if last is not None:
        yield rows("tail", last_row, [None], [last.data])


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            _compare(Fingerprinted(a), Fingerprinted(b))
            for a, b in zip(blobs(batch, "text"), blobs(batch, "following"), strict=True)
        ]
        columns = zip(*found, strict=True) if found else [[]] * len(KINDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("carried")] + [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)],
            names=["carried", *[c.split()[0] for c in RESULT.split(", ")]],
        )


def edited_fingerprints(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``carried`` (the named columns; all by default) and what ``RESULT`` names, fingerprints as text, for each row."""
    text = F.col(f"`{text_column}`").cast("string")
    source = df.select(
        F.col(f"`{id_column}`").alias("id"),
        F.xxhash64(text).alias("order"),
        carried(df, df.columns if carry is None else carry).alias("carried"),
        text.alias("text"),
    )
    kind = source.schema["carried"].dataType.simpleString()
    order = [F.col("id").desc_nulls_last(), F.col("order")]
    found = materialise(
        source.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("carried", "text")
        .transform(arrow_map, _in_order, f"task int, kind string, carried {kind}, text binary, {RESULT}"),
        "fingerprints",
    )
    names = [c.split()[0] for c in RESULT.split(", ")]
    heads = found.filter("kind = 'head'").select(F.col("task").alias("next_task"), F.col("text").alias("following"))
    # one row for each task of the range exchange
    tasks = heads.select(
        F.col("next_task").alias("task"),
        F.coalesce(
            F.lead("next_task").over(Window.orderBy("next_task")),
            F.min("next_task").over(Window.orderBy("next_task").rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("next_task"),
    )
    tails = found.filter("kind = 'tail'").select("task", "carried", "text").join(tasks, "task").join(heads, "next_task")
    ends = tails.select("carried", "text", "following").transform(arrow_map, _pairs, f"carried {kind}, {RESULT}")
    results = found.filter("kind = 'row'").select("carried", *names).union(ends.select("carried", *names))
    return results.withColumns({c: as_text(F.col(c)) for c in ("fingerprint", "edited_fingerprint")})

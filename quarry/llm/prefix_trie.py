"""The trie of conversation prefixes, from vertical bitmaps.

**Index.** A shard holds ``BLOCK`` neighbouring conversation ids and ``SEGMENT`` turn positions. For each (position, turn)
it keeps the bitset of the conversations with that turn there, and for each position the bitset of those that end.
From the bitset of all conversations a depth-first walk intersects the bitset of a node with the postings of the next
position: each intersection is a child, its popcount the number of members, its lowest bit the smallest member.

**Joining shards.** A node is known by its depth and the exclusive or of a 128-bit hash of each (position, turn) above it,
which the walk carries along; so a segment can start from the hashes of its conversations' earlier turns. Counts of
the shards' nodes are added up, smallest members compared, and end lists (kept in the order of ids) read one after
another into the digest.

**Subtrees.** No walk up the whole trie is needed. The smallest member of a node owns it; what a conversation owns is
the end of its path. Each distinct node below ``u`` is thus counted once in sums over the members of ``u`` of two
numbers for each conversation: the code points before the nodes that it owns, and whether it owns a childless node.
A second pass over the shards' bitsets adds these up for each node.

Only counts, bitsets of a block and lists of ids of a block are rows. A first turn, a prefix or a whole conversation
that any share of all conversations has is a bitset in each shard, and one row for each shard where shards meet.
The digest of the members that end at one node reads their ids in order, a row for each block, without holding them.

Nulls, ties and repeated rows: a null role or text is empty; a null turn comes first; equal turn numbers follow each
other in the order of a hash of role and text, and repeated rows are separate turns. Rows without a conversation id
are left out. Long conversations are cut into segments, long texts are hashed where they are read. An empty table gives
no node, not even a root. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map
from quarry.llm.ranks import ranked
from quarry.session import materialise

#: Conversation ids of a block (a power of 2) and turn positions of a segment.
BLOCK_BITS = 10
BLOCK, SEGMENT = 1 << BLOCK_BITS, 256
KEY = ["depth", "a", "b"]


def turns_of(rows: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, position, x, y, length``: the turns of each conversation, numbered from 1.

    ``x, y`` are a hash of role and text; ``length`` is the number of code points of the text.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    x, y = F.xxhash64(role, text), F.xxhash64(F.lit(1), text, F.lit(2), role)
    own = rows.filter(F.col(f"`{id}`").isNotNull()).select(
        F.col(f"`{id}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        x.alias("x"),
        y.alias("y"),
        F.length(text).cast("long").alias("length"),
    )
    return ranked(own, "conv_id", "turn", "x", "y").select("conv_id", (F.col("rank") + 1).alias("position"), "x", "y", "length")


def shared_starts(turns: DataFrame, hundred: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations (``conv_id, n_turns``) where each starts like the first of its hundred.

    With h the crc32 of the decimal id modulo ``most``, a conversation takes the first h turns of conversation
    c - c % ``hundred`` (all if fewer, none if absent) and goes on with its own turns after its first h.
    """
    turns = materialise(turns, "turns")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % hundred
    convs = turns.groupBy("conv_id").agg(F.max("position").alias("own")).withColumns({"h": h, "base": base})
    heads = turns.filter((F.col("conv_id") % hundred == 0) & (F.col("position") < most)).withColumnRenamed("conv_id", "base")
    # at most most - 1 turns each
    first = heads.groupBy("base").agg(F.array_sort(F.collect_list(F.struct("position", "x", "y", "length"))).alias("head"))
    convs = convs.join(first, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("h")))
    convs = materialise(
        convs.select("conv_id", "h", "head", (F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")),
        "conversations",
    )
    taken = convs.select("conv_id", F.inline("head"))
    rest = turns.join(convs.select("conv_id", "h", F.size("head").alias("taken")), "conv_id").filter("position > h")
    rest = rest.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "x", "y", "length")
    return taken.unionByName(rest), convs.select("conv_id", "n_turns")


def shards(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows of the shards: (position, turn) with ``n_turns`` of the conversation, and where each starts in the segment.

    The start has the last position before the segment, and in ``a, b, length`` what the turns up to there add up to.
    """
    turns = turns.select(
        "conv_id",
        ((F.col("position") - 1) / SEGMENT).cast("long").alias("segment"),
        "position",
        F.xxhash64("position", "x", "y").alias("a"),
        F.xxhash64("y", "position", "x").alias("b"),
        "length",
    )
    turns = materialise(turns.join(convs, "conv_id"), "positions")
    long = turns.filter(F.col("n_turns") > SEGMENT).groupBy("conv_id", "segment", "n_turns").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("length").alias("length")
    )
    # one row for each SEGMENT turns of a long conversation
    upto = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = long.select(
        "conv_id", (F.col("segment") + 1).alias("segment"), ((F.col("segment") + 1) * SEGMENT).alias("position"),
        F.bit_xor("a").over(upto).alias("a"), F.bit_xor("b").over(upto).alias("b"),
        F.sum("length").over(upto).alias("length"), "n_turns",
    ).filter("position < n_turns")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", *[zero.alias(c) for c in ("segment", "position", "a", "b", "length")], "n_turns")
    rows = turns.unionByName(starts).unionByName(roots)
    return rows.withColumn("block", F.shiftright("conv_id", BLOCK_BITS))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each key, one key after the other; rows come sorted by the keys."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[c].to_numpy(zero_copy_only=False) for c in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            now = tuple(int(c[start]) for c in columns)
            if now != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(start, end - start))
    if held:
        yield key, pa.Table.from_batches(held)


class Shard:
    """The vertical bitmaps of one block of conversations and one segment of positions; bit i is id ``first + i``."""

    def __init__(self, segment: int, rows: pa.Table):
        self.start = segment * SEGMENT
        self.ends: dict[int, int] = {}
        #: by position: bitset of each turn, its length, and the turn of each conversation
        self.postings: dict[int, dict[tuple[int, int], int]] = {}
        self.lengths: dict[tuple[int, int], int] = {}
        self.turns: dict[int, dict[int, tuple[int, int]]] = {}
        self.begins: dict[tuple[int, int, int], int] = {}
        columns = [rows[c].to_pylist() for c in ("conv_id", "position", "a", "b", "length", "n_turns")]
        for conv, position, a, b, length, n_turns in zip(*columns, strict=True):
            bit = conv & (BLOCK - 1)
            if position == self.start:
                self.begins[a, b, length] = self.begins.get((a, b, length), 0) | 1 << bit
                if position == 0 and n_turns == 0:
                    self.ends[0] = self.ends.get(0, 0) | 1 << bit
                continue
            here = self.postings.setdefault(position, {})
            here[a, b] = here.get((a, b), 0) | 1 << bit
            self.lengths[a, b] = length
            self.turns.setdefault(position, {})[bit] = (a, b)
            if position == n_turns:
                self.ends[position] = self.ends.get(position, 0) | 1 << bit
        self.alive = {p: _any(sets.values()) for p, sets in self.postings.items()}

    def nodes(self) -> Iterator[tuple]:
        """``depth, a, b, parent's a and b, length of the last text, code points down to here, members, ends``."""
        for (a, b, down), members in self.begins.items():
            if self.start == 0:
                yield 0, 0, 0, 0, 0, 0, 0, members, members & self.ends.get(0, 0)
            stack = [(members, a, b, down, self.start)]
            while stack:
                members, a, b, down, depth = stack.pop()
                depth += 1
                rest = members & self.alive.get(depth, 0)
                while rest:
                    lowest = (rest & -rest).bit_length() - 1
                    turn = self.turns[depth][lowest]
                    child = members & self.postings[depth][turn]
                    rest &= ~child
                    length = self.lengths[turn]
                    node = (child, a ^ turn[0], b ^ turn[1], down + length, depth)
                    yield depth, node[1], node[2], a, b, length, down + length, child, child & self.ends.get(depth, 0)
                    stack.append(node)


def _any(sets) -> int:
    out = 0
    for one in sets:
        out |= one
    return out


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


NODES = (
    "block long, depth long, a long, b long, pa long, pb long, length long, down long, n long, first long, members binary, "
    "ends string, n_ends long"
)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in NODES.split(", ")]
    types = [{"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[f.split()[1]] for f in NODES.split(", ")]
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for (block, segment), group in _groups(batches, ["block", "segment"]):
        base = block << BLOCK_BITS
        for depth, a, b, above_a, above_b, length, down, members, ends in Shard(segment, group).nodes():
            first = base + (members & -members).bit_length() - 1
            packed = members.to_bytes(-(-members.bit_length() // 8), "little")
            ids = ",".join(str(base + i) for i in _bits(ends)) if ends else None
            rows.append((block, depth, a, b, above_a, above_b, length, down, members.bit_count(), first, packed, ids, ends.bit_count()))
            if len(rows) >= 4096:
                yield batch()
                rows.clear()
    if rows:
        yield batch()


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node of a block the sums of its members' numbers; the conversations of a block come first."""
    block, weights = None, None
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("block", "conv_id", "before", "leaf", "depth", "a", "b", "members")]
        out = []
        for now, conv, before, leaf, depth, a, b, members in zip(*columns, strict=True):
            if now != block:
                block, weights = now, np.zeros((BLOCK, 2), dtype=np.int64)
            if members is None:
                weights[conv & (BLOCK - 1)] = before, leaf
            else:
                bits = np.unpackbits(np.frombuffer(members, dtype=np.uint8), bitorder="little")
                total = weights[np.flatnonzero(bits)].sum(axis=0)
                out.append((depth, a, b, int(total[0]), int(total[1])))
        if out:
            arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*KEY, "before", "leaves"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's end lists, joined by commas in the order of the blocks."""
    key, digest = None, None

    def done() -> pa.RecordBatch:
        arrays = [pa.array([v], pa.int64()) for v in key] + [pa.array([digest.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=[*KEY, "ends_sha256"])

    for batch in batches:
        finished = []
        for *now, ids in zip(*[batch[c].to_pylist() for c in (*KEY, "ends")], strict=True):
            if now != key:
                if key is not None:
                    finished.append(done())
                key, digest = now, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield from finished
    if key is not None:
        yield done()


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the turns (``conv_id, position, x, y, length``) of the conversations.

    ``convs`` (``conv_id, n_turns``) names all conversations, those without turns too. Columns: ``conv_id`` (smallest
    member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    rows = shards(turns, convs).repartition("block", "segment").sortWithinPartitions("block", "segment")
    found = materialise(arrow_map(rows, _walk, NODES), "nodes")
    nodes = materialise(
        found.groupBy(*KEY).agg(
            F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("length").alias("length"),
            F.first("down").alias("down"), F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"),
            F.sum("n_ends").alias("n_ends"),
        ),
        "trie",
    )

    # what each conversation owns: its path from the first node whose smallest member it is
    own = nodes.groupBy("conv_id").agg(
        F.min(F.col("down") - F.col("length")).alias("before"),
        F.max((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("leaf"),
    )
    # all of it is before what it owns where it owns nothing
    whole = turns.groupBy("conv_id").agg(F.sum("length").alias("length"))
    numbers = (
        convs.join(whole, "conv_id", "left")
        .join(own, "conv_id", "left")
        .select(
            F.shiftright("conv_id", BLOCK_BITS).alias("block"),
            "conv_id",
            F.coalesce("before", "length", F.lit(0)).alias("before"),
            F.coalesce("leaf", F.lit(0)).alias("leaf"),
        )
    )
    empty = lambda *names: {n: F.lit(None).cast("binary" if n == "members" else "long") for n in names}
    both = numbers.withColumns(empty(*KEY, "members")).unionByName(
        found.select("block", *KEY, "members").withColumns(empty("conv_id", "before", "leaf"))
    )
    both = both.repartition("block").sortWithinPartitions("block", F.col("members").isNotNull())
    sums = arrow_map(both, _weigh, "depth long, a long, b long, before long, leaves long")
    sums = sums.groupBy(*KEY).agg(F.sum("before").alias("before"), F.sum("leaves").alias("leaves"))

    ends = found.filter("ends is not null").select(*KEY, "block", "ends")
    ends = ends.repartition(*KEY).sortWithinPartitions(*KEY, "block")
    ends = arrow_map(ends, _digests, "depth long, a long, b long, ends_sha256 string")

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    children = children.agg(F.count("*").alias("n_children"))
    firsts = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    smallest = own.select("conv_id", F.col("before").alias("own_before"))
    full = (
        nodes.join(sums, KEY)
        .join(children, KEY, "left")
        .join(ends, KEY, "left")
        .join(firsts, ["depth", "pa", "pb"], "left")
        .join(smallest, "conv_id")
    )
    shared = (F.col("n_convs") - 1) * (F.col("down") - F.col("length"))
    return full.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("before") - F.col("own_before") - shared).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )

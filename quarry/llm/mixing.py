"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

A source with weight w (a share of the blocks) gives block j of its own, counted from 0, the release floor(j / w)
and the deadline ceil((j + 1) / w). One block is taken in each slot: of the released blocks that with the earliest
deadline. As the weights sum to one, every block meets its deadline, and at each slot t every source has had
t * w blocks with a deviation of less than one.

Weights are exact: whole numbers in the very proportion of the target weights, however large, so the deviation does not
grow with the data. When a source has no block left, the others share on in the proportion of their weights: a new phase
begins, with the same guarantee from its first slot. A source of weight 0 comes when all others have ended. No document
is left out or repeated.

Each choice depends on those before it, so one task runs the schedule, block by block (not row by row); it holds one
entry for each source and writes the slots to a table, which is joined with the rows. The driver sees one count for each
source. Documents are numbered in their source by a hash of their id over as many tasks as there are; a source of any
size is spread.

A null source is a source of its own. Null ids come first in their source. Empty tables give an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from fractions import Fraction
from heapq import heapify, heappop, heappush
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, carried
from quarry.llm.ranks import BROADCAST_ROWS, ranked
from quarry.session import materialise

BLOCK_ROWS = 16
SLOTS = 10_000  # of a batch


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights as they are written."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if any(w < 0 for w in exact.values()):
        raise ValueError("weights below 0")
    scale = lcm(*[w.denominator for w in exact.values()])
    return {s: int(w * scale) for s, w in exact.items()}


def schedule(weights: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """Source, block, slot, release and deadline of all blocks, slot after slot; holds one entry for each source."""
    done, first = dict.fromkeys(blocks, 0), 0
    left = {s for s in blocks if blocks[s]}
    while left:
        # sources of weight 0 wait for the others, then share alike
        active = {s: weights[s] for s in left if weights[s]} or dict.fromkeys(left, 1)
        total, start = sum(active.values()), {s: done[s] for s in active}
        waiting: list[tuple] = []  # by release
        ready = [(-(-total // weight), source, 0, 0) for source, weight in active.items()]  # by deadline
        heapify(ready)
        for slot in range(sum(blocks[s] - done[s] for s in active)):
            while waiting and waiting[0][0] <= slot:
                release, source, j = heappop(waiting)
                heappush(ready, (-(-(j + 1) * total // active[source]), source, j, release))
            deadline, source, j, release = heappop(ready)
            yield source, start[source] + j, first + slot, first + release, first + deadline
            done[source] += 1
            if done[source] == blocks[source]:
                left.remove(source)
                first += slot + 1
                break
            heappush(waiting, ((j + 1) * total // active[source], source, j + 1))


def period(weights: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source in one period, whose length is the sum of the weights (for weights of a small sum)."""
    total = sum(weights.values())
    waiting: list[tuple] = []  # by release
    ready: list[tuple] = []  # by deadline
    for source in sorted(weights):
        heappush(waiting, (0, source, 0))
    slots: dict[str, list[int]] = {s: [] for s in weights}
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, source, j = heappop(waiting)
            heappush(ready, (-(-(j + 1) * total // weights[source]), source, j))
        _, source, j = heappop(ready)
        slots[source].append(slot)
        if j + 1 < weights[source]:
            heappush(waiting, (max(slot + 1, (j + 1) * total // weights[source]), source, j + 1))
    return slots


@dataclass
class Phase:
    first: int  # slot
    length: int
    period: int
    slots: dict[str, list[int]]
    start: dict[str, int] = field(default_factory=dict)  # first block of each source
    count: dict[str, int] = field(default_factory=dict)  # blocks of each source


def phases(weights: dict[str, int], blocks: dict[str, int]) -> list[Phase]:
    """The schedule of weights of a small sum: one phase until the first source ends, then until the next ends."""
    done, found, first = dict.fromkeys(blocks, 0), [], 0
    while active := {s: weights[s] for s in blocks if done[s] < blocks[s]}:
        slots, total = period(active), sum(active.values())
        ends = []
        for source, weight in active.items():
            rounds, rest = divmod(blocks[source] - done[source] - 1, weight)
            ends.append(rounds * total + slots[source][rest] + 1)
        length = min(ends)
        phase = Phase(first, length, total, slots)
        for source, weight in active.items():
            phase.start[source] = done[source]
            phase.count[source] = length // total * weight + bisect_left(slots[source], length % total)
            done[source] += phase.count[source]
        found.append(phase)
        first += length
    return found


def mix(
    df: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    weights: dict[str | None, float] | None = None,
    exponent: float = 0.5,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``carried`` (the input's row) with its ``block``, ``slot``, ``release``, ``deadline`` and ``place`` in the block.

    Without ``weights`` a source weighs (its rows) ** exponent: below 1 large sources weigh less than their share.
    Sources that ``weights`` doesn't name weigh as little as the least of those that it names.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_column}`").cast("string")), F.lit("n"))
    rows = df.select(
        key.alias("key"),
        F.xxhash64(F.col(f"`{id_column}`")).alias("order"),
        F.col(f"`{id_column}`").alias("id"),
        carried(df, df.columns).alias("carried"),
    )
    numbered = ranked(rows, "key", "order", "id")
    supply = {r["key"]: r["n"] for r in numbered.groupBy("key").agg((F.max("rank") + 1).alias("n")).collect()}
    if weights is None:
        wanted = {s: float(n) ** exponent for s, n in supply.items()}
    else:
        named = {"n" if s is None else f"s{s}": w for s, w in weights.items()}
        wanted = {s: named.get(s, min(named.values())) for s in supply}
    exact, blocks = whole_weights(wanted), {s: -(-n // block_rows) for s, n in supply.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                taken = schedule(exact, blocks)
                while part := list(islice(taken, SLOTS)):
                    key, *numbers = zip(*part, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, pa.string()), *[pa.array(n, pa.int64()) for n in numbers]],
                        names=["key", "block", "slot", "release", "deadline"],
                    )

    one = df.sparkSession.range(0, 1, 1, 1)
    plan = one.transform(arrow_map, run, "key string, block long, slot long, release long, deadline long")
    plan = materialise(plan, "schedule")
    # one row for each block: their number is known before it is broadcast
    if sum(blocks.values()) <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    placed = numbered.withColumn("block", F.floor(F.col("rank") / block_rows)).join(plan, ["key", "block"])
    place = (F.col("rank") % block_rows).cast("int").alias("place")
    return placed.select("carried", "block", "slot", "release", "deadline", place)


def in_mixed_order(df: DataFrame, **options) -> DataFrame:
    """The rows of the input in the order of the mix: partition by partition, file by file."""
    mixed = mix(df, **options).repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return mixed.select(*[F.col(f"carried.`{c}`").alias(c) for c in df.columns])

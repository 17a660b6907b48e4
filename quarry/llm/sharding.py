"""Sharding by balanced label propagation.

Documents are nodes, links join those that belong together (here: equal texts). Every linked node starts with a hash of
its own as its label, a shard; so most links cross shards at first. In each round joins bring a node the labels of
its neighbours, weighted by their links:

* the first node of a group that has no seat wants the shard that most of its neighbours are in, of those that have
  room for the whole group, else the one with the most room;
* shards admit whole groups while their quota has room, the largest first. Groups of more than a ``SEATED``-th of the
  documents (so fewer than ``SEATED``) are admitted one by one, the others by classes of their size (powers of 2),
  in a class that does not fit as a whole those that a hash draws;
* every other node moves to the label that most of its seated neighbours have.

So groups gather from their first nodes along the links. Rounds end when nothing moves; the links that cross shards
are counted before and after each, and become fewer. No shard seats more rows than its quota. Of a group larger than
any shard a part as large as the room is seated, drawn by a hash of the node.

At the end the documents without links, and those beyond a shard's quota, fill the shards in order: the law is
``rows``, the numbers of documents in the shards are at most one apart. Documents are numbered by ranges over all
tasks; only sums by shard and class come to the driver.

The links of a group of equal texts form a tree of two levels (every document to the first of its part of the group, that
to the first of the group), so no node has links to all of a large group; the upper links weigh as much as the parts
that hang on them.

Null texts have no bytes and are equal to each other and to empty ones. Repeated ids are rows of their own; texts of
any length are hashed where they are read. An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.ranks import ranked
from quarry.session import materialise

ROUNDS = 12
PARTS = 64  # of a group, for its tree of links
SEATED = 10_000  # groups of more than this part of the documents are admitted one by one
DRAWS = 1 << 20
SPARE = 0.95  # of the room that a class may fill by draws


def group_links(nodes: DataFrame, parts: int = PARTS) -> DataFrame:
    """Links ``u, v, weight`` that join the ``node``s of equal ``group`` in a tree of two levels."""
    split = nodes.select("node", "group", F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part"))
    first_of_part = split.groupBy("group", "part").agg(F.min("node").alias("v"), F.count("*").alias("n"))
    first = first_of_part.groupBy("group").agg(F.min("v").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    # a part's first node follows the group rather than its own part
    tops = first_of_part.join(first.drop("n"), "group").select(F.col("v").alias("u"), F.col("first").alias("v"), F.col("n").alias("weight"))
    leaves = split.join(first_of_part.filter("n > 1").select("group", "part", "v"), ["group", "part"])
    return leaves.select(F.col("node").alias("u"), "v", F.lit(1).cast("long").alias("weight")).union(tops).filter("u <> v")


def _choose(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), index + 1)


def _draw(*of: str | Column) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(DRAWS)) / DRAWS


def admit(large: list[tuple[int, int, int]], classes: dict[tuple[int, int], int], room: list[int]):
    """Seats for the large groups (unit, wish, rows), and the share that a shard admits of a class of the others.

    A large group whose wish has no room goes where the most is; one that no shard holds takes what room that has.
    """
    seats, shares = {}, {}
    for unit, wish, rows in sorted(large, key=lambda x: (-x[2], x[0])):
        if room[wish] < rows:
            wish = max(range(len(room)), key=lambda s: (room[s], -s))
        taken = min(rows, room[wish])
        if taken > 0:
            seats[unit] = (wish, taken / rows)
            room[wish] -= taken
    for (shard, size), rows in sorted(classes.items(), key=lambda x: (x[0][0], -x[0][1])):
        share = 1.0 if rows <= room[shard] else SPARE * max(0, room[shard]) / rows
        shares[shard, size] = share
        room[shard] -= rows * share
    return seats, shares


def cut_links(links: DataFrame, state: DataFrame) -> int:
    """The number of links (given in both directions) whose ends have different labels."""
    ends = [state.select(F.col("node").alias(e), F.col("label").alias(f"label_{e}")) for e in ("u", "v")]
    crossing = links.filter("u < v").join(ends[0], "u").join(ends[1], "v").filter("label_u <> label_v")
    return crossing.agg(F.count("*")).first()[0]


def propagate(
    links: DataFrame,
    shards: int,
    quotas: list[int],
    rounds: int = ROUNDS,
    units: DataFrame | None = None,
    history: list[int] | None = None,
) -> DataFrame:
    """``node, label`` for each node of the links ``u, v`` (with a ``weight``, or 1).

    ``units`` (``node, unit, copies``) names the group of each node by its first node, with its size; without it, groups
    are the components of the links. To ``history`` the number of crossing links is added: at first, and after each round.
    """
    if "weight" not in links.columns:
        links = links.withColumn("weight", F.lit(1).cast("long"))
    both = links.select("u", "v", "weight").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"), "weight"))
    both = materialise(both.distinct(), "links")
    if units is None:
        roots = components(both.select("u", "v")).withColumnRenamed("root", "unit")
        units = roots.join(roots.groupBy("unit").agg(F.count("*").alias("copies")), "unit")
    start = F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int")
    none = F.lit(None)
    # seat: the shard that seats the node's group, known to the node; share: how much of the group is seated
    state = materialise(
        units.select("node", "unit", "copies", start.alias("label"), none.cast("int").alias("seat"), none.cast("double").alias("share")),
        "labels",
    )
    total, claimed = sum(quotas), [0.0] * shards
    if history is not None:
        history.append(cut_links(both, state))
    for turn in range(rounds):
        room = [q - c for q, c in zip(quotas, claimed, strict=True)]
        open_to = lambda label: F.element_at(F.array(*[F.lit(float(r)) for r in room]), label + 1) >= F.col("copies")  # noqa: B023, E731
        firsts = state.filter("node = unit and seat is null").select(F.col("node").alias("u"), "copies")
        around = both.join(firsts, "u").join(state.select(F.col("node").alias("v"), "label"), "v")
        wanted = (
            around.filter(open_to(F.col("label")))
            .groupBy("u", "label")
            .agg(F.sum("weight").alias("n"))
            .groupBy("u")
            .agg(F.max(F.struct("n", F.xxhash64("u", "label").alias("draw"), "label")).alias("best"))
        )
        most = max(range(shards), key=lambda s: (room[s], -s))
        wishes = materialise(
            firsts.join(wanted, "u", "left").select(
                F.col("u").alias("unit"),
                "copies",
                F.coalesce(F.col("best.label"), F.lit(most)).alias("wish"),
                F.floor(F.log2("copies")).cast("int").alias("class"),
                _draw("u", F.lit(turn)).alias("draw"),
                (F.col("copies") > total // SEATED).alias("large"),
            ),
            "wishes",
        )
        large = [tuple(r) for r in wishes.filter("large").select("unit", "wish", "copies").collect()]
        by_class = wishes.filter("not large and copies <= " + str(max(0.0, max(room)))).groupBy("wish", "class")
        classes = {(r["wish"], r["class"]): r["n"] for r in by_class.agg(F.sum("copies").alias("n")).collect()}
        seats, shares = admit(large, classes, room)
        one_by_one = state.sparkSession.createDataFrame(
            pa.table(
                {
                    "unit": pa.array(list(seats), pa.int64()),
                    "placed": pa.array([s for s, _ in seats.values()], pa.int32()),
                    "part": pa.array([p for _, p in seats.values()], pa.float64()),
                }
            )
        )
        drawn = F.lit(False)
        for (shard, size), share in shares.items():
            drawn |= (F.col("wish") == shard) & (F.col("class") == size) & (F.col("draw") < share)
        seated = materialise(
            wishes.join(one_by_one, "unit", "left")
            .withColumn("placed", F.coalesce("placed", F.when(~F.col("large") & drawn, F.col("wish"))))
            .filter("placed is not null")
            .select("unit", "copies", F.col("placed").cast("int").alias("placed"), F.coalesce("part", F.lit(1.0)).alias("part")),
            "seats",
        )
        for r in seated.groupBy("placed").agg(F.sum(F.col("copies") * F.col("part")).alias("n")).collect():
            claimed[r["placed"]] += r["n"]
        # the others follow those of their neighbours whose seat is known
        known = state.filter("seat is not null").select(F.col("node").alias("v"), "seat", "share")
        waiting = state.filter("seat is null").select(F.col("node").alias("u"))
        led = (
            both.join(known, "v")
            .join(waiting, "u", "left_semi")
            .groupBy("u", "seat")
            .agg(F.sum("weight").alias("n"), F.max("share").alias("share"))
            .groupBy(F.col("u").alias("node"))
            .agg(F.max(F.struct("n", "seat", "share")).alias("led"))
        )
        new = state.join(seated.select(F.col("unit").alias("node"), "placed", "part"), "node", "left").join(led, "node", "left")
        seat = F.coalesce("seat", "placed", F.col("led.seat"))
        share = F.coalesce("share", "part", F.col("led.share"))
        moves = seat.isNotNull() & (_draw("node", F.lit("part")) < share)
        new = new.select(
            "node", "unit", "copies", F.when(moves, seat).otherwise(F.col("label")).alias("label"),
            seat.alias("seat"), share.alias("share"), (F.col("seat").isNull() & seat.isNotNull()).alias("changed"),
        )
        new = materialise(new, "labels")
        changed = not new.filter("changed").isEmpty()
        state = new.drop("changed")
        if not changed:
            break
        if history is not None:
            history.append(cut_links(both, state))
    return state.select("node", "label")


def even_shards(nodes: DataFrame, labels: DataFrame, shards: int, quotas: list[int], *order: str) -> DataFrame:
    """Each node with its ``shard`` and ``slot``; nodes without a label, and those beyond a quota, fill the shards."""
    placed = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", F.lit(shards)))
    placed = materialise(ranked(placed, "label", *order, "node"), "shards")
    counts = {r["label"]: r["n"] for r in placed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    own = [min(counts.get(s, 0), quotas[s]) for s in range(shards)] + [0]
    beyond = [counts.get(s, 0) - own[s] for s in range(shards + 1)]
    before = [sum(beyond[:s]) for s in range(shards + 1)]
    # the shards with the most room are filled first
    order_of_fill = sorted(range(shards), key=lambda s: (own[s] - quotas[s], s))
    free_end = [sum(quotas[s] - own[s] for s in order_of_fill[: i + 1]) for i in range(shards)]
    free_start = [0, *free_end[:-1]]
    rest = F.col("rank") - _choose(own, F.col("label")) + _choose(before, F.col("label"))
    filled = sum((F.when(F.col("rest") >= end, 1).otherwise(0) for end in free_end[:-1]), F.lit(0))
    placed = placed.withColumn("rest", rest).withColumn("filled", filled.cast("int"))
    shard = _choose(order_of_fill, F.col("filled")).cast("int")
    stays = F.col("rank") < _choose(own, F.col("label"))
    return placed.select(
        *nodes.columns,
        F.when(stays, F.col("label")).otherwise(shard).cast("int").alias("shard"),
        F.when(stays, F.col("rank"))
        .otherwise(_choose(own, shard) + F.col("rest") - _choose(free_start, F.col("filled")))
        .cast("long")
        .alias("slot"),
    )


def shard_documents(
    df: DataFrame,
    shards: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
    history: list[int] | None = None,
) -> DataFrame:
    """``id, size, crc, shard, slot`` for each row: equal texts together where the law ``rows`` allows it.

    ``history`` takes the numbers of links that cross shards, before and after each round of moves.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    nodes = df.select(
        F.monotonically_increasing_id().alias("node"),
        F.col(f"`{id_column}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("hash"),
    )
    nodes = materialise(nodes, "nodes")
    grouped = nodes.select("node", F.struct("hash", "crc", "size").alias("group"))
    total = nodes.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = grouped.groupBy("group").agg(F.count("*").alias("copies"), F.min("node").alias("first")).filter("copies > 1")
    groups = materialise(groups, "groups")
    units = grouped.join(groups, "group").select("node", F.col("first").alias("unit"), "copies")
    labels = propagate(group_links(grouped), shards, quotas, rounds, units, history)
    # if a shard has too many documents, those of groups that no shard holds leave it first, then the smallest groups
    large = groups.select(F.col("group.hash").alias("hash"), F.col("group.crc").alias("crc"), F.col("group.size").alias("size"), "copies")
    nodes = nodes.join(large, ["hash", "crc", "size"], "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    most = F.lit(max(quotas))
    nodes = nodes.withColumn("leaving", F.when(F.col("copies") > most, F.col("copies")).otherwise(-F.col("copies")))
    return even_shards(nodes, labels, shards, quotas, "leaving", "hash", "crc", "size").drop("copies", "leaving")

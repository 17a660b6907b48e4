"""Deletes runs of lines that appeared before, found by winnowing over line hashes.

Of every ``window`` consecutive lines the one with the smallest hash is selected, the last one of equals. Equal windows
select the same line at the same place, so each run of ``window`` or more lines that two places share has a selected line
in common: the fingerprint that is guaranteed. A row is written for each selected line, with the digests of the lines
around it that its windows reach; lines that no window selects have none.

Positions are joined in two steps. Those whose fingerprint occurs once are left out. Each other is joined, for each of
the windows that selected it, with the first position (by id, then row, then line) at which such a window selected such a
line: one partner a window, never all pairs. The match is extended from the selected line both ways as long as
the lines are equal, up to the lines that the row holds; a longer run goes on from its next selected line, at most
``window`` lines away, so overlapping matches make up the maximal run. All lines of a match are deleted at the later
position. So the first occurrence of every run stays, and each later copy goes, in the same document too, whatever its
length from ``window`` lines on.

Everything is DataFrame functions. Lines are compared by 128 bit digests. Fingerprints and windows that more than a
thousandth of all rows have are fewer than a thousand: these are broadcast, so that a very common line stays in the
tasks that its rows are in. All others meet in plain joins.

With ``passage_words`` a repeated passage is found by its length too, whatever its neighbours: every single line of so
many words has a row of its own, and so has a whole text of fewer lines than the window, if it is not empty. Their
matches are extended likewise.

Lines end at line feeds; a null text counts as empty (one empty line). Without ``passage_words`` a text of fewer lines
than the window stays.
Null ids come last. Repeated rows are copies of each other. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried
from quarry.session import materialise

WINDOW = 2  # lines
FREQUENT = 1000  # a key with more than this part of all rows is joined where its rows are
LINE, TEXT = -1, -2  # in place of the place in a window: a long line, a whole short text


def _leading(flags: Column) -> Column:
    """How many of the flags are true before the first that is false."""
    first = F.array_position(flags, False).cast("int")
    return F.when(first == 0, F.size(flags)).otherwise(first - 1)


def _positions(digests: Column, long: Column | None, size: int) -> Column:
    """For each selected line: its place in the text, its digest, the lines before (nearest first) and after it within a
    window's reach, and the smallest and largest place that it has in the windows that select it."""
    count, reach = F.size(digests), size - 1

    def position(at: Column) -> Column:
        own = F.get(digests, at)
        before = F.reverse(F.slice(digests, F.greatest(at - reach, F.lit(0)) + 1, F.least(at, F.lit(reach))))
        after = F.slice(digests, at + 2, reach)
        # the last of equals is selected: lines before may be equal, lines after may not
        lower = _leading(F.transform(before, lambda line: F.xxhash64(line) >= F.xxhash64(own)))
        higher = _leading(F.transform(after, lambda line: F.xxhash64(line) > F.xxhash64(own)))
        return F.struct(
            at.alias("at"), own.alias("own"), before.alias("before"), after.alias("after"),
            (F.lit(reach) - higher).alias("low"), lower.alias("high"),
            (F.get(long, at) if long is not None else F.lit(False)).alias("line"),
            ((at == 0) & (count < size) & ((count > 1) | (own != F.unhex(F.md5(F.lit(""))))) if long is not None else F.lit(False)).alias("text"),
        )

    every = F.transform(F.sequence(F.lit(0), count - 1), position)
    return F.filter(every, lambda p: (p["low"] <= p["high"]) | p["line"] | p["text"])


def _windows(size: int) -> Column:
    """The windows that select a position: its place in each, and the other lines of each."""
    none, low, high = F.array().cast("array<binary>"), F.col("low"), F.col("high")

    def window(place: Column | int, before: Column, after: Column) -> Column:
        place = F.lit(place) if isinstance(place, int) else place
        return F.struct(place.alias("place"), before.alias("lines_before"), after.alias("lines_after"))

    selecting = F.transform(
        F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>")),
        lambda place: window(place, F.slice("before", F.lit(1), place), F.slice("after", F.lit(1), F.lit(size - 1) - place)),
    )
    nothing = F.filter(F.array(window(LINE, none, none)), lambda _: F.lit(False))
    line = F.when(F.col("line"), F.array(window(LINE, none, none))).otherwise(nothing)
    text = F.when(F.col("text"), F.array(window(TEXT, none, F.col("after")))).otherwise(nothing)
    return F.concat(selecting, line, text)


def _meet(rows: DataFrame, found: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``found`` (one row a key, with the number ``n`` of rows that have it)."""
    often = F.col("n") > rows.count() / FREQUENT
    hot = F.broadcast(found.filter(often))  # fewer than FREQUENT rows
    rest = rows.join(hot.select(*key), key, "left_anti")
    return rows.join(hot, key, how).unionByName(rest.join(found.filter(~often), key, how))


def dedup_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, passage_words: int | None = None
) -> DataFrame:
    """``carried`` (the input's row), the remaining ``text``, ``n_lines``, ``n_removed`` and ``n_runs`` removed."""
    lines = F.split(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")), "\n", -1)
    docs = materialise(
        df.select(
            F.monotonically_increasing_id().alias("number"),
            F.col(f"`{id_column}`").alias("id"),
            lines.alias("lines"),
            # a column of the table, so that each line is digested once
            F.transform(lines, lambda line: F.unhex(F.md5(line))).alias("digests"),
            *([F.transform(lines, lambda line: F.size(F.split(F.trim(line), r"\s+")) >= passage_words).alias("long")] if passage_words else []),
            carried(df, [c for c in df.columns if c != text_column]).alias("carried"),
        ),
        "lines",
    )
    long = F.col("long") if passage_words else None
    selected = materialise(docs.select("number", "id", F.inline(_positions(F.col("digests"), long, window))), "lines")
    repeated = materialise(selected.groupBy("own").agg(F.count("*").alias("n")).filter("n > 1"), "lines")
    candidates = _meet(selected, repeated, ["own"], "left_semi")
    candidates = materialise(
        candidates.select("number", "id", "at", "own", "before", "after", F.inline(_windows(window))), "lines"
    )
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "number", "at")
    key = ["own", "place", "lines_before", "lines_after"]
    first = candidates.groupBy(*key).agg(
        F.min(F.struct(order.alias("order"), "before", "after")).alias("first"), F.count("*").alias("n")
    )
    first = materialise(first.filter("n > 1"), "lines")
    later = _meet(candidates, first, key).filter(order != F.col("first.order"))
    same = lambda side: _leading(F.zip_with(side, f"first.{side}", lambda own, other: own.eqNullSafe(other)))
    matches = later.select("number", (F.col("at") - same("before")).alias("start"), (F.col("at") + same("after")).alias("end"))
    gone = matches.groupBy("number").agg(F.collect_set(F.struct("start", "end")).alias("matches"))
    covered = F.array_distinct(F.flatten(F.transform("matches", lambda m: F.sequence(m["start"], m["end"]))))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    placed = docs.drop("digests", "long").join(gone, "number", "left").withColumn(
        "covered", F.coalesce(covered, F.array().cast("array<int>"))
    )
    stays = F.transform(F.array_except(every, F.col("covered")), lambda at: F.get("lines", at))
    return placed.select(
        "carried",
        F.array_join(stays, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("covered").cast("long").alias("n_removed"),
        F.size(F.array_except("covered", F.transform("covered", lambda at: at + 1))).cast("long").alias("n_runs"),
    )

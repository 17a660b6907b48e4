"""Words one edit apart, found by bit-sliced position indexes over the vocabulary, and the form that each varies.

**Index.** A block of words is held as bitsets: for each (position, letter) the set of words with that letter there.
To look a word up, the set of words that agree with it so far (no error) and the sets with one error so far (a
letter replaced; a letter inserted, which reads the index one position further on) go through its letters
together, each step a few bitwise operations on all words of the block, for many looked-up words at once. The first
letter that differs makes the error, so that each pair has one place of error.

**Blocks.** With one edit within the places ``lo`` to ``hi`` of the shorter word, the letters before ``lo`` and after
``hi`` are the same in both words. So words are dealt by those letters for each half of the word, both as the shorter and
as the longer word of a pair: every pair meets in exactly the half that holds its error. Groups beyond ``GROUP`` words are
dealt again by the halves of that half, and so on. In a range of one place a group holds no more words than there are
letters, and pairs of them, so the work stays bounded whatever letters many words share. Small groups share an index.

Only counts and best neighbours leave a block, never pairs. Forms are followed to the last by doubling: each step
makes a word at least ``ratio`` times as frequent, so a few joins do.

Nulls, empty and long texts: a null text has no words; a null id reads as an empty one. Words of any length are
handled. Repeated rows count again. Ties of frequency go to the smallest form in code-point order. Empty tables
give an empty result; other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, blobs
from quarry.session import materialise

RUN = re.compile("[a-zÀ-ÿ]+")
#: Letters of the words that a task counts before it passes them on.
COUNTER_LETTERS = 16 << 20
#: Words, and their letters, of a group that is looked up at once; of the groups that share an index; bytes of one state.
GROUP, GROUP_LETTERS = 2048, 1 << 21
INDEX, INDEX_LETTERS = 1024, 1 << 18
STATE_BYTES = 1 << 20


def _counted(least: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = Counter(), 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )
            total.clear()
            return out

        for batch in batches:
            for id, text in zip(batch["id"].to_pylist(), blobs(batch, "text"), strict=True):
                start = zlib.crc32(f"{'' if id is None else id}:".encode())
                # bytes.lower() touches A-Z alone
                runs = Counter(r for r in RUN.findall(text.lower().decode("utf-8", "replace")) if len(r) >= least)
                for word, n in runs.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least:
                        if word not in total:
                            held += len(word) + 64
                        total[word] += n
                if held >= COUNTER_LETTERS:
                    yield flush()
                    held = 0
        if total:
            yield flush()

    return run


def vocabulary(docs: DataFrame, id: str, text: str, least: int = 7, occurrences: int = 2, every: int = 31) -> DataFrame:
    """``word, n``: the words of at least ``least`` letters with their occurrences, at least ``occurrences``.

    A word is a run of letters, A-Z in lower case; where ``every`` divides the crc32 of ``<id>:<run>`` one letter of it is
    missing. Each task adds up what it reads before the shuffle.
    """
    read = docs.select(F.col(f"`{id}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    words = arrow_map(read, _counted(least, every), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def _dealt(words: DataFrame, lo: F.Column, hi: F.Column, m: F.Column) -> DataFrame:
    """The words with the group that the letters outside the places ``lo`` to ``hi`` of a word of ``m`` letters make."""
    return words.withColumns({"m": m, "lo": lo, "hi": hi}).withColumn(
        "group",
        F.xxhash64(F.expr("substring(word, 1, lo)"), F.expr("substring(word, hi + 1 + length(word) - m, length(word))")),
    )


def halves(words: DataFrame) -> DataFrame:
    """Each word in four groups: its error in the first or in the second half, as the shorter or as the longer word."""
    dealt = words.withColumn("m", F.explode(F.expr("array(length(word), length(word) - 1)")))
    dealt = dealt.withColumn("second", F.explode(F.array(F.lit(False), F.lit(True))))
    middle = F.floor(F.col("m") / 2).cast("int")
    lo, hi = F.when(F.col("second"), middle).otherwise(0), F.when(F.col("second"), F.col("m")).otherwise(middle)
    return _dealt(dealt, lo, hi, F.col("m")).drop("second")


def smaller(rows: DataFrame) -> DataFrame:
    """Groups of a range of places as groups of its two halves."""
    dealt = rows.withColumn("second", F.explode(F.array(F.lit(False), F.lit(True))))
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    lo, hi = F.when(F.col("second"), middle).otherwise(F.col("lo")), F.when(F.col("second"), F.col("hi")).otherwise(middle)
    dealt = dealt.withColumns({"lo_": lo, "hi_": hi}).drop("lo", "hi", "group", "second")
    return _dealt(dealt, F.col("lo_"), F.col("hi_"), F.col("m")).drop("lo_", "hi_")


class PositionIndex:
    """For each (position, letter) the bitset of the words with that letter there."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.longest = int(self.lengths.max())
        self.bytes = 8 * -(-len(words) // 64)
        starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(self.lengths, out=starts[1:])
        self.starts, self.letters = starts, np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self._slices: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def packed(self, flags: np.ndarray) -> np.ndarray:
        """Rows of booleans, a column for each word, as rows of 64-bit bitsets."""
        out = np.zeros((len(flags), self.bytes), dtype=np.uint8)
        bits = np.packbits(flags, axis=1, bitorder="little")
        out[:, : bits.shape[1]] = bits
        return out.view(np.uint64)

    def at(self, position: int) -> tuple[np.ndarray, np.ndarray]:
        """The letters found at a position, and a bitset for each; only the positions in use are kept."""
        if position not in self._slices:
            has = self.lengths > position
            column = np.zeros(len(self.lengths), dtype=np.uint32)
            column[has] = self.letters[self.starts[:-1][has] + position]
            letters = np.unique(column[has])
            self._slices[position] = letters, self.packed((column[None, :] == letters[:, None]) & has[None, :])
            self._slices.pop(position - 3, None)
        return self._slices[position]

    def agreeing(self, position: int, letters: np.ndarray) -> np.ndarray:
        """For each of the letters the bitset of the words that have it at the position."""
        known, sets = self.at(position)
        if not len(known):
            return np.zeros((len(letters), self.bytes // 8), dtype=np.uint64)
        place = np.minimum(np.searchsorted(known, letters), len(known) - 1)
        found = sets[place]
        found[known[place] != letters] = 0
        return found

    def of_length(self, length: int) -> np.ndarray:
        return self.packed((self.lengths == length)[None, :])

    def near(self, asked: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Booleans (asked, words): one edit apart, the first difference within ``lo`` to ``hi``.

        ``asked`` are rows of letters, all of one length m; found are words of m letters and of m + 1.
        """
        count, m = asked.shape
        self._slices.clear()
        none = np.tile(self.packed(np.ones((1, len(self.lengths)), dtype=bool)), (count, 1))
        replaced, inserted = np.zeros_like(none), np.zeros_like(none)
        for i in range(m):
            here = self.agreeing(i, asked[:, i])
            # with an error: a replaced letter leaves the positions, an inserted one moves them on by one
            replaced &= here
            shifted = self.agreeing(i + 1, asked[:, i])
            if lo <= i < hi:
                broken = none & ~here
                inserted = (inserted | broken) & shifted
                replaced |= broken
            else:
                inserted &= shifted
            none &= here
        if hi == m:  # a letter after the last
            inserted |= none
        found = (replaced & self.of_length(m)) | (inserted & self.of_length(m + 1))
        return np.unpackbits(found.view(np.uint8), axis=1, bitorder="little", count=len(self.lengths)).astype(bool)


def _look_up(words: list[str], counts: np.ndarray, m: int, lo: int, hi: int) -> Iterator[tuple]:
    """For the words with neighbours among the others: their number, the most frequent one and its count."""
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    words, counts = [words[i] for i in order], counts[order]
    lengths = np.array([len(w) for w in words])
    asking = np.flatnonzero(lengths == m)
    if not len(asking):
        return
    index = PositionIndex(words)
    letters = np.frombuffer("".join(words[i] for i in asking).encode("utf-32-le"), dtype=np.uint32).reshape(-1, m)
    number, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(words))
    step = max(1, STATE_BYTES // index.bytes)
    for start in range(0, len(asking), step):
        rows = asking[start : start + step]
        found = index.near(letters[start : start + step], lo, hi)
        # both words of a pair of one length ask; of the others only the shorter one does
        number[rows] += found.sum(axis=1)
        any_found = found.any(axis=1)
        best[rows[any_found]] = np.minimum(best[rows[any_found]], found[any_found].argmax(axis=1))
        longer = found & (lengths == m + 1)[None, :]
        number += longer.sum(axis=0)
        met = longer.any(axis=0)
        best[met] = np.minimum(best[met], rows[longer[:, met].argmax(axis=0)])
    for i in np.flatnonzero(number):
        yield words[i], int(number[i]), words[best[i]], int(counts[best[i]])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])

    def looked_up(key: tuple, words: list[str], counts: list[int]) -> pa.RecordBatch | None:
        found = list(_look_up(words, np.array(counts, dtype=np.int64), *key))
        if not found:
            return None
        columns = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    key, group, words, counts, letters = None, None, [], [], 0
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("m", "lo", "hi", "group", "word", "n")]
        for m, lo, hi, now, word, n in zip(*columns, strict=True):
            if (m, lo, hi) != key or now != group:
                # a new group: it shares the index of those before it unless that is full, or of another kind
                if words and ((m, lo, hi) != key or len(words) >= INDEX or letters >= INDEX_LETTERS):
                    if (out := looked_up(key, words, counts)) is not None:
                        yield out
                    words, counts, letters = [], [], 0
                key, group = (m, lo, hi), now
            words.append(word)
            counts.append(n)
            letters += len(word)
    if words and (out := looked_up(key, words, counts)) is not None:
        yield out


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` for the words (``word, n``) that have a word one edit apart.

    ``form`` is the most frequent of them, of equal ones the smallest.
    """
    parts = []
    rows = materialise(halves(words), "words")
    while True:
        keys = ["m", "lo", "hi", "group"]
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("words"), F.sum(F.length("word")).alias("letters"))
        # a group of one place is bounded by the letters; its words differ in that place alone
        too_many = (F.col("words") > GROUP) | (F.col("letters") > GROUP_LETTERS)
        large = materialise(sizes.filter(too_many & (F.col("hi") - F.col("lo") > 1)).select(*keys), "large")
        split = not large.isEmpty()
        fit = rows.join(large, keys, "left_anti") if split else rows
        dealt = fit.repartition(*keys).sortWithinPartitions(*keys)
        parts.append(arrow_map(dealt, _neighbours, "word string, n_near long, form string, form_n long"))
        if not split:
            break
        rows = materialise(smaller(rows.join(large, keys, "left_semi")), "words")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each word (``word, n``; words are distinct).

    ``form`` is the most frequent word one edit apart if it is at least ``ratio`` times as frequent as the word; ``root`` is
    where following the forms ends.
    """
    words = materialise(words.select("word", "n"), "vocabulary")
    found = near_words(words)
    known = words.join(found, "word", "left")
    varies = F.col("form_n") >= F.lit(ratio) * F.col("n")
    known = materialise(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(varies, F.col("form")).alias("form"),
            F.when(varies, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    steps = materialise(known.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        # the number of steps taken doubles, until no end is itself a variant
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = materialise(steps.join(onward, "root", "left"), "roots")
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter("further is not null").isEmpty():
            break
    return known.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))

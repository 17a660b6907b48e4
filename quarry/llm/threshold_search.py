"""Exact top-k search by the threshold algorithm over sorted lists, one for each dimension.

A vector's score for a query is their inner product. Each dimension of a block of candidates has a list of them
sorted by that component; a query reads all its lists in parallel, from the top where its own component is
positive and from the bottom where it is negative (a zero adds nothing, so its list is not read). A candidate is
scored in full when it is first met. No candidate not yet met can score more than the query's components times the
last values read; the query leaves the block once that bound is below its kth score. A tie with the bound is read
on, as an unmet candidate of the same score may have a smaller id.

Spark deals a grid: a block of queries and a group of candidates make one cell, which any number of tasks share
out. In a cell the queries are held and the candidates stream through in blocks; the k best found so far are kept
for the next block, whose bound is then lower from the start. Each cell returns at most k rows for each query; the
last step merges them. Nothing is broadcast and no pair is a row.

Components become ``floor(scale * x)`` (doubles). Scores are exact: whole numbers in doubles while all sums are
below 2**53, Python integers beyond, cut off at the ends of a 64-bit integer.

Nulls, empty and repeated rows: a vector that is null or holds a null, infinite or NaN component takes no part. A
row without an id is never a query but may be found (its id is null, the last among ties). Missing components of a
shorter vector count as zero, so an empty vector scores 0 with all. Repeated rows are separate rows: each copy of
a query is answered, and finds its own copies. An empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map
from quarry.session import materialise

#: Queries of a cell, candidates of a cell, candidates of one set of lists.
QUERIES, CANDIDATES, BLOCK = 2048, 8192, 2048
#: Rows read from each list before the bound is tried for the first time; then twice as many each time.
FIRST_DEPTH = 8
EXACT = float(1 << 53)
LONG = (-(1 << 63), (1 << 63) - 1)
NO_ID = 1 << 63  # a null id comes last among ties


class Best:
    """The k best (score, id, row) of one query, best first."""

    def __init__(self, k: int):
        self.k, self.found = k, []

    def bound(self):
        return self.found[-1][0] if len(self.found) == self.k else None

    def add(self, scores, ids, rows) -> None:
        merged = self.found + list(zip(scores, ids, rows, strict=True))
        self.found = sorted(merged, key=lambda x: (-x[0], x[1], x[2]))[: self.k]


class Lists:
    """A block of candidates (whole numbers) with its sorted list for each dimension."""

    def __init__(self, vectors: np.ndarray, ids: list[int], rows: list[int]):
        self.vectors, self.ids, self.rows = vectors, ids, rows
        by_dimension = np.ascontiguousarray(vectors.T)
        self.order = np.argsort(by_dimension, axis=1, kind="stable")
        self.values = np.take_along_axis(by_dimension, self.order, axis=1)

    def search(self, query: np.ndarray, own: int, best: Best) -> int:
        """Adds what the block has for the query; returns how many candidates were scored."""
        n = len(self.vectors)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met, depth, step, scored = np.zeros(n, dtype=bool), 0, FIRST_DEPTH, 0
        if not len(up) and not len(down):
            step = n  # all lists are empty of information: every score is 0
        while depth < n and scored < n:
            kth = best.bound()
            if kth is not None and len(up) + len(down):
                highest = query[up] @ self.values[up, n - 1 - depth] + query[down] @ self.values[down, depth]
                if highest < kth:
                    break
            end = min(n, depth + step)
            read = np.zeros(n, dtype=bool)
            if len(up) + len(down):
                read[self.order[up, n - end : n - depth]] = True
                read[self.order[down, depth:end]] = True
            else:
                read[:] = True
            new = np.flatnonzero(read & ~met)
            met |= read
            scored += len(new)
            if len(new):
                self.score(query, new, own, best)
            depth, step = end, step * 2
        return scored

    def score(self, query: np.ndarray, new: np.ndarray, own: int, best: Best) -> None:
        # a gather of most rows costs more than the products
        scores = (self.vectors @ query)[new] if 4 * len(new) > len(self.vectors) else self.vectors[new] @ query
        kth = best.bound()
        if kth is not None:
            worth = scores >= kth
            new, scores = new[worth], scores[worth]
        elif len(new) > 2 * best.k + 2:
            # those below the (k+1)th of them cannot stay, also when one of them is the query itself
            least = np.sort(scores)[-(best.k + 1)]
            worth = scores >= least
            new, scores = new[worth], scores[worth]
        chosen = [(int(s), self.ids[i], self.rows[i]) for s, i in zip(scores, new, strict=True) if self.rows[i] != own]
        if len(chosen) > best.k:
            chosen = sorted(chosen, key=lambda x: (-x[0], x[1], x[2]))[: best.k]
        if chosen:
            best.add(*zip(*chosen, strict=True))


def whole_numbers(values: list, scale: float, width: int) -> np.ndarray:
    """``floor(scale * x)`` as a matrix of doubles that hold whole numbers, padded with zeros."""
    out = np.zeros((len(values), width))
    for row, vector in enumerate(values):
        out[row, : len(vector)] = vector
    with np.errstate(over="ignore"):
        out = np.floor(out * scale)
    return np.nan_to_num(out, posinf=np.finfo(float).max, neginf=np.finfo(float).min)


def exact(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles when every sum of products is exact in them, else as Python integers."""
    largest = max(np.abs(queries).max(initial=0), 1.0) * max(np.abs(candidates).max(initial=0), 1.0)
    if largest * max(queries.shape[1], 1) < EXACT:
        return queries, candidates
    whole = np.vectorize(int, otypes=[object])
    return (whole(queries) if queries.size else queries.astype(object)), whole(candidates)


class Cell:
    """The queries of a cell, and the candidates not yet searched."""

    def __init__(self, key: tuple, k: int, scale: float):
        self.key, self.k, self.scale = key, k, scale
        self.queries, self.waiting, self.best = [], [], []

    def take(self, query: bool, row: int, number: int, vector) -> None:
        if query:
            self.queries.append((row, number, vector))
            self.best.append(Best(self.k))
        else:
            self.waiting.append((row, number, vector))
            if len(self.waiting) >= BLOCK:
                self.search()

    def search(self) -> None:
        if not self.waiting or not self.queries:
            return
        width = max(len(v) for _, _, v in (*self.queries, *self.waiting))
        queries, vectors = exact(
            whole_numbers([v for _, _, v in self.queries], self.scale, width),
            whole_numbers([v for _, _, v in self.waiting], self.scale, width),
        )
        lists = Lists(vectors, [n for _, n, _ in self.waiting], [r for r, _, _ in self.waiting])
        for (row, _, _), query, best in zip(self.queries, queries, self.best, strict=True):
            lists.search(query, row, best)
        self.waiting = []

    def results(self) -> Iterator[tuple]:
        self.search()
        for (row, number, _), best in zip(self.queries, self.best, strict=True):
            for score, found, copy in best.found:
                score = min(max(score, LONG[0]), LONG[1])
                yield row, number, score, None if found == NO_ID else found, copy


def _cells(k: int, scale: float):
    schema = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "score", "vec_id", "row")])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None
        for found in batches:
            keys = zip(found["query_block"].to_pylist(), found["group"].to_pylist(), strict=True)
            flags, rows, ids = (found[c].to_pylist() for c in ("is_query", "row", "id"))
            # offsets instead of objects: a vector is a slice of the batch's values
            values = found["vector"]
            flat = values.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(values.value_lengths().to_numpy(zero_copy_only=False))
            start = 0
            for key, flag, row, number, end in zip(keys, flags, rows, ids, ends, strict=True):
                if cell is None or key != cell.key:
                    if cell is not None and (out := list(cell.results())):
                        yield batch(out)
                    cell = Cell(key, k, scale)
                cell.take(flag, row, NO_ID if number is None else number, flat[start:end].copy())
                start = end
        if cell is not None and (out := list(cell.results())):
            yield batch(out)

    return run


def top_k(vectors: DataFrame, id: str, vector: str, is_query: F.Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query``, its k best other rows, ties to smaller ids.

    ``vector`` is an array of numbers, ``id`` a whole number. See the module for nulls, ties and repeated rows.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = materialise(
        vectors.filter(F.coalesce(usable, F.lit(False))).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id}`").cast("long").alias("id"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            v.alias("vector"),
        ),
        "vectors",
    )
    counts = rows.agg(F.count("*"), F.count_if("asks")).first()
    groups, blocks = -(-max(counts[0], 1) // CANDIDATES), -(-max(counts[1], 1) // QUERIES)
    part = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = rows.filter("asks").select(
        part(blocks, 1).alias("query_block"), every(groups).alias("group"), F.lit(True).alias("is_query"), "row", "id", "vector"
    )
    found = rows.select(
        every(blocks).alias("query_block"), part(groups, 2).alias("group"), F.lit(False).alias("is_query"), "row", "id", "vector"
    )
    cells = (
        asking.unionByName(found)
        .repartition("query_block", "group")
        .sortWithinPartitions("query_block", "group", F.desc("is_query"))
    )
    best = arrow_map(cells, _cells(k, scale), "query_row long, query_id long, score long, vec_id long, row long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

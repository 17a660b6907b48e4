"""Threshold search, spelling variants and the prefix trie against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import prefix_trie as trie
from quarry.llm import spelling_variants as spelling
from quarry.llm import threshold_search as search
from quarry.llm.queries import QUERIES
from tests.conftest import SMALL

# --- threshold search -------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score string, row string, rank string"


def plain_top(rows, k=5, asks=lambda i: i is not None and i % 50 == 0):
    usable = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for place, (i, q) in enumerate(usable):
        if not asks(i):
            continue
        scored = []
        for other, (j, c) in enumerate(usable):
            if other != place:
                scored.append((-sum(a * b for a, b in zip(q, c, strict=False)), j is None, j))
        out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def found_top(df, **options):
    found = search.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, **options)
    return sorted((tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_search_equals_all_products(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = QUERIES["op11_threshold_search"](spark, SMALL)
    assert sorted((tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()), key=str) == plain_top(rows)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.normal(size=4)]) for i in range(150)]
    rows += [(200, None), (201, []), (250, [0.0, 0.0, 0.0, 0.0]), (300, [1.0, None, 0.0, 0.0]), (350, [float("nan"), 1.0, 0.0, 0.0])]
    rows += [(351, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5, 0.5, 0.5, 0.5]), (None, None), (400, [1.0]), (450, [])]
    rows += [(500, [0.5, -0.5, 0.5, 0.5])] * 3 + [(600 + i, [0.5, -0.5, 0.5, 0.5]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 1, "own", "own", "own") for i, v in rows], VECTORS).repartition(3).cache()
    return df, [(r[0], r[1]) for r in df.collect()]


@pytest.mark.parametrize("sizes", [(2048, 8192, 2048), (2, 7, 3)])
def test_odd_vectors(odd_vectors, monkeypatch, sizes):
    df, rows = odd_vectors
    for name, size in zip(("QUERIES", "CANDIDATES", "BLOCK"), sizes, strict=True):
        monkeypatch.setattr(search, name, size)
    # the tasks read the same constants only where they are passed with the function, so cells are built here too
    assert found_top(df) == plain_top(rows)
    assert found_top(df, k=60) == plain_top(rows, k=60)


def test_cells_of_many_blocks(monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 5)
    random = np.random.default_rng(1)
    rows = [(i, random.integers(-3, 4, size=3).astype(float)) for i in range(83)]
    cell = search.Cell((0, 0), 5, 1.0)
    for i, v in rows[::10]:
        cell.take(True, i, i, v)
    for i, v in rows:
        cell.take(False, i, i, v)
    got = defaultdict(list)
    for _, query, score, found, _ in cell.results():
        got[query].append((found, score))
    for i, v in rows[::10]:
        best = sorted(((-int(v @ w), j) for j, w in rows if j != i))[:5]
        assert got[i] == [(j, -s) for s, j in best]


def test_search_stops_at_the_bound():
    random = np.random.default_rng(2)
    vectors = np.floor(256 * random.normal(size=(2000, 8)))
    vectors[77] = 9000.0
    lists = search.Lists(vectors, list(range(2000)), list(range(2000)))
    best = search.Best(1)
    assert lists.search(np.full(8, 100.0), -1, best) < 500
    assert best.found[0][1] == 77
    # a later block that cannot beat it is not read at all
    later = search.Lists(vectors[100:], list(range(1900)), list(range(1900)))
    assert later.search(np.full(8, 100.0), -1, best) == 0


def test_large_components_are_exact(spark):
    rows = [(0, [1e12, 1.0]), (1, [1e12, 1.0]), (2, [1e12, 2.0]), (3, [-1e12, 1.0]), (4, [1.0, 1e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = search.top_k(df, "vec_id", "embedding", F.col("vec_id") == 4, k=4).orderBy("rank").collect()
    want = plain_top(rows, 4, lambda i: i == 4)
    assert sorted([tuple(r) for r in got], key=str) == want


def test_no_vectors(spark):
    assert found_top(spark.createDataFrame([], VECTORS)) == []
    assert found_top(spark.createDataFrame([(50, [1.0], 1, "", "", "")], VECTORS)) == []


# --- spelling variants --------------------------------------------------------------------------------------------


def plain_vocabulary(docs, least=7, occurrences=2, every=31):
    total = Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= occurrences}


def near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def plain_variants(words, ratio=10):
    # candidates by deleted letters; each is then compared
    by_hole = defaultdict(set)
    for w in words:
        by_hole[w].add(w)
        for i in range(len(w)):
            by_hole[w[:i] + w[i + 1 :]].add(w)
    neighbours = {}
    for w in words:
        holes = {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}
        neighbours[w] = [v for v in set().union(*(by_hole[h] for h in holes)) if near(w, v)]
    form = {}
    for w, n in words.items():
        best = min(neighbours[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, n, len(neighbours[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def rows_of(df):
    rows = [tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("sf", [SMALL, "/root/testdata/sf0.01"])
def test_variants_equal_comparing_all(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_variants(plain_vocabulary(docs))
    assert len(want) > 1000 and any(row[3] for row in want)
    assert rows_of(QUERIES["op12_spelling_variants"](spark, sf)) == want


def test_words_of_odd_documents(spark, documents, collected):
    want = plain_vocabulary([(r["doc_id"], r["text"]) for r in collected], least=3)
    got = spelling.vocabulary(documents, "doc_id", "text", least=3)
    assert {r["word"]: r["n"] for r in got.collect()} == want


@pytest.mark.parametrize("alphabet, length, count", [("ab", 9, 300), ("abé", 5, 200), ("abcdefgh", 4, 900)])
@pytest.mark.parametrize("group", [2048, 8])
def test_small_alphabets(spark, monkeypatch, alphabet, length, count, group):
    """Runs of one letter have many places of insertion; groups of 8 words are split down to one place."""
    monkeypatch.setattr(spelling, "GROUP", group)
    random = np.random.default_rng(length)
    words = {"".join(random.choice(list(alphabet), size=random.integers(1, length + 1))) for _ in range(count)}
    words = {w: int(random.choice([1, 2, 10, 20, 100, 1000])) for w in sorted(words)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.spelling_variants(df, ratio=10)) == plain_variants(words)


def test_long_words_and_chains(spark):
    long = "q" * 30_000 + "z" * 30_000
    words = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, long: 5, long + "x": 50, "x" + long: 50}
    words |= {long[:100] + "y" + long[101:]: 7}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: r for r in spelling.spelling_variants(df).collect()}
    assert [got[w]["root"] for w in ("abcdefg", "abcdefgh", "abcdefghi", "abcdefghij")] == ["abcdefghij"] * 4
    assert got[long]["n_near"] == 3 and got[long]["form"] == long + "x"
    assert got["x" + long]["form"] is None and got["x" + long]["n_near"] == 1


def test_no_words(spark, nothing):
    words = spelling.vocabulary(nothing, "doc_id", "text")
    assert spelling.spelling_variants(words).collect() == []


def test_every_pair_has_one_place_of_error():
    words = ["aaaa", "aaaaa", "aaab", "baaa", "aaba", "ab", "aab", "abab"]
    letters = np.frombuffer("aaaa".encode("utf-32-le"), dtype=np.uint32).reshape(1, -1)
    index = spelling.PositionIndex(words)
    whole = index.near(letters, 0, 4)[0]
    assert [w for w, yes in zip(words, whole, strict=True) if yes] == ["aaaaa", "aaab", "baaa", "aaba"]
    parts = sum(index.near(letters, lo, lo + 1)[0].astype(int) for lo in range(4))
    assert (parts == whole).all()


# --- prefix trie --------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, position string, a string, block string"


def plain_trie(conversations):
    """From ``conv_id -> [(role, text), ...]``."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = own + sum(saved[c] for c in children[path])
    out = set()
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(conversations[c]) == len(path)))
        out.add(
            (
                min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children[path]),
                leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    assert len(out) == len(members)
    return out


def own_turns(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in by.items()}


def rebuilt(rows):
    own = own_turns(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_rows(df):
    rows = [
        tuple(r)
        for r in df.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
        ).collect()
    ]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("sf", [SMALL, "/root/testdata/sf0.1"])
def test_trie_equals_plain_prefixes(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(QUERIES["op13_prefix_trie"](spark, sf)) == plain_trie(rebuilt(rows))


@pytest.fixture(scope="module")
def odd_turns(spark):
    random = np.random.default_rng(5)
    rows = []
    for c in range(-150, 2400, 7):
        rows += [(c, t, "user" if t % 2 == 0 else None, random.choice(["", "hi", "hö", None])) for t in range(random.integers(1, 9))]
    rows += [(c, t, "user", f"turn {t}") for c in (5_000, 5_001, 90_000) for t in range(700 + c % 3)]
    rows += [(700, None, "user", "first"), (None, 1, "user", "no conversation"), (None, None, None, None)]
    rows += [(c, t, "user", "same") for c in range(10_000, 12_300) for t in range(7)]
    rows += [(20_000 + c, 0, "user", "x" * 3_000) for c in range(3)]
    return rows, spark.createDataFrame([(*r[:3], None if r[3] is None else str(r[3]), "own", "own", "own") for r in rows], TURNS)


def test_odd_conversations(odd_turns):
    rows, df = odd_turns
    turns = trie.turns_of(df.repartition(5), "conv_id", "turn", "role", "text")
    assert trie_rows(trie.prefix_trie(*trie.shared_starts(turns))) == plain_trie(rebuilt(rows))
    # and as they are
    convs = turns.groupBy("conv_id").agg(F.max("position").cast("int").alias("n_turns"))
    assert trie_rows(trie.prefix_trie(turns, convs)) == plain_trie(own_turns(rows))


def test_no_conversations(spark):
    turns = trie.turns_of(spark.createDataFrame([], TURNS), "conv_id", "turn", "role", "text")
    assert trie.prefix_trie(*trie.shared_starts(turns)).collect() == []


def test_equal_turn_numbers_are_separate_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "b"), (2, 0, "user", "a")]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], TURNS)
    turns = trie.turns_of(df, "conv_id", "turn", "role", "text")
    convs = turns.groupBy("conv_id").agg(F.max("position").cast("int").alias("n_turns"))
    found = trie.prefix_trie(turns, convs).collect()
    assert sorted((r["depth"], r["n_convs"]) for r in found) == [(0, 2), (1, 2), (2, 2), (3, 2)]

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import exact_dedup, line_dedup, simhash, suffix_dedup
from quarry.llm.components import components


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups_equal_brute_force(documents, collected):
    found = exact_dedup.exact_dedup(documents).collect()
    groups = defaultdict(list)
    for r in collected:
        groups[normalised(r.text)].append(r.doc_id)
    expected = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected.update((i, keep, len(ids), digest) for i in ids)
    assert Counter((r.id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    kept = [r for r in found if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r.id == r.keep_id for r in kept)


def test_exact_spills_until_buckets_fit():
    texts = [f"text {i % 700} " * 30 for i in range(3_000)]
    batches = [
        pa.RecordBatch.from_pydict({
            "rep": list(range(at, at + 500)), "id": [i % 1_000 for i in range(at, at + 500)], "number": list(range(at, at + 500)),
            "n": [2] * 500, "text": texts[at : at + 500],
        })
        for at in range(0, 3_000, 500)
    ]
    rows = pa.Table.from_batches(exact_dedup._resolve(4_000, False)(iter(batches))).to_pylist()
    assert len(rows) == 3_000
    for r in rows:
        copies = [i for i in range(3_000) if i % 700 == r["rep"] % 700]
        assert r["group_size"] == 2 * len(copies)
        assert (r["keep_id"], r["keep_number"]) == min((i % 1_000, i) for i in copies)
    assert sum(r["stays"] for r in rows) == 700


def test_content_table_compares_contents():
    table = exact_dedup.ContentTable(4)
    entries = [table.add(5, f"{i}".encode()) for i in range(50)]  # one hash for all
    assert [table.find(5, f"{i}".encode()) for i in range(50)] == entries
    assert table.find(5, b"none") == -1


def test_exact_copies_are_dropped(documents, clashing, nothing, collected):
    kept = exact_dedup.drop_exact_copies(documents)
    assert kept.columns == documents.columns
    assert kept.count() == len({normalised(r.text) for r in collected})
    assert exact_dedup.drop_exact_copies(clashing).columns == clashing.columns
    assert {r["hash"] for r in exact_dedup.drop_exact_copies(clashing).collect()} == {"own hash"}
    assert exact_dedup.drop_exact_copies(nothing).count() == 0
    assert exact_dedup.exact_dedup(nothing).count() == 0


def plain_simhash(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_components_equal_brute_force(documents, collected):
    prints = [plain_simhash(r.text) for r in collected]
    distinct = sorted(set(prints))
    linked = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= 4]
    roots = plain_components(distinct, linked)
    least = {}
    for r, p in zip(collected, prints, strict=True):
        if r.doc_id is not None:
            least[roots[p]] = min(r.doc_id, least.get(roots[p], r.doc_id))
    expected = Counter((r.doc_id, p, least.get(roots[p])) for r, p in zip(collected, prints, strict=True))
    found = simhash.simhash_groups(documents).collect()
    assert Counter((r.id, r.fp % (1 << 64), r.component_id) for r in found) == expected
    kept = simhash.drop_near_copies(documents)
    assert kept.columns == documents.columns
    assert kept.count() == len(set(roots.values()))


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks(list(range(64)), 4)
    assert len(masks) == 31
    random.seed(3)
    for _ in range(3_000):
        bits = sum(1 << b for b in random.sample(range(64), 4))
        assert any(not mask & bits for mask in masks)


@pytest.mark.parametrize("limit", [24, 2048])
def test_large_buckets_lose_no_link(spark, limit):
    random.seed(5)
    bases = [random.getrandbits(64) for _ in range(2)]
    values = {b ^ sum(1 << i for i in random.sample(range(20), random.randint(0, 5))) for b in bases for _ in range(40)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp long"), limit=limit)
    near = lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 4
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if near(a, b)]
    found = [(r.u, r.v) for r in links.collect()]
    assert all(near(a, b) for a, b in found)
    assert plain_components(values, found) == plain_components(values, pairs)


def test_simhash_of_odd_tables(clashing, nothing):
    assert simhash.drop_near_copies(clashing).columns == clashing.columns
    assert simhash.simhash_groups(nothing).count() == 0
    assert simhash.drop_near_copies(nothing).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 200) for i in range(40)] + [(500, 500), (7, 7), (1, 0), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_line_dedup(rows, size):
    seen, removed = set(), []
    for r in rows:
        lines, gone = (r.text or "").split("\n"), set()
        for i in range(len(lines) - size + 1):
            window = tuple(lines[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        removed.append("\n".join(line for i, line in enumerate(lines) if i not in gone))
    return removed


@pytest.mark.parametrize("size", [2, 3])
def test_lines_equal_brute_force(documents, collected, size):
    # rows with one id and the same text have the same remaining texts in either order
    rows = sorted(collected, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    rows = [r for r in rows if r.doc_id is not None]
    found = line_dedup.dedup_lines(documents.filter("doc_id is not null"), window=size).collect()
    expected = Counter((r.doc_id, t) for r, t in zip(rows, plain_line_dedup(rows, size), strict=True))
    assert Counter((r.carried.doc_id, r.text) for r in found) == expected
    assert sum(r.n_removed for r in found) > 0
    assert all(r.n_runs <= r.n_removed <= r.n_lines for r in found)


@pytest.mark.parametrize("size", [2, 4])
def test_lines_among_few_and_very_frequent_ones(spark, size):
    draw = random.Random(5)
    texts = ["\n".join(draw.choice("aaaaaabcd") for _ in range(draw.randrange(30))) for _ in range(60)]
    texts += ["a\n" * 3000, "b\n".join(texts[:20])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.carried.doc_id: r.text for r in line_dedup.dedup_lines(docs, window=size).collect()}
    assert [found[i] for i in range(len(texts))] == plain_line_dedup(docs.orderBy("doc_id").collect(), size)


def test_a_line_is_selected_once_and_every_window_selects_one(spark):
    lines = [hashlib.md5(str(i % 7).encode()).digest() for i in range(50)]
    docs = spark.createDataFrame([(lines,)], "digests array<binary>")
    for size in (1, 2, 5):
        rows = docs.select(F.inline(line_dedup._positions(F.col("digests"), None, size))).collect()
        starts = sorted(r["at"] - place for r in rows for place in range(r.low, r.high + 1))
        assert starts == list(range(len(lines) - size + 1))
        assert len({r["at"] for r in rows}) == len(rows)
        for r in rows:
            assert [*r.before[::-1], r.own, *r.after] == lines[max(0, r["at"] - size + 1) : r["at"] + size]


def test_long_passages_are_found_between_other_lines(spark):
    passage, short = " ".join(f"word{i}" for i in range(60)), "a line of few words"
    texts = [f"one\n{passage}\ntwo", f"three\n{passage}\n{short}\nfour", f"five\n{short}\nsix", passage, short, short, "", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.carried.doc_id: (r.text, r.n_removed, r.n_runs) for r in line_dedup.dedup_lines(docs, passage_words=50).collect()}
    assert found[0] == (texts[0], 0, 0)
    assert found[1] == (f"three\n{short}\nfour", 1, 1)
    assert found[2] == (texts[2], 0, 0)
    assert found[3] == ("", 1, 1)
    assert found[4] == (short, 0, 0) and found[5] == ("", 1, 1)
    assert found[6] == found[7] == ("", 0, 0)


def test_lines_of_odd_tables(documents, clashing, nothing):
    assert line_dedup.dedup_lines(documents).count() == documents.count()
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert {r.carried["number"] for r in line_dedup.dedup_lines(clashing).collect()} == {"own number"}


def test_lines_use_no_python(documents):
    plan = line_dedup.dedup_lines(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def plain_repeats(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    kept = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept.append((sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return kept


def test_repeated_strings_equal_brute_force():
    random.seed(9)
    piece = lambda n: bytes(random.choice(b"abc \n") for _ in range(n))
    shared = [piece(random.randint(150, 260)) for _ in range(6)]
    texts = [b"".join(random.choice([piece(70), random.choice(shared)]) for _ in range(8)) for _ in range(40)] + [b"a" * 450, b"", b"ab"]
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    expected = [i + 200 <= len(t) and count[t[i : i + 200]] > 1 for t in texts for i in range(len(t))]
    assert suffix_dedup.repeated_strings(texts).tolist() == expected


def test_memory_of_a_refined_chunk():
    """Bytes held for each byte that is refined, also where most strings are repeated."""
    random.seed(4)
    text = bytes(random.choices(b"abcdefghij", k=1 << 19))
    for texts in ([text, text[::-1]], [text, text]):
        tracemalloc.start()
        suffix_dedup.repeated_strings(texts)
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert peak < 45 * (1 << 20)


def test_memory_of_a_long_text(monkeypatch):
    random.seed(5)
    text = bytes(random.choices(b"abcdefghij ", k=1 << 20)) * 8
    tracemalloc.start()
    first, count, _ = suffix_dedup.stretches(text)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 100 << 20 and int(count.sum()) == len(text) - 199
    # the pieces cut stretches, and change neither strings nor buckets
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 12)
    other, counts, _ = suffix_dedup.stretches(text[: 1 << 16])
    assert set(first[first < (1 << 16) - 200].tolist()) <= set(other.tolist()) and int(counts.sum()) == (1 << 16) - 199


def test_chunks_are_closed_before_the_bound(monkeypatch):
    sizes = []
    plain = suffix_dedup.repeated_strings
    monkeypatch.setattr(suffix_dedup, "repeated_strings", lambda texts: sizes.append(sum(map(len, texts))) or plain(texts))
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 10_000)
    rows = [(bucket, 0, 1, i, 0, 0, bytes(300)) for bucket in range(40) for i in range(bucket % 9 + 1)]
    names = ["bucket", "chunk", "chunks", "id", "hash", "first", "stretch"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
    list(suffix_dedup._refine([batch]))
    assert sum(sizes) == 300 * len(rows) and max(sizes) <= 10_000


def test_merged_spans():
    begins, ends = suffix_dedup.merged(np.array([(500, 1), (0, 1), (100, 5), (700, 1), (901, 1)]))
    assert begins.tolist() == [0, 500, 901] and ends.tolist() == [304, 900, 1101]


@pytest.mark.parametrize("chunk", [suffix_dedup.CHUNK_STRETCHES, 1])
def test_repeats_equal_brute_force(spark, documents, collected, chunk):
    rows = collected
    if chunk == 1:  # buckets in many chunks
        rows = [r for r in collected if r.doc_id is None or r.doc_id < 60 or r.doc_id >= 900_000]
        documents = spark.createDataFrame(rows, documents.schema).repartition(3)
    expected = Counter(
        (r.doc_id, len((r.text or "").encode()), n, runs, hashlib.sha256(kept).hexdigest())
        for r, (n, runs, kept) in zip(rows, plain_repeats([(r.text or "").encode() for r in rows], 200), strict=True)
    )
    found = suffix_dedup.remove_repeats(documents, parts=5, chunk_stretches=chunk).collect()
    assert Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == expected
    assert sum(r.n_removed > 0 for r in found) > 4


def test_repeats_of_odd_tables(clashing, nothing):
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert suffix_dedup.remove_repeats(clashing, with_kept=True).count() == clashing.count()

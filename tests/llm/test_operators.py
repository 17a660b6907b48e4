from __future__ import annotations

import hashlib
import json
import math
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarry.llm import fingerprints, language_id, mixing, ranks, sharding, tokens, warc
from tests.conftest import SMALL
from tools.check_queries import comparable

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- language identification


@pytest.fixture(scope="module")
def network(documents):
    return language_id.network_of(documents)


def test_held_out_accuracy(documents, network):
    found = language_id.identify(documents, network).select("carried.*", "lang_pred", "score").withColumn("held_out", language_id.held_out())
    rows = [r for r in found.collect() if r.doc_id is not None and r.doc_id < 900_000]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r for r in rows if r.held_out and r.lang]
    assert len(judged) > 20
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.9 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows)


def plain_probabilities(network, text):
    """The forward pass with loops: every filter at every byte of every window, maximum, softmax, mean over the text's bytes."""
    data, sums = text.encode(), np.zeros(len(network.labels))
    width_of = [w for w in language_id.WIDTHS for _ in range(language_id.FILTERS)]
    rows, _, sizes = language_id.windows([data])
    for row, size in zip(rows, sizes, strict=True):
        seen = [network.embedding[b] for b in [*row, *[0] * max(language_id.WIDTHS)]]
        hidden = []
        for f, width in enumerate(width_of):
            weights = network.filters[:, f].reshape(-1, language_id.EMBEDDING)[:width]
            best = max(sum(float(weights[k] @ seen[at + k]) for k in range(width)) for at in range(len(row)))
            hidden.append(max(best + float(network.bias[f]), 0))
        scores = np.array(hidden) @ network.out + network.out_bias
        scores = np.exp(scores - scores.max())
        sums += size * scores / scores.sum()
    return sums / sizes.sum()


def test_predictions_equal_plain_loops(spark, network):
    texts = ["a short one", "äöü und ß", "x" * 700, "the cat sat on the mat. " * 15]
    found = language_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), network)
    for r in found.collect():
        expected = plain_probabilities(network, texts[r.carried.doc_id])
        assert r.lang_pred == network.labels[int(expected.argmax())]
        assert r.score == pytest.approx(expected.max(), abs=1e-4)


def test_texts_without_letters(documents, network, nothing, clashing):
    found = {r.carried.doc_id: r for r in language_id.identify(documents, network).collect()}
    assert [found[i].lang_pred for i in (900_001, 900_002, 900_003, 900_012)] == ["und"] * 4
    assert found[900_004].lang_pred != "und"
    assert language_id.identify(nothing, network).count() == 0
    assert language_id.network_of(nothing) is None
    assert {r.lang_pred for r in language_id.identify(documents, None).collect()} == {"und"}
    assert {r.carried.score for r in language_id.identify(clashing, network).collect()} == {"own score"}


def test_prediction_uses_text_only(documents, network):
    changed = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    plain = lambda df: sorted((r.carried.text or "", r.lang_pred) for r in language_id.identify(df, network).collect())
    assert plain(changed) == plain(documents)


def test_windows_cover_whole_texts():
    texts = [b"a" * 700, b"", b"b", b"c" * 256]
    rows, owner, sizes = language_id.windows(texts)
    assert np.bincount(owner, sizes, 4).tolist() == [700, 0, 1, 256]
    assert rows.sum() == sum(map(sum, texts))


def test_training_lowers_the_loss():
    random = np.random.default_rng(1)
    rows = random.integers(97, 123, (300, language_id.WINDOW)).astype(np.uint8)
    target = np.arange(300) % 3
    for label in range(3):
        rows[target == label, 40:44] = np.frombuffer([b"qqqq", b"zxzx", b"jkjj"][label], np.uint8)
    network = language_id.ByteNetwork.fresh(["a", "b", "c"]).train(rows, target, steps=400)
    assert (network.probabilities(rows).argmax(axis=1) == target).mean() > 0.95


# --- byte-level BPE


def plain_encoding():
    return tokens.encoding(RANKS, public_tokenizers.PATTERN)


def test_tokens_equal_the_library(documents, clashing, nothing):
    found = tokens.encode(documents, "text", RANKS, public_tokenizers.PATTERN)
    library = plain_encoding()
    for r in found.collect():
        expected = library.encode_ordinary(r.carried.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == expected
        assert r.n_tokens == len(expected)
    decoded = tokens.decode(found.select("carried.*", "ids"), "ids", RANKS, public_tokenizers.PATTERN)
    assert all(r.decoded == (r.carried.text or "").encode() for r in decoded.collect())
    assert tokens.encode(nothing, "text", RANKS, public_tokenizers.PATTERN).count() == 0
    kept = tokens.encode(clashing, "text", RANKS, public_tokenizers.PATTERN)
    assert {r.carried["ids"] for r in kept.collect()} == {"own ids"}


@pytest.mark.parametrize("limit", [1, 7, 64])
def test_parts_have_the_tokens_of_the_whole(limit):
    texts = [
        "It's  a   test\n\n with\tspaces \n and 'quotes' don't 12 34", "  leading", "trailing   ", "\n \n", "x" * 300,
        "a b   c\x1c d\x85e", "é è ǘ 漢字 かな 🙂 🙂🙂", "", " ", "a  b  c",
    ]
    library = plain_encoding()
    for text in texts:
        assert "".join(tokens.parts(text, limit)) == text
        ids = np.frombuffer(tokens.encode_text(text, library, limit), "<u4").tolist()
        assert ids == library.encode_ordinary(text), text


SHORT_RUNS = re.compile(f"{tokens.WHITE}{{3,}}")


@pytest.mark.parametrize("run", [" " * 9, "\n" * 9, " \n\t \x85\u3000 \xa0", "\t \n" * 3, "\x1c" * 9, "\n\n\n "])
def test_runs_cut_out_are_the_matches_of_the_whole(run):
    library = plain_encoding()
    for text in (run, f"a{run}", f"{run}b", f"a{run}b", f"a{run}'s {run}1{run}", f"é{run}漢 x{run}!?"):
        assert "".join(part for part, _ in tokens.pieces(text, 1, SHORT_RUNS)) == text
        ids = np.frombuffer(tokens.encode_text(text, library, 1, SHORT_RUNS), "<u4").tolist()
        assert ids == library.encode_ordinary(text), text


def test_runs_of_millions_are_encoded(spark):
    """The library alone ends in an error on these; each run gives the tokens of its matches."""
    long = 2_000_000
    texts = [
        " " * long, "\n" * long + "end", "start" + " \t" * long, "a" + " " * long + "b" + "\n" * long + "c",
        "x" * long, "-" * long,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = tokens.encode(df, "text", RANKS, public_tokenizers.PATTERN)
    decoded = tokens.decode(found.select("carried.doc_id", "carried.text", "ids"), "ids", RANKS, public_tokenizers.PATTERN)
    checked = decoded.select("carried.doc_id", (F.col("decoded") == F.col("carried.text").cast("binary")).alias("same"))
    assert sorted(tuple(r) for r in checked.collect()) == [(i, True) for i in range(len(texts))]
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4") for r in found.select("carried.doc_id", "ids").collect()}
    library = plain_encoding()
    assert ids[0].tolist() == library._encode_single_piece(" " * long)
    assert ids[1].tolist() == library._encode_single_piece("\n" * (long - 1)) + library.encode_ordinary("\nend")


def test_incomplete_characters_decode_to_bytes():
    library = plain_encoding()
    packed = tokens.encode_text("漢", library)
    assert tokens.decode_tokens(packed[:4], library) == library.decode_single_token_bytes(int(np.frombuffer(packed[:4], "<u4")[0]))


# --- fingerprints


def test_edited_texts_equal_brute_force(documents, collected, nothing):
    found = fingerprints.edited_fingerprints(documents.filter("doc_id <> 900008 and doc_id is not null"), carry=["doc_id", "text"]).collect()
    rows = sorted((r for r in collected if r.doc_id not in (None, 900_008)), key=lambda r: -r.doc_id)
    following = {r.doc_id: n for r, n in zip(rows, rows[1:] + rows[:1], strict=True)}
    own = {r.carried.doc_id: r.fingerprint for r in found}
    assert len(found) == len(rows)
    by_text = defaultdict(set)
    for r in found:
        text, other = r.carried.text or "", following[r.carried.doc_id].text or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + other[:third]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        plain = fingerprints.Fingerprinted(changed.encode())
        digits = fingerprints.as_bytes(plain.fingerprint).hex()
        assert r.edited_fingerprint == f"{digits[:16]}:{digits[16:]}"
        common = next((i for i, (a, b) in enumerate(zip(text.encode(), changed.encode(), strict=False)) if a != b), min(len(text.encode()), len(changed.encode())))
        assert r.common_prefix == common
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if own[r.carried.doc_id] == own[following[r.carried.doc_id].doc_id]:
            assert r.near_next == 1
        by_text[text].add(r.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert len({p for prints in by_text.values() for p in prints}) == len(by_text)
    long = [r for r in found if r.n_chars > 600]
    assert np.mean([r.near_edited for r in long]) > 0.45 > 0.2 > np.mean([r.near_next for r in long])
    assert fingerprints.edited_fingerprints(nothing).count() == 0


def test_rows_without_order_keep_their_texts(documents, clashing):
    found = fingerprints.edited_fingerprints(documents)
    assert Counter(r.carried.text for r in found.collect()) == Counter(r.text for r in documents.collect())
    assert {r.carried["hash"] for r in fingerprints.edited_fingerprints(clashing).collect()} == {"own hash"}
    one = documents.filter("doc_id = 0")
    assert [r.near_next for r in fingerprints.edited_fingerprints(one).collect()] == [1.0]


def test_span_hashes_and_extensions():
    data, other = b"abcabcabd" * 40, b"xxabcabcabd" + b"abcabcabd" * 3 + b"zz"
    one, two = fingerprints.PrefixHashes(data), fingerprints.PrefixHashes(other)
    for a, b, n in [(0, 3, 5), (0, 9, 100), (1, 2, 4), (5, 14, 60), (0, 0, 0)]:
        assert (one.span(a, n) == one.span(b, n)) == (data[a : a + n] == data[b : b + n])
    assert one.common(0, two, 2) == len(other) - 4
    assert one.common(1, two, 0) == 0
    kept = fingerprints.PrefixHashes(data[:200] + other, one, 200)
    assert (kept.sums == fingerprints.PrefixHashes(data[:200] + other).sums).all()


def test_likeness_estimates_common_spans():
    words = [f"{i * 7919 % 10007}" for i in range(4_000)]
    one, two = " ".join(words[:3_000]).encode(), " ".join(words[1_000:]).encode()
    spans = lambda t: {t[i : i + 32] for i in range(len(t) - 31)}
    exact = len(spans(one) & spans(two)) / len(spans(one) | spans(two))
    found = fingerprints.likeness(fingerprints.Fingerprinted(one).fingerprint, fingerprints.Fingerprinted(two).fingerprint)
    assert abs(found - exact) < 0.2


def test_long_texts_take_the_memory_of_blocks():
    random = np.random.default_rng(8)
    long = random.integers(97, 123, size=50 << 20, dtype=np.uint8).tobytes()
    tracemalloc.start()
    one = fingerprints.Fingerprinted(long)
    cut = 33 << 20
    two = fingerprints.Fingerprinted(long[:cut] + b"X" + long[cut + 1 :], one, cut)
    common = one.prefixes.common(0, two.prefixes, 0)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # the changed text itself and its parts, and 40 MB of arrays
    assert common == cut and peak < 4 * len(long)
    assert fingerprints.likeness(one.fingerprint, two.fingerprint) > 0.9


@pytest.mark.parametrize("block", [64, 100, 1 << 16])
def test_blocks_change_no_fingerprint(monkeypatch, block):
    random = np.random.default_rng(9)
    texts = [random.integers(97, 101, size=n, dtype=np.uint8).tobytes() for n in (0, 1, 31, 32, 33, 64, 100, 128, 131, 1000, 1001)]
    plain = []
    for data in texts:
        whole, keys = [0, 0], []
        for row, (prime, base) in enumerate(zip(fingerprints.PRIMES, fingerprints.BASES, strict=True)):
            for code in data:
                whole[row] = (whole[row] * base + code + 1) % prime
        for i in range(len(data) - 31):
            h = 0
            for code in data[i : i + 32]:
                h = (h * fingerprints.BASES[0] + code + 1) % fingerprints.PRIMES[0]
            keys.append(h * 0x9E3779B97F4A7C15 % (1 << 64) >> 32)
        plain.append((whole[0] << 31 | whole[1], sorted(set(keys))[:64]))
    monkeypatch.setattr(fingerprints, "BLOCK", block)
    fingerprints.powers.cache_clear()
    try:
        for data, (whole, keys) in zip(texts, plain, strict=True):
            found = fingerprints.Fingerprinted(data)
            assert found.fingerprint[0] >> 2 == whole and (len(data) < 32 or found.fingerprint[1].tolist() == keys)
            for cut in (0, 1, len(data) // 3, len(data) * 2 // 3, max(0, len(data) - 1)):
                other = data[:cut] + b"q" * (len(data) - cut)
                changed, alone = fingerprints.Fingerprinted(other, found, cut), fingerprints.Fingerprinted(other)
                assert fingerprints.as_bytes(changed.fingerprint) == fingerprints.as_bytes(alone.fingerprint)
                common = next((i for i, (a, b) in enumerate(zip(data, other, strict=True)) if a != b), len(data))
                assert found.prefixes.common(0, changed.prefixes, 0) == common
    finally:
        fingerprints.powers.cache_clear()


# --- sharding


def test_shards_are_even_and_keep_groups(documents, collected):
    found = sharding.shard_documents(documents, 8).collect()
    assert Counter((r.id, r.size, r.crc) for r in found) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in collected
    )
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
    assert sorted(by_shard) == list(range(8))
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    groups = defaultdict(list)
    for r in found:
        groups[(r.crc, r.size)].append(r.shard)
    split = sum(len(set(shards)) > 1 for shards in groups.values())
    assert split <= 8


def test_a_group_beyond_a_shard_fills_shards_side_by_side(spark):
    rows = [(i, "same") for i in range(500)] + [(500 + i, f"pair {i // 2}") for i in range(200)] + [(700 + i, f"own {i}") for i in range(101)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4).collect()
    sizes = Counter(r.shard for r in found)
    assert sorted(sizes.values()) == [200, 200, 200, 201]
    pairs = defaultdict(set)
    for r in found:
        if 500 <= r.id < 700:
            pairs[(r.id - 500) // 2].add(r.shard)
    assert sum(len(p) > 1 for p in pairs.values()) <= 4
    assert len({r.shard for r in found if r.id < 500}) <= 4


@pytest.mark.parametrize("sizes", [[100, 300, 1_000], [1_000] * 7 + [300, 100], [20] * 30 + [1_100]])
def test_groups_that_fit_a_shard_stay_whole(spark, sizes):
    rows = [f"group {g}" for g, size in enumerate(sizes) for _ in range(size)]
    rows += [f"own {i}" for i in range(9_600 - len(rows))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    found = sharding.shard_documents(docs, 8).collect()
    assert set(Counter(r.shard for r in found).values()) == {1_200}
    shards = defaultdict(set)
    for r in found:
        shards[rows[r.id]].add(r.shard)
    assert {len(s) for s in shards.values()} == {1}


@pytest.mark.parametrize("sizes, quota", [([100, 300, 1_000], 1_200), ([2] * 400 + [30] * 20, 1_200), ([3_000, 500, 2, 2], 1_200)])
def test_rounds_move_documents_to_their_neighbours(spark, sizes, quota):
    """Crossing links become fewer with each round, and without rounds most links cross."""
    rows = [f"group {g}" for g, size in enumerate(sizes) for _ in range(size)]
    rows += [f"own {i}" for i in range(8 * quota - len(rows))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)

    def cut(found):
        pairs = defaultdict(list)
        for r in found.collect():
            pairs[rows[r.id]].append(r.shard)
        return sum(len(s) - max(Counter(s).values()) for s in pairs.values())

    history = []
    gathered = cut(sharding.shard_documents(docs, 8, history=history))
    links = sum(size - 1 for size in sizes)
    assert history[0] > 0.7 * links and len(history) > 2
    assert all(a >= b for a, b in zip(history, history[1:], strict=False)) and history[-1] < history[0]
    scattered = cut(sharding.shard_documents(docs, 8, rounds=0))
    assert scattered > 0.5 * links
    # only the group that no shard holds stays cut
    assert gathered == max(0, max(sizes) - quota)
    if max(sizes) <= quota:
        assert history[-1] == 0


def test_admission_equals_a_plain_one():
    room = [10, 10, 4]
    seats, shares = sharding.admit([(1, 0, 8), (2, 0, 9), (3, 0, 40), (4, 2, 3)], {(2, 0): 1, (0, 1): 2}, room)
    # the largest first takes a whole shard; those whose wish is full go where most room is
    assert seats == {3: (0, 10 / 40), 2: (1, 1.0), 1: (2, 4 / 8), 4: (1, 1 / 3)}
    assert shares == {(0, 1): 0.0, (2, 0): 0.0}
    seats, shares = sharding.admit([(1, 0, 8)], {(0, 0): 2, (0, 1): 4, (1, 3): 5}, [11, 10])
    assert seats == {1: (0, 1.0)} and shares[1, 3] == 1.0 and shares[0, 1] == pytest.approx(0.95 * 3 / 4)


def test_upper_links_weigh_their_parts(spark):
    nodes = spark.createDataFrame([(i, "same") for i in range(1_000)], "node long, group string")
    links = sharding.group_links(nodes, 8).collect()
    parts = Counter(r.v for r in links if r.weight == 1)
    assert len(links) == 999 and sum(r.weight > 1 for r in links) == 7
    assert all(r.weight == parts[r.u] + 1 for r in links if r.weight > 1)


def test_propagation_moves_nodes_to_their_neighbours(spark):
    # two cliques, a path between them
    edges = [(a, b) for base in (0, 100) for a in range(base, base + 12) for b in range(base, a)] + [(11, 100)]
    labels = {r.node: r.label for r in sharding.propagate(spark.createDataFrame(edges, "u long, v long"), 2, [24, 24], rounds=6).collect()}
    cut = sum(labels[a] != labels[b] for a, b in edges)
    assert cut <= 1
    assert sharding.propagate(spark.createDataFrame([], "u long, v long"), 2, [1, 1]).count() == 0


def test_sharding_of_odd_tables(clashing, nothing):
    assert sharding.shard_documents(clashing).count() == clashing.count()
    assert sharding.shard_documents(nothing).count() == 0


def test_ranks_number_groups(spark):
    rows = [(i % 7 == 0, i) for i in range(1_000)]
    df = spark.createDataFrame(rows, "flag boolean, n long").select(F.when(F.col("flag"), "rare").otherwise("hot").alias("g"), "n")
    found = defaultdict(list)
    for r in ranks.ranked(df.repartition(6), "g", "n").collect():
        found[r.g].append((r.n, r.rank))
    assert all([rank for _, rank in sorted(pairs)] == list(range(len(pairs))) for pairs in found.values())


# --- mixing


def plain_schedule(weights, blocks):
    """One slot after another over all blocks: earliest deadline first among the released."""
    done, result, first = dict.fromkeys(blocks, 0), [], 0
    start = dict(done)
    slot = 0
    while any(done[s] < blocks[s] for s in blocks):
        active = [s for s in blocks if done[s] < blocks[s]]
        total = sum(weights[s] for s in active)
        if result and len(active) < alive:  # noqa: F821
            first, start = slot, dict(done)
        alive = len(active)  # noqa: F841
        at = slot - first
        ready = [s for s in active if (done[s] - start[s]) * total // weights[s] <= at]
        source = min(ready, key=lambda s: (-(-(done[s] - start[s] + 1) * total // weights[s]), s))
        result.append((source, done[source]))
        done[source] += 1
        slot += 1
    return result


@pytest.mark.parametrize("weights, blocks", [({"a": 5, "b": 3, "c": 2}, {"a": 40, "b": 40, "c": 3}), ({"a": 7, "b": 1}, {"a": 3, "b": 9}), ({"z": 1}, {"z": 4})])
def test_phases_equal_one_slot_after_another(weights, blocks):
    found = {}
    for phase in mixing.phases(weights, blocks):
        for source, count in phase.count.items():
            own = phase.slots[source]
            for k in range(count):
                found[phase.first + k // len(own) * phase.period + own[k % len(own)]] = (source, phase.start[source] + k)
    assert [found[s] for s in sorted(found)] == plain_schedule(weights, blocks)
    assert sorted(found) == list(range(sum(blocks.values())))


def test_deviation_is_less_than_one_block():
    weights = mixing.whole_weights({"a": 0.41, "b": 0.33, "c": 0.2, "d": 0.06})
    slots, total = mixing.period(weights), sum(weights.values())
    for source, weight in weights.items():
        had = np.cumsum(np.isin(np.arange(total), slots[source]))
        assert np.abs(had - np.arange(1, total + 1) * weight / total).max() < 1


def test_mix_keeps_every_row_in_its_window(documents, collected, clashing, nothing):
    found = mixing.mix(documents, block_rows=4).collect()
    assert Counter(r.carried.doc_id for r in found) == Counter(r.doc_id for r in collected)
    assert all(r.release <= r.slot < r.deadline for r in found)
    blocks = defaultdict(set)
    for r in found:
        blocks[r.slot].add((r.carried.source, r.block))
    assert all(len(b) == 1 for b in blocks.values())
    assert sorted(blocks) == list(range(len(blocks)))
    supply = Counter(r.source for r in collected)
    weights = {("n" if s is None else f"s{s}"): math.sqrt(n) for s, n in supply.items()}
    counts = {("n" if s is None else f"s{s}"): -(-n // 4) for s, n in supply.items()}
    expected = plain_schedule(mixing.whole_weights(weights), counts)
    order = [next(iter(blocks[s])) for s in sorted(blocks)]
    assert [("n" if s is None else f"s{s}", b) for s, b in order] == expected
    ordered = mixing.in_mixed_order(documents)
    assert ordered.columns == documents.columns and ordered.count() == len(collected)
    assert mixing.mix(nothing).count() == 0
    assert {r.carried["key"] for r in mixing.mix(clashing).collect()} == {"own key"}


def test_deviation_from_the_targets_stays_small_over_many_slots():
    rows = {"hot": 100_000 * 20} | {f"s{i}": (4_900 + 11 * i) * 20 for i in range(20)}
    targets = {s: math.sqrt(n) for s, n in rows.items()} | {"rare": 0.002}
    blocks = {s: -(-n // 16) for s, n in rows.items()} | {"rare": 100}
    total, worst, ended, slots = sum(targets.values()), 0, False, 0
    for source, block, slot, release, deadline in mixing.schedule(mixing.whole_weights(targets), blocks):
        share = targets[source] / total
        assert release <= slot < deadline
        worst = max(worst, slot * share - block, block + 1 - (slot + 1) * share)
        slots += 1
        if block + 1 == blocks[source]:
            break
    assert slots > 100_000 and worst < 1


def test_rare_sources_keep_their_target(spark):
    docs = spark.range(6_010).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 6_000, "common").otherwise("rare").alias("source"))
    found = mixing.mix(docs, weights={"common": 0.9995, "rare": 0.0005}, block_rows=1)
    rare = sorted(r.slot for r in found.filter("carried.source = 'rare'").collect())
    assert all(2_000 * j <= slot < 2_000 * (j + 1) for j, slot in enumerate(rare[:3]))


def test_sources_of_weight_zero_come_last():
    found = list(mixing.schedule(mixing.whole_weights({"a": 0.5, "b": 0, "c": 0.25}), {"a": 3, "b": 2, "c": 1}))
    assert [r[2] for r in found] == list(range(6)) and [r[0] for r in found[-2:]] == ["b", "b"]


def test_named_weights(documents):
    found = mixing.mix(documents, weights={"src0": 3, "src1": 1}, block_rows=1).filter("slot < 4").collect()
    assert len(found) == 4


# --- archives


PAGES = "page_id long, url string, html string, id long, key string"


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>" + "gross " * 300, "<p>é" + "x" * 998
    rows = [(i, f"https://www.Example.com:80/a/{i % 5}?q={i}#part", big if i % 3 else f"<p>{i}", i, "own") for i in range(40)]
    rows += [
        (100, "http://user@b.example.org/x y\n", other, 1, "own"), (101, None, other, 1, "own"), (102, "no url", None, 1, None),
        (103, "http://b.example.org", "", 1, None), (103, "http://b.example.org", "", 1, None), (None, "http://c.example.org/", "no id", 1, None),
        (104, "http://c.example.org/", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 60, 1, None), (105, "http://z.example.org/", "<p>" + "y" * 200_000, 1, None),
    ]
    return spark.createDataFrame(rows, PAGES).repartition(4)


def test_records_come_back(pages, monkeypatch):
    captures, index, folder = warc.archive(pages)
    found = warc.lookup(captures, index, folder, with_payload=True).collect()
    rows = pages.collect()
    largest = {}
    for r in rows:
        if len((r.html or "").encode()) >= 1000:
            largest[r.html] = max(largest.get(r.html, -1), r.page_id)
    expected = Counter()
    for r in rows:
        payload = (r.html or "").encode()
        refers = largest.get(r.html)
        revisit = refers is not None and refers != r.page_id
        expected[(r.page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", refers if revisit else None, None if revisit else payload)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found) == expected


def test_lookup_of_some_keys(spark, pages):
    captures, index, folder = warc.archive(pages)
    keys = spark.createDataFrame([("org,example,c)/",), ("com,example,www)/a/3?q=3",), ("com,none)/",), ("",), ("zz",)], "key string")
    assert sorted((r.page_id or 0) for r in warc.lookup(keys, index, folder).collect()) == [0, 3, 104]


def test_captures_of_one_key_are_read_by_many_tasks(spark):
    rows = [(i, "http://hot.example.org/", f"<p>{i}", i, "own") for i in range(3_000)]
    captures, index, folder = warc.archive(spark.createDataFrame(rows, PAGES).repartition(3))
    found = warc.lookup(captures.limit(1), index, folder).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.page_id for r in found) == list(range(3_000))
    assert len({r.task for r in found}) > 2


def test_records_are_given_on_at_a_bound():
    records = ({"payload": b"x" * n} for n in (10, 200, 5, 5, 5, 5))
    assert [len(part) for part in warc.gathered(records, rows=3, size=100)] == [2, 3, 1]
    data = warc.record(1, "http://a.b/", b"text", hashlib.sha1(b"text").hexdigest(), None, False)
    assert warc.parse(data)["payload"] == b"text" and "payload" not in warc.parse(data, with_payload=False)


def test_url_keys(spark):
    urls = ["https://www.Example.com:80/a?q=1#x", "http://u:p@b.org", None, "plain", "http://a.b.c/x\ty"]
    found = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key(F.col("url")).alias("k")).collect()
    assert [r.k for r in found] == ["com,example,www)/a?q=1", "org,b)", ")", ")plain", "c,b,a)/x%20y"]


def test_archives_of_no_pages(spark):
    captures, index, folder = warc.archive(spark.createDataFrame([], PAGES))
    assert warc.lookup(captures, index, folder).count() == 0


# --- the pipeline and the registered queries


def test_pipeline_keeps_clean_documents(spark, documents, clashing, nothing, tmp_path):
    import corpus_pipeline

    documents.write.parquet(f"{tmp_path}/in/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/in/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, f"{tmp_path}/in").write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        seen.append(after.count())
        docs = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "pfair_mixing", "byte_bpe"]
    assert documents.count() > seen[0] >= documents.filter("text rlike '[a-z]'").count() - 3
    assert seen[0] > seen[1] > seen[2] == seen[3] == seen[4]
    assert {r.exact for r in docs.collect()} == {True}
    before = spark.read.parquet(f"{tmp_path}/simhash_near_dedup")
    slots = {r.carried.doc_id: (r.slot, r.place) for r in mixing.mix(before).collect()}
    stream = [slots[r.doc_id] for r in docs.orderBy("mix_part", "mix_row").collect()]
    assert stream == sorted(stream)
    assert corpus_pipeline.run(spark, f"{tmp_path}/in").count() == seen[-1]
    for odd in (clashing, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, odd, "").columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, odd, "").count() == odd.count()


def test_each_operator_has_its_query():
    from __spark_entry__ import queries

    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries()


SQL_QUERIES = [
    "op2_warc_index", "op3_line_dedup", "op10_exact_dedup", "op11_threshold_search", "op12_spelling_variants", "op13_prefix_trie",
]


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_queries_equal_their_sql(spark, name):
    from quarry.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    expected = comparable(cursor.fetchall(), [d[0] for d in cursor.description])
    found = QUERIES[name](spark, SMALL)
    assert comparable(found.collect(), found.columns) == expected


def test_the_library_works_without_this_part(tmp_path):
    root = Path(__file__).resolve().parents[2]
    code = """
import importlib.abc, json, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "quarry.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__
print(json.dumps(sorted(__spark_entry__.queries())))
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    names = json.loads(out.strip().splitlines()[-1])
    assert "daily_sales" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)

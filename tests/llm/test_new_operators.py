"""Prefix tries, hard negatives and SimHash against plain Python: nulls, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import math
import os
import random
import zlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from marketpulse.llm import hard_negatives, prefix_trie, simhash
from marketpulse.llm.jaccard_join import components
from marketpulse.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


# --- conversation prefixes


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        # Remainders as in SQL: towards zero.
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(o[:-1] == m for o in members if o)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(map(str, sorted(c for c in convs if rebuilt[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = "conv_id bigint, turn int, role string, text string, low bigint, depth string, shard int"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "d", 1) for r in rows], TURNS)


def random_turns(seed, convs, vocabulary, most):
    draw = random.Random(seed)
    rows = [(c, t, draw.choice(["u", "a"]), draw.choice(["", "é", "x" * 20, "yes"][:vocabulary])) for c in range(convs) for t in range(draw.randrange(1, most))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("nodes_per_shard, levels", [(1 << 18, 1 << 16), (9, 3), (5, 1)])
def test_trie_equals_enumeration(spark, monkeypatch, nodes_per_shard, levels):
    monkeypatch.setattr(prefix_trie, "LEVELS", levels)
    rows = random_turns(1, 60, 2, 14)
    rows += [(61, None, None, None), (61, None, "u", "x"), (61, 3, None, "é"), (62, 1, "u", "x"), (62, 1, "u", "x"), (None, 0, "u", "lost")]
    rows += [(105, 0, "u", "only"), (-5, 0, "u", "below zero"), (-7, 2, "u", "below zero"), (10**12, 0, "", "")]
    frame = turns_frame(spark, rows).repartition(3)
    got = sorted(map(tuple, prefix_trie.build_trie(frame, nodes_per_shard).collect()), key=repr)
    assert got == plain_trie(rows)


def test_long_conversations_and_many_copies(spark, monkeypatch):
    """A conversation longer than a unit, and a hundred copies that end where it begins; ids are joined in pieces."""
    monkeypatch.setattr(prefix_trie, "LEVELS", 8)
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 7)
    rows = [(5, t, "u", f"t{t % 3}") for t in range(150)]
    rows += [(5 * c, t, "u", f"t{t % 3}") for c in range(2, 103) for t in range(4)]
    got = sorted(map(tuple, prefix_trie.build_trie(turns_frame(spark, rows).repartition(4), 30).collect()), key=repr)
    assert got == plain_trie(rows) and max(r[1] for r in got) == 150


def test_tries_of_little(spark):
    frame = turns_frame(spark, [(3, 0, "u", "a")])
    assert prefix_trie.build_trie(frame.limit(0)).count() == 0
    assert prefix_trie.build_trie(turns_frame(spark, [(None, 0, "u", "a")])).count() == 0
    # Its family's first conversation is absent, and its one turn is below the cut: a member without a turn.
    assert sorted(map(tuple, prefix_trie.build_trie(frame).collect()), key=repr) == plain_trie([(3, 0, "u", "a")])


def test_slots_are_minimal_and_verified():
    import numpy as np

    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        h1, h2 = draw.integers(-(2**63), 2**63 - 1, size=(2, n))
        table = prefix_trie.NodeTable(h1, h2)
        assert sorted(table.slots(h1, h2)) == list(range(n))
        assert (table.slots(h1 + 1, h2) == -1).all()
    with pytest.raises(ValueError, match="twice"):
        prefix_trie.NodeTable(np.array([1, 1]), np.array([2, 2]))


def test_running_folds_over_parts(spark):
    rows = [(k, i) for k, n in ((1, 500), (2, 3), (3, 1)) for i in range(n)]
    frame = spark.createDataFrame(rows, "k int, i int").repartition(5)
    folds = {"nth": ("count", F.lit(1)), "mix": ("bit_xor", F.xxhash64("i"))}
    got = prefix_trie.running(frame, "k", [F.col("i")], folds).collect()
    mixed = {r["i"]: r["h"] for r in frame.select("i", F.xxhash64("i").alias("h")).distinct().collect()}
    assert len(got) == len(rows)
    for r in got:
        expected = 0
        for i in range(r["i"] + 1):
            expected ^= mixed[i]
        assert (r["nth"], r["mix"]) == (r["i"] + 1, expected)


# --- hard negatives


def plain_negatives(rows, positives=5, negatives=5):
    vectors = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
               if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor in sorted({i for i, _, _ in vectors if i % 100 == 0}):
        _, label, own = min(v for v in vectors if v[0] == anchor)
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i, lab) for i, lab, v in vectors if i != anchor)
        for s, i, _ in [x for x in scored if x[2] == label][:positives]:
            window = [(n, j) for n, j, lab in scored if lab != label and 80 * -s <= 100 * -n <= 100 * -s]
            out += [(anchor, i, k, j, -s, -n) for k, (n, j) in enumerate(window[:negatives], 1)]
    return sorted(out)


VECTORS = "vec_id bigint, embedding array<float>, label int, id string, g int, score double"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, 0.5) for i, lab, v in rows], VECTORS)


def mined(frame, **how):
    return sorted(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, **how).collect()))


@pytest.mark.parametrize("block_bytes", [16 << 20, 100])
def test_hard_negatives_equal_all_pairs(spark, block_bytes):
    draw = random.Random(2)
    rows = [(i, draw.randrange(3), [draw.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(3)]) for i in range(420)]
    rows += [(500, None, [1.0] * 3), (600, 1, None), (700, 1, [1.0, None, 1.0]), (800, 1, [1.0, float("nan"), 0.0]), (900, 1, [float("inf")] * 3)]
    rows += [(1000, 1, []), (None, 1, [1.0] * 3), (-100, 2, [-1.0, -0.3, 0.1])]
    frame = vectors_frame(spark, rows).repartition(4)
    expected = plain_negatives(rows)
    assert mined(frame, block_bytes=block_bytes) == expected and len(expected) > 50


def test_anchors_without_partners(spark):
    alone = vectors_frame(spark, [(0, 1, [1.0, 2.0]), (1, 2, [1.0, 2.0])])
    assert mined(alone) == [] and mined(alone.limit(0)) == []
    assert mined(vectors_frame(spark, [(1, 1, [1.0]), (2, 2, [1.0])])) == []
    # The frequent length counts; vectors whose score would not fit are left out.
    rows = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 1.0]), (2, 2, [1.0, 0.9]), (3, 2, [1.0] * 3), (4, 2, [3e30, 1.0])]
    assert mined(vectors_frame(spark, rows)) == plain_negatives(rows[:3])


@pytest.mark.parametrize("scale, width", [(3, 1), (300, 64), (1 << 20, 64), (1 << 28, 8), (5000, 5000)])
def test_residues_give_exact_scores(scale, width):
    import numpy as np

    draw = np.random.default_rng(1)
    a, b = (draw.integers(-scale, scale, size=(n, width)) for n in (9, 12))
    bound = int(max((m.astype(object) ** 2).sum(axis=1).max() for m in (a, b)))
    primes = hard_negatives.primes_for(width, bound)
    product = 1
    for p in primes:
        product *= p
        assert min(width, hard_negatives.INNER) * (p // 2) ** 2 < 1 << 24
    assert product > 2 * bound + 1
    scores = hard_negatives.exact_scores(*[[hard_negatives.residues(m, p) for p in primes] for m in (a, b)], primes)
    assert (scores == a.astype(object) @ b.astype(object).T).all()


# --- SimHash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), seed=42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=2):
    """[(id, fingerprint, component)] of (id, fingerprint) rows, by comparing every pair."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(key, low.get(find(i), key))
    return sorted(((key, f"{fp:016x}", low.get(find(i))) for i, (key, fp) in enumerate(rows)), key=repr)


def test_simhash_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op13_simhash"](spark, SF_DIR).collect()), key=repr)
    assert got == plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in docs])


def test_simhash_of_odd_rows(spark):
    base = " ".join(random.Random(1).choices("abcdefghijk", k=40))
    texts = [(1, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, " \n\x0b "), (7, "one two"), (8, "ONE\ttwo"), (None, base), (None, "alone, no id"),
             (9, "ß Ünï \x1c   x"), (10, "word " * 100_000), (11, "x" * 300_000), (2, base), (12, "one two three four one two three four one two three")]
    frame = spark.createDataFrame([(k, t, 1, "c") for k, t in texts], "doc_id bigint, text string, fp int, fingerprint string").repartition(3)
    got = sorted(map(tuple, simhash.link_documents(frame).collect()), key=repr)
    assert got == plain_components([(k, plain_fingerprint(t)) for k, t in texts])
    assert simhash.link_documents(frame.limit(0)).count() == 0


def scattered(seed, groups, size, flips):
    draw, found = random.Random(seed), set()
    for _ in range(groups):
        centre = draw.getrandbits(64)
        for _ in range(size):
            x = centre
            for _ in range(draw.randrange(flips)):
                x ^= 1 << draw.randrange(64)
            found.add(x)
    return sorted(found)


@pytest.mark.parametrize("distance, group_rows, probe_cost, least", [(2, 1 << 14, 300, 0), (2, 5, 300, 0), (2, 40, 0, 1), (1, 3, 0, 1), (3, 1 << 14, 0, 1), (0, 9, 300, 0)])
def test_links_equal_all_pairs(spark, monkeypatch, distance, group_rows, probe_cost, least):
    """Plans with and without probes, and groups that are split again and again, link the same fingerprints."""
    monkeypatch.setattr(simhash, "PROBE_COST", probe_cost)
    plans, planned = [], simhash.plan
    monkeypatch.setattr(simhash, "plan", lambda *a: plans.append(planned(*a)) or plans[-1])
    fps = scattered(distance + 1, 5, 90, 6)
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp bigint").repartition(3)
    roots = {r["c"]: r["root"] for r in components(simhash.links_between(frame, distance, group_rows)).collect()}
    groups = defaultdict(list)
    for f in fps:
        groups[roots.get(simhash.signed(f), simhash.signed(f))].append(f)
    got = sorted((f, f"{f:016x}", min(g)) for g in groups.values() for f in g)
    assert got == sorted(plain_components([(f, f) for f in fps], distance))
    assert max(t for _, t in plans[0]) >= least


def test_thresholds_are_allotted_at_least_cost():
    import itertools

    draw = random.Random(4)
    for m in range(1, 6):
        costs = [[0.0, *sorted(draw.random() * 10 for _ in range(3))] for _ in range(m)]
        best = min(sum(c[t + 1] for c, t in zip(costs, ts)) for ts in itertools.product((-1, 0, 1, 2), repeat=m) if sum(ts) == 2 - m + 1)
        cost, thresholds = simhash.allot(costs, 2 - m + 1)
        assert abs(cost - best) < 1e-9 and sum(thresholds) == 2 - m + 1


def test_bits_that_go_together_share_a_part(spark):
    draw = random.Random(6)
    fps = []
    for _ in range(3000):
        x = draw.getrandbits(64)
        # Bits 40 to 60 follow bit 3.
        x = (x & ~(((1 << 21) - 1) << 40)) | ((((1 << 21) - 1) << 40) if x >> 3 & 1 else 0)
        fps.append(x)
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp bigint")
    together = simhash.bits_together(frame)
    assert together[3, 45] == sum(f >> 3 & 1 for f in fps) and together[1, 2] == sum((f >> 1 & 1) & (f >> 2 & 1) for f in fps)
    parts = simhash.parts_of(together, len(fps), 3)
    assert any(set(range(40, 60)) <= set(p) for p in parts) and sorted(b for p in parts for b in p) == list(range(64))
    equal = simhash.pairs_that_meet(frame, [(1 << 64) - 1, 0xF])
    counts = defaultdict(int)
    for f in fps:
        counts[f & 0xF] += 1
    assert abs(equal[0] / len(fps) - 1) < 0.2 and abs(equal[1] / sum(n * n for n in counts.values()) - 1) < 0.5


def test_hashing_memory_is_bounded():
    # However much text comes in a batch, hashing keeps to a few dozen times the buffer, and the buffer changes no token.
    import tracemalloc

    import pyarrow as pa

    from marketpulse.llm import jaccard_join

    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(9000)}" for _ in range(draw.randrange(2000))) for _ in range(1200)] + [None, "", " \t", "A a B"]
    column = pa.array(texts)
    alone = [tokens.tobytes() for text in texts[:20] + texts[-4:] for tokens in jaccard_join.shingler(4)(pa.array([text], pa.string()))]
    tracemalloc.start()
    try:
        tokens = [t.tobytes() if k < 20 or k >= len(texts) - 4 else None for k, t in enumerate(jaccard_join.shingler(4)(column))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(t or "") for t in texts) > 5_000_000
    assert [t for t in tokens if t is not None] == alone
    assert peak < 64 << 20


def test_pipeline_looks_up_a_bounded_table(spark, monkeypatch):
    # The table of looked-up words passes the driver: the pipeline's is the smaller one, and ids do not depend on it.
    import public_tokenizers

    import corpus_pipeline
    from marketpulse.llm import byte_bpe
    from marketpulse.llm.queries import bpe_digest

    draw = random.Random(6)
    words = [f"{draw.choice('abcdefgh')}{k}xyz" for k in range(120)]
    rows = [(k, " ".join(draw.choice(words) for _ in range(40))) for k in range(30)] + [(30, None), (31, ""), (31, ""), (None, words[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    taken = []
    find = byte_bpe.frequent_words
    monkeypatch.setattr(byte_bpe, "frequent_words", lambda *a, **b: (found := find(*a, **b), taken.append(found[1]))[0])
    assert 4 * corpus_pipeline.LOOKED_UP_WORDS <= byte_bpe.FREQUENT_WORDS
    monkeypatch.setattr(corpus_pipeline, "LOOKED_UP_WORDS", 50)
    bounded = sorted(map(str, corpus_pipeline.encoded(spark, docs, SF_DIR).collect()))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    whole = sorted(map(str, bpe_digest(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()))
    assert bounded == whole and taken[0] <= 50 < taken[1]

"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

from __future__ import annotations

import os
import random
import sys
import zlib

import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from marketpulse.llm import (  # noqa: E402
    byte_bpe, common, jaccard_join, ordinal_quality, perspectives, positional, quality_votes, sharding, token_counts, toxic_spans,
    url_rules,
)
from marketpulse.llm.queries import GRADE, URL_RULES  # noqa: E402

# Columns beyond doc_id and text carry names that the operators use themselves.
DOCS = "doc_id bigint, text string, c string, n int, score double, _bucket string, ids string, shard int, label int"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


BASE = prose(1, 80, 100_000)
LONG = prose(2, 30_000, 100_000)
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE + " added"), (4, BASE.upper()), (5, None), (6, ""), (7, " \n\t "), (8, "one two"),
    (9, "ONE\ntwo"), (10, LONG), (11, LONG + " more"), (12, "Ünï ß ǰ \U0001f600 <|endoftext|> don't"), (None, "no id here at all"),
    (None, None), (13, BASE), (13, BASE), (14, "x" * 200_000), (15, "a  b\r\n\r\n c\u00a0d 12345 -- !!"),
]


def table(spark, rows=TEXTS):
    return spark.createDataFrame([(k, t, "c", 1, 0.5, "b", "i", 3, 4) for k, t in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).repartition(3).cache()


def pairs(rows):
    return sorted(rows, key=repr)


def test_sharding(spark, docs):
    rows = sharding.shuffle_shards(docs, 5, bucket_bytes=50_000).collect()
    assert pairs((r["doc_id"], r["text"]) for r in rows) == pairs(TEXTS)
    sizes = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(5)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    again = sharding.shuffle_shards(docs.repartition(7), 5, bucket_bytes=50_000).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert sharding.shuffle_shards(docs.limit(0), 5).count() == 0


def test_copies_of_one_record_are_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_PER_RUN", 100)
    rows = [(1, "same text")] * 1005 + [(i, prose(i, 3)) for i in range(2, 500)] + [(None, None)] * 1500
    frame = table(spark, rows).repartition(4)
    docs = frame.withColumn("_n", frame["n"])
    sizes, held = [], sharding.bucket_sizes
    monkeypatch.setattr(sharding, "bucket_sizes", lambda *a: sizes.append(held(*a)) or sizes[-1])
    got = sharding.shuffle_shards(docs, 7, bucket_bytes=2000).collect()
    assert max(size for _, size in sizes[0].values()) > 10_000 and max(size for _, size in sizes[-1].values()) < 4000
    assert pairs((r["doc_id"], r["text"]) for r in got) == pairs(rows)
    slots = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(7)]
    assert all(s == list(range(len(s))) for s in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1
    assert pairs(sharding.shuffle_shards(docs.repartition(9), 7, bucket_bytes=2000).collect()) == pairs(got)


def test_shards_are_written_in_order(spark, docs, tmp_path):
    plain = docs.select("doc_id", "text")
    sharding.write_shards(sharding.shuffle_shards(plain, 3), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(TEXTS)


def test_url_rules(spark):
    urls = [
        ("http://A.Example.ORG/es/x", "example.org/es/", "block"), ("http://example.org/en/12", "example.org/en/1", "block"),
        ("http://example.org/en/2", "org/", "allow"), ("http://example.org", None, "allow"), (None, None, "allow"), ("", None, "allow"),
        ("no scheme", None, "allow"), ("x://badexample.org/es/", "org/", "allow"), ("ftp://m.y.com/de/?q=/fr/", "com/de/", "block"),
        ("http://com/fr/#a://b.org/", "com/fr/", "allow"), ("http://a.net?x=1/2", None, "allow"), ("a\nb://q.org/x", "org/", "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "r") for i, (u, _, _) in enumerate(urls)], "page_id int, url string, rule string")
    got = {r["page_id"]: r for r in url_rules.judge(pages, URL_RULES).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))] == [(r, v) for _, r, v in urls]
    assert (got[0]["host"], got[0]["path"], got[3]["path"], got[4]["host"], got[10]["host"]) == ("a.example.org", "/es/x", "", "", "a.net")
    assert url_rules.judge(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_rules.judge(pages, []).collect()} == {"allow"}


def test_long_hosts(spark):
    hosts = ["a." * 100_000 + "example.org", "." * 100_000 + "com", "a" * 1_000_000, "a." * 50_000]
    pages = spark.createDataFrame([(i, f"http://{h}/es/") for i, h in enumerate(hosts)], "page_id int, url string")
    got = {r["page_id"]: (r["host"], r["rule"]) for r in url_rules.judge(pages, URL_RULES).collect()}
    assert [got[i] for i in range(4)] == list(zip(hosts, ["example.org/es/", None, None, None]))


def test_equal_digests_are_told_apart(spark, tmp_path, monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda _: 7)
    name = url_rules.build_index(spark, [("block", "a.org", "/"), ("allow", "b.org", "/")])
    from pyspark import SparkFiles

    index = url_rules.DigestArray(SparkFiles.get(name))
    found = index.find(["b.org/", "c.org/", "a.org/"])
    assert [index.stored(k).decode() if k >= 0 else None for k in found] == ["b.org/", None, "a.org/"]


def test_token_counts(spark, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected = pairs((k, len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in TEXTS)
    for options in ({}, {"frequent": 3, "cached": 2}):
        rows = token_counts.count_tokens(docs, path, **options).collect()
        assert pairs((r["doc_id"], r["n_tokens"]) for r in rows) == expected
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


def test_token_counts_of_odd_characters(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    draw = random.Random(3)
    letters = [chr(c) for c in [*range(0x180), 0x301, 0x3A3, 0x4E2D, 0x1F600, 0x2028]]
    texts = ["".join(draw.choices(letters, k=60)) for _ in range(300)] + ["don't I'LL 'S x's 'sx ''s", "<|startoftext|>a", "<|ENDOFTEXT|>"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(frame, path).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_bpe_of_odd_characters(spark):
    import tiktoken

    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(4)
    letters = [chr(c) for c in [*range(0x250), 0x301, 0x3A3, 0x4E2D, 0x1F600, 0x2028, 0x3000]]
    texts = [t for _, t in TEXTS] + ["".join(draw.choices(letters, k=40)) for _ in range(200)]
    # Long pieces: runs, repeated pairs that overlap, and letters without order; and what the table of words keeps apart.
    texts += ["ab" * 5000, "aaab" * 777, "".join(draw.choices("aab", k=3000)), "".join(draw.choices("etaoin", k=2000)), " " * 3000 + "x", "é" * 900]
    texts += ["a\x00b \x01c a\x00b \x01c", "\x01", "\x00\x00 \x01\x01"] * 2
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    encoded = byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN)
    rows = encoded.select("doc_id", "ids", byte_bpe.decode(encoded["ids"], RANKS).alias("bytes")).collect()
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == " ".join(map(str, library.encode_ordinary(text)))
        assert bytes(r["bytes"]) == text.encode()
    assert byte_bpe.encode(frame.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    # The ranks are no part of the plan: each of its descriptions would hold them.
    assert len(encoded._jdf.queryExecution().toString()) < 500_000


def test_quality_votes(spark, docs):
    rows = quality_votes.judge(docs).collect()
    got = pairs((r["doc_id"], (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])) for r in rows)
    assert got == pairs((k, brute.base_metrics(t)) for k, t in TEXTS)
    assert quality_votes.judge(docs.limit(0)).count() == 0


def test_repeated_windows(spark):
    texts = [prose(s, n, v) for s, n, v in [(1, 60, 2), (2, 200, 3), (3, 500, 4), (4, 9, 1), (5, 8, 1), (6, 7, 1)]]
    texts += [(BASE + "\n") * 3, "a b\na b\n\n \na b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r for r in quality_votes.metrics(frame).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_symbols"], got[i]["n_dup_lines"], got[i]["n_repeat_words"]) == brute.base_metrics(t)


def test_rules_are_weighed(spark):
    """Two rules that agree with the truth outvote one that guesses, once EM has seen how they go together."""
    draw = random.Random(5)
    counts = {}
    for _ in range(20_000):
        truth = 1 if draw.random() < 0.7 else -1
        ballot = tuple(truth if draw.random() < a else -truth for a in (0.95, 0.9, 0.9, 0.55))
        counts[ballot] = counts.get(ballot, 0) + 1
    frame = spark.createDataFrame([(list(b), n) for b, n in counts.items()], "ballot array<int>, n bigint")
    learned = quality_votes.estimate(frame, 4).first()
    assert abs(learned["share"] - 0.7) < 0.05
    assert all(abs(a - b) < 0.05 for a, b in zip(learned["accuracies"], (0.95, 0.9, 0.9, 0.55)))


def test_components(spark, docs):
    got = pairs(tuple(r) for r in jaccard_join.link_documents(docs, 4, 85).collect())
    assert got == pairs(brute.components(TEXTS, 4, 85))
    assert jaccard_join.link_documents(docs.limit(0)).count() == 0


def test_classes_of_two_components_meet_once(spark):
    """Three classes have two tokens in common; none of the first two is in the largest component of either group."""
    bits = [0] * jaccard_join.BITMAP
    rows = [
        (token, bytes([c]), 100, at, bytes([c]), b"\x09", [7, 8] if c < 3 else [at and 8 or 7], bits)
        for at, token in enumerate((7, 8)) for c in (1, 2, 9)
    ]
    schema = "token bigint, c binary, n int, at int, root binary, main binary, tokens array<bigint>, bits array<bigint>"
    met = jaccard_join.meetings(spark.createDataFrame(rows, schema), 85).collect()
    # The last class lists other tokens in either group, so its pairs come twice there, which is allowed, but no other does.
    assert sorted((r["a"][0], r["b"][0]) for r in met if r["b"][0] == 2) == [(1, 2)]
    assert {(r["a"][0], r["b"][0]) for r in met} == {(1, 2), (1, 9), (2, 9)}


def test_components_of_edited_copies(spark):
    draw = random.Random(6)
    rows = []
    for g in range(12):
        base = prose(100 + g, draw.choice([12, 30, 60, 120]), 50 if g % 2 else 5000).split()
        for _ in range(15):
            copy = list(base)
            for _ in range(draw.randrange(4)):
                copy[draw.randrange(len(copy))] = f"e{draw.randrange(1000)}"
            rows.append((len(rows), " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for n, percent in ((4, 85), (5, 80), (2, 60)):
        got = sorted(tuple(r) for r in jaccard_join.link_documents(frame, n, percent).collect())
        assert got == sorted(brute.components(rows, n, percent))


def test_contamination(spark, docs):
    items = [(1, " ".join(BASE.split()[5:30])), (2, "one two"), (3, None), (4, ""), (5, "x y z"), (5, "x y z"), (6, "Ünï ß")]
    frame = spark.createDataFrame([(k, t, "p") for k, t in items], "item_id bigint, text string, phrase string")
    rows = positional.contamination(docs, frame).collect()
    got = pairs((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows)
    assert [g[:3] for g in got] == [g[:3] for g in pairs(
        (k, *(brute.contamination(t, items)[:2]), tuple(sorted({str(i) for i, x in items if brute.contamination(t, [(i, x)])[1]})))
        for k, t in TEXTS
    )]
    assert {r["n_hit"] for r in positional.contamination(docs, frame.limit(0)).collect()} == {0}
    assert positional.contamination(docs.limit(0), frame).count() == 0


def test_proximity(spark):
    frame = spark.createDataFrame([(1, "alpha x beta gamma delta"), (2, "alpha beta gamma delta"), (3, "delta")], "doc_id int, text string")
    items = spark.createDataFrame([(9, "alpha beta gamma delta")], "item_id int, text string")
    got = {r["doc_id"]: (r["n_hit"], r["near_items"]) for r in positional.contamination(frame, items).collect()}
    assert got == {1: (0, 1), 2: (4, 1), 3: (0, 0)}


def test_perspectives(spark):
    rows = [
        (1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 1, "bob", None), (1, 2, None, "who"), (1, None, "system", "be <|im_start|> kind"),
        (2, 0, "system", "alone"), (None, 0, "cy d", "x"), (1, 300, "ann", "later"),
    ]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("part", perspectives.F.lit("?"))
    got = {(r["conv_id"], r["participant"], r["part"]): r for r in perspectives.rotate(turns).collect()}
    assert set(got) == {(1, p, k) for p in ("ann", "bob") for k in (-1, 0, 1)} | {(2, None, 0), (None, "cy d", 0)}
    r = got[(1, "ann", 0)]
    assert r["text"] == (
        "<|im_start|>assistant\nhi<|im_end|>\n" + "<|im_start|>user name=bob\n<|im_end|>\n" * 2 + "<|im_start|>user\nwho<|im_end|>\n"
    )
    assert [r["text"][m["start"] : m["end"]] for m in r["mask"]] == ["hi"]
    assert "<|im_start|>" not in got[(1, "bob", -1)]["text"][12:]
    assert perspectives.rotate(turns.limit(0)).count() == 0


def test_over_full_parts_are_cut(spark):
    """No number, no conversation, one repeated turn, one repeated row: pieces are bounded and read as the whole part."""
    rows = [(1, None, "ann", f"a{i}") for i in range(57)] + [(1, 3, "bob", "b")] + [(1, 700, "ann", "late"), (2, 0, "ann", "x")]
    rows += [(None, i % 8, r, f"n{i % 9}") for i in range(101) for r in ("ann", None, "system")] + [(3, 5, "cy", "same")] * 95
    rows += [(3, 5, None, None)] * 3 + [(3, 6, "di", "end"), (3, 300, "di", None)] + [(3, 600, "di", str(i)) for i in range(25)]
    schema = "conv_id int, turn int, role string, text string"
    turns = spark.createDataFrame(rows, schema).repartition(5)
    whole, cut = {}, {}
    for out, bound in ((whole, 1000), (cut, 10)):
        for r in sorted(perspectives.rotate(turns, rows_per_part=bound).collect(), key=lambda r: r["part"]):
            assert r["n_turns"] <= bound
            out.setdefault((r["conv_id"], r["participant"]), []).append(r)
    assert set(whole) == set(cut)
    for key, parts in cut.items():
        assert len({r["part"] for r in parts}) == len(parts)
        assert "".join(r["text"] for r in parts) == "".join(r["text"] for r in whole[key])
        masked = [[r["text"][m["start"] : m["end"]] for r in rows for m in r["mask"]] for rows in (parts, whole[key])]
        assert masked[0] == masked[1]
    assert [r["part"] for r in cut[1, "ann"]] == [-1, 0, 1, 2, 3, 4, 5, 7]
    assert [r["part"] for r in cut[2, "ann"]] == [0]
    assert [r["n_turns"] for r in cut[3, "di"]] == [10] * 9 + [9, 1, 10, 10, 5]
    again = perspectives.rotate(turns.repartition(2), rows_per_part=10).collect()
    assert pairs(again) == pairs(r for parts in cut.values() for r in parts)
    hot = spark.createDataFrame([(None, None, "ann", "x")] * (perspectives.ROWS_PER_PART + 1), schema)
    assert max(r["n_turns"] for r in perspectives.rotate(hot).collect()) <= perspectives.ROWS_PER_PART


LABELS = "doc_id bigint, quality int, toxic int, text string"


def labelled(spark):
    """Documents of which the odd are poor, and every fifth holds one of two bad words."""
    rows = []
    for i in range(400):
        text = prose(1000 + i, 60)
        if i % 2:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if i % 5 == 0:
            text += " vilest word" if i % 10 else " scoundrel here"
        rows.append((i, text))
    labels = [(i, 1 - i % 2, int(i % 5 == 0), "z") for i, _ in rows]
    return rows, spark.createDataFrame(labels + [(None, 1, 1, "z"), (7, None, None, "z"), (0, 1, 1, "z")], LABELS)


def test_ordinal_quality(spark, docs):
    rows, labels = labelled(spark)
    frame = table(spark, rows + TEXTS)
    model = ordinal_quality.train(frame, labels, GRADE, 3)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = ordinal_quality.score(frame, model).where("doc_id >= 20").collect()
    assert sum((r["tail"] >= 0.5) == (r["doc_id"] % 2 == 0) for r in got) / len(got) > 0.95
    assert ordinal_quality.score(frame, model).count() == len(rows) + len(TEXTS)
    empty = ordinal_quality.train(frame, labels.limit(0), GRADE, 3)
    assert all(r["tail"] > 0.5 for r in ordinal_quality.score(docs, empty).collect())
    assert ordinal_quality.score(docs.limit(0), model).count() == 0


def test_toxic_spans(spark, docs):
    rows, labels = labelled(spark)
    frame = table(spark, rows)
    model = toxic_spans.train(frame, labels)
    got = {r["doc_id"]: r for r in toxic_spans.score(frame, model).collect()}
    for key, text in rows:
        assert (got[key]["score"] >= 0.7) == (key % 5 == 0)
        spans = {text[s["start"] : s["end"]] for s in got[key]["spans"]}
        assert not spans or spans & {"scoundrel", "vilest", "scoundrel here", "vilest word", "VILEST", "SCOUNDREL"}
    assert toxic_spans.score(docs, model).count() == len(TEXTS)
    assert toxic_spans.score(docs.limit(0), model).count() == 0
    nothing = toxic_spans.train(frame, labels.where("toxic = 0"))
    assert all(r["score"] < 0.1 for r in toxic_spans.score(frame, nothing).collect())


def test_large_labelled_texts_are_passed_over(spark):
    """Texts beyond the bytes of a sample, and repeated rows, leave the others to learn from."""
    rows, labels = labelled(spark)
    frame = table(spark, [(k, (t + " ") * 400 if k % 10 in (0, 3) else t) for k, t in rows] + rows[:40])
    model = toxic_spans.train(frame, labels, sample_bytes=15_000)
    assert model.weights.any()
    got = {r["doc_id"]: r["score"] for r in toxic_spans.score(frame, model).collect()}
    assert all((got[k] >= 0.7) == (k % 5 == 0) for k in got if k % 10 not in (0, 3))
    assert ordinal_quality.train(frame, labels, GRADE, 3, sample_bytes=15_000).weights.any()


def test_samples_take_each_document_once_within_their_bounds(spark):
    rows, labels = labelled(spark)
    own = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 != 1}
    frame = table(spark, [*rows, *rows, (None, "no id")])
    flag = toxic_spans.F.col("toxic")
    whole = common.labelled_sample(frame, labels, flag, 1000, 1 << 20).collect()
    assert pairs(r["text"] for r in whole) == pairs(t for k, t in rows if k in own)
    some = [r["text"] for r in common.labelled_sample(frame.repartition(5), labels, flag, 1000, 5000).collect()]
    least = min(len(t) for k, t in rows if k in own and t not in some)
    assert sum(map(len, some)) <= 5000 < sum(map(len, some)) + least
    assert common.labelled_sample(frame, labels, flag, 7, 1 << 20).count() == 7


def test_samples_without_a_document_are_refused(spark):
    rows, labels = labelled(spark)
    frame = table(spark, rows)
    with pytest.raises(ValueError, match="fits"):
        toxic_spans.train(frame, labels, sample_bytes=100)
    with pytest.raises(ValueError, match="fits"):
        ordinal_quality.train(frame, labels, GRADE, 3, sample_bytes=100)
    with pytest.raises(ValueError, match="both kinds"):
        toxic_spans.train(frame.where("doc_id % 5 > 0"), labels)
    with pytest.raises(ValueError, match="no labelled document"):
        ordinal_quality.train(frame.withColumn("doc_id", frame["doc_id"] + 1000), labels, GRADE, 3)
    toxic_spans.train(frame.limit(0), labels)
    ordinal_quality.train(frame.limit(0), labels, GRADE, 3)


def test_messages_equal_enumeration():
    """Marginals of short chains against a sum over all taggings."""
    import itertools

    import numpy as np

    draw = np.random.default_rng(7)
    transition = draw.normal(size=(2, 2))
    potential, first = draw.normal(size=9), np.array([1, 0, 0, 0, 1, 1, 0, 0, 0], dtype=bool)
    p = toxic_spans.marginals(potential, first, transition)[0]
    weight, total = np.zeros(9), 0.0
    for tags in itertools.product((0, 1), repeat=9):
        w = sum(potential[i] * t for i, t in enumerate(tags))
        w += sum(transition[tags[i - 1], tags[i]] for i in range(9) if not first[i])
        total += np.exp(w)
        weight += np.exp(w) * np.array(tags)
    assert np.allclose(p, weight / total)


def test_pipeline_stages_one_by_one(spark, tmp_path):
    """Each stage against plain Python on what the stage before it kept, and the columns of documents on the way."""
    from marketpulse.llm.common import table as read

    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    docs = read(spark, sf_dir, "documents")
    items = [tuple(r) for r in read(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    columns = docs.columns
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.select("doc_id", "text").collect()
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs.count())
        if k < 4:
            assert docs.columns == columns
        ids = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        if k == 2:
            assert ids == sorted(key for key, _, low in brute.components([tuple(r) for r in before], 5, 80) if key == low)
        if k == 3:
            assert ids == sorted(key for key, text in before if not brute.contamination(text, items)[1])
        if k == 4:
            assert ids == sorted(key for key, _ in before)
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[-1]


def test_pipeline_on_odd_rows(spark, docs):
    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() >= 0
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    stayed = [r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, sf_dir).collect()]
    assert stayed.count(13) == 0 and 1 in stayed and 2 not in stayed

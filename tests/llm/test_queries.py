"""Every operator's query over whole tables: against SQL where SQL expresses it, and against plain Python."""

from __future__ import annotations

import hashlib
import os
import sys
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from marketpulse.llm.oracle import ORACLES  # noqa: E402
from marketpulse.llm.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def held_out(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = Counter(tuple(row) for row in result.select(*columns).collect())
    cursor = duck.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall())
    assert ours and ours == theirs


def test_quality_is_learned(spark, duck):
    rows = {r["doc_id"]: r for r in QUERIES["op1_ordinal_quality"](spark, SF_DIR).collect()}
    assert len(rows) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    labels = duck.execute("SELECT doc_id, quality FROM labels").fetchall()
    test = [(rows[k]["tail"], q) for k, q in labels if held_out(k)]
    good, bad = [s for s, q in test if q], [s for s, q in test if not q]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.8
    assert sum(s >= 0.5 for s in good) / len(good) > 0.9
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail"] <= 1 for r in rows.values())


def test_shards_hold_every_row_once(spark, documents):
    rows = QUERIES["op3_sharding"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    for r in rows:
        data = (documents[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_token_counts_equal_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in QUERIES["op5_token_counts"](spark, SF_DIR).collect():
        text = documents[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_base_metrics(spark, documents):
    rows = QUERIES["op6_quality_votes"](spark, SF_DIR).collect()
    assert len(rows) == len(documents)
    for r in rows:
        expected = brute.base_metrics(documents[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_votes_tell_bad_from_good(spark, duck):
    """The labels were never seen; of documents that pass the base rule, bad ones go and good ones stay."""
    rows = {r["doc_id"]: r for r in QUERIES["op6_quality_votes"](spark, SF_DIR).collect() if not r["base_failed"]}
    labels = duck.execute("SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL").fetchall()
    bad, good = ([rows[k]["kept"] for k, quality in labels if quality == q and k in rows] for q in (0, 1))
    assert sum(bad) <= 0.15 * len(bad) and sum(good) >= 0.97 * len(good)


def test_components_equal_all_pairs(spark, documents):
    rows = sorted(documents.items())
    ours = sorted(tuple(r) for r in QUERIES["op7_jaccard_join"](spark, SF_DIR).collect())
    theirs = sorted(brute.components(rows, 4, 85))
    assert ours == theirs
    assert any(component != key for key, _, component in ours)


def test_toxicity_is_learned(spark, duck):
    rows = {r["doc_id"]: r for r in QUERIES["op8_toxic_spans"](spark, SF_DIR).collect()}
    labels = duck.execute("SELECT doc_id, toxic FROM labels").fetchall()
    assert all(rows[k]["held_out"] == held_out(k) and 0 <= rows[k]["score"] <= 1 for k in rows)
    test = [(rows[k]["score"], t) for k, t in labels if held_out(k)]
    toxic, other = [s for s, t in test if t], [s for s, t in test if not t]
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in other) / (len(toxic) * len(other))
    assert wins > 0.85
    assert sum(s >= 0.7 for s in other) / len(other) < 0.05


def test_ids_equal_the_library_and_decode(spark, documents):
    import tiktoken

    from marketpulse.llm.byte_bpe import read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op9_byte_bpe"](spark, SF_DIR).collect():
        text = documents[r["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_contamination(spark, duck, documents):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    rows = QUERIES["op10_positional"](spark, SF_DIR).collect()
    assert len(rows) == len(documents)
    for r in rows:
        expected = brute.contamination(documents[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == expected
        assert r["contaminated"] == (expected[1] > 0)
    assert any(r["contaminated"] for r in rows)

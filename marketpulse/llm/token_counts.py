"""Token counts by a two-tier look-up in the map tasks.

A text's count is the sum of its pre-tokens' counts. Tier one is a compact hash table of the lengths of frequent
pre-tokens, broadcast to all workers; its size has a bound. A miss is encoded by the tokenizer's library and kept in the
worker's cache, which has a bound, too. No pre-token is ever shuffled, and each text is seen once.

Which pre-tokens count as frequent is learned from a bounded sample of documents and changes no result, only the time.

A text is cut into pre-tokens here only where that is known to equal what the library does: it holds no special token's
string, and no character outside Basic Latin, Latin-1 and Latin Extended-A, where composing and lower-casing could
depend on neighbours. All other texts are encoded whole by the library. Null and empty texts count 0.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, functions as F

from marketpulse.llm.common import keyed_schema

# Entries of the broadcast table and of a worker's cache.
FREQUENT, CACHED = 1 << 16, 1 << 19
SAMPLE_DOCS = 2000
# I with a dot above is left out: its lower case has two characters.
UNSAFE = "[^\x00-įı-ſ]"


def layout(spec: str) -> tuple[str | None, list[str]]:
    """(pattern of pre-tokens, strings of special tokens) of a tokenizer's JSON.

    The pattern is None where the file prescribes other steps than composing, blanks, lower-casing and one split that
    keeps the matches: then every text goes to the library.
    """
    parsed = json.loads(spec)
    specials = [t["content"] for t in parsed.get("added_tokens") or []]
    normal = (parsed.get("normalizer") or {}).get("normalizers") or []
    pre = (parsed.get("pre_tokenizer") or {}).get("pretokenizers") or []
    fits = (
        [n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"]
        and normal[1]["pattern"] == {"Regex": r"\s+"}
        and normal[1]["content"] == " "
        and [p["type"] for p in pre] == ["Split", "ByteLevel"]
        and pre[0]["behavior"] == "Removed"
        and pre[0]["invert"]
        and not pre[1]["use_regex"]
        and not pre[1]["add_prefix_space"]
    )
    return (pre[0]["pattern"]["Regex"] if fits else None), specials


def frequent_pieces(docs: DataFrame, pattern: str, text: str, sample_docs: int, bound: int) -> list[str]:
    """At most `bound` pre-tokens, those most frequent in a sample of about `sample_docs` documents."""
    rows = docs.count()
    some = docs.sample(min(1.0, sample_docs / rows), seed=7).limit(2 * sample_docs) if rows else docs
    pieces = some.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))).alias("piece"))
    ranked = pieces.groupBy("piece").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "piece").limit(bound)
    return [row["piece"] for row in ranked.select("piece").collect()]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS,
    frequent: int = FREQUENT, cached: int = CACHED,
) -> DataFrame:
    """(key, n_bytes, n_tokens) for every document, as the tokenizers library counts without added tokens."""
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    pattern, specials = layout(spec)
    known: dict[str, int] = {}
    if pattern:
        pieces = frequent_pieces(docs, pattern, text, sample_docs, frequent)
        encoded = Tokenizer.from_str(spec).encode_batch(pieces, add_special_tokens=False)
        known = {piece: len(e.ids) for piece, e in zip(pieces, encoded)}
    shared = docs.sparkSession.sparkContext.broadcast((spec, known))

    def count(batches: Iterable) -> Iterator:
        import os
        import re

        import pyarrow as pa
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        spec, known = shared.value
        tokenizer = Tokenizer.from_str(spec)
        unsafe = re.compile(UNSAFE).search
        find = regex.compile(pattern).findall if pattern else None
        cache = dict(known)

        def n_tokens(content: str) -> int:
            nonlocal cache
            if find is None or unsafe(content) or any(s in content for s in specials):
                return len(tokenizer.encode(content, add_special_tokens=False).ids)
            pieces = find(content.lower())
            lengths = list(map(cache.get, pieces))
            if None in lengths:
                if len(cache) > cached:
                    cache = dict(known)
                misses = list({p for p in pieces if p not in cache})
                for piece, e in zip(misses, tokenizer.encode_batch(misses, add_special_tokens=False)):
                    cache[piece] = len(e.ids)
                lengths = [cache[p] for p in pieces]
            return sum(lengths)

        for batch in batches:
            counts = [n_tokens(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=[key, "n_bytes", "n_tokens"]
            )

    rows = docs.select(key, F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), text)
    return rows.mapInArrow(count, keyed_schema(docs, key, "n_bytes bigint, n_tokens bigint"))

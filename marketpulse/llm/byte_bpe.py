"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A text is cut into pieces by the tokenizer's pattern. A piece is an array of bytes, and a fold over that array merges,
step by step, the neighbouring pair with the lowest rank until no pair has one. Ranks come from a map. Spark searches a
map from its first entry on, so there is an array of small maps and a piece's hash says which of them to ask. Bytes are
written as two hex digits each, since Spark's arrays of binary cannot be joined.

The folds run over distinct words: the corpus is counted once, the words that recur most are folded once each and
looked up from then on, and other words are folded where they stand, so no word occurrence is ever shuffled. How many
words are looked up never changes a result, only the time. The table of looked-up words is bounded in number and in
bytes, and reaches the tasks as the result of a subquery of one row, so neither the plan nor Python holds it.

In a long piece all occurrences of the pair with the lowest rank are merged in one step, from the left and not
overlapping. That gives what merging one after another gives as long as a rank is higher than the ranks of the pieces it
is merged from, as ranks are that come from training; then no pair that a merge brings about can be due before the other
occurrences. A long piece takes as many steps as it uses different ranks, and each step follows its length.

Null texts are empty, and an empty text has no ids.

Decoding takes the piece of every id out of a literal array and concatenates them.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.llm.common import bind, settle

# The tokenizer's pattern; (?U) gives \s the Unicode meaning it has in the tokenizer's own library.
PATTERN_PREFIX = "(?U)"
# Words that are looked up: their number, the bytes of the longest, and of all together. Ids take as much again or less,
# and seven times as much if no byte of a word merges.
FREQUENT_WORDS, WORD_BYTES, TABLE_BYTES = 1 << 20, 64, 16 << 20
# Bytes from which on all pairs of a rank are merged in one step.
LONG_PIECE = 64
# Entries of a small map, and words of a slot of the table, on average.
ENTRIES_PER_MAP, WORDS_PER_SLOT = 4, 1
# Stands for "no rank" in a comparison; ranks are below it.
NO_RANK = (1 << 31) - 1
# Positions in a word are below this.
PLACES = 1 << 31


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: a base64 piece and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def small_maps(spark: SparkSession, entries: dict[str, int]) -> tuple[Column, int]:
    """(array of small maps, their number): the one value of a stored row, as a subquery.

    As a literal it would stand in every description of a plan, some megabytes each time, and fill the driver's memory.
    """
    from zlib import crc32

    slots = max(1, len(entries) // ENTRIES_PER_MAP)
    maps: list[dict] = [{} for _ in range(slots)]
    for key, value in entries.items():
        maps[crc32(key.encode()) % slots][key] = value
    stored = spark.createDataFrame([(json.dumps(maps, ensure_ascii=False),)], "maps string")
    return settle(stored.select(F.from_json("maps", "array<map<string,int>>").alias("maps"))).scalar(), slots


def look_up(maps: Column, slots: int, key: Column) -> Column:
    return F.get(maps, (F.crc32(key.cast("binary")) % slots).cast("int"))[key]


def fold_merges(word_hex: Column, rank_of) -> Column:
    """Where the merged pieces of a word given in hex begin, with the word's end: an array of pair ranks and positions.

    A piece is its position, and a pair the part of the word from one piece to the end of the next, so no piece is ever
    put together. An element holds the rank of a piece's pair with the next one above its position, so the least element
    is the leftmost pair of the lowest rank. A merge takes out the right piece's element and looks up the two pairs that
    change. There are at most as many merges as bytes but one; once no pair has a rank, the fold passes its state on.
    """
    def place(element: Column) -> Column:
        return element.bitwiseAND(F.lit(PLACES - 1)).cast("int")

    def element(start: Column, end: Column) -> Column:
        rank = rank_of(F.substring(word_hex, start + 1, end - start))
        return F.coalesce(rank, F.lit(NO_RANK)).cast("bigint") * F.lit(PLACES) + start

    def step(state: Column, _: Column) -> Column:
        def merge(least: Column, at: Column) -> Column:
            # `at` is the place of the pair's left piece in the array, from 1 on; the one of its right piece goes.
            before = F.get(state, at - 2)
            return F.concat(
                F.slice(state, F.lit(1), F.greatest(at - 2, F.lit(0))),
                F.when(at > 1, F.array(element(place(before), place(F.get(state, at + 1))))).otherwise(F.array().cast("array<bigint>")),
                F.array(element(place(least), place(F.get(state, at + 2)))),
                F.slice(state, at + 2, F.size(state)),
            )

        return bind(F.array_min(state), lambda least: F.when(least >= NO_RANK * PLACES, state).otherwise(
            bind(F.array_position(state, least).cast("int"), lambda at: merge(least, at))
        ))

    size = F.length(word_hex)
    # One place more than bytes: the last is the word's end. Two bytes are four digits.
    start = F.transform(F.sequence(F.lit(0), size, F.lit(2)), lambda i: element(i, F.when(i + 4 <= size, i + 4)))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(size / 2 - 1, F.lit(1)).cast("int")), start, step)


def fold_ranks(word_hex: Column, rank_of) -> Column:
    """The merged pieces of a long word given in hex, joined by blanks. Each step merges all pairs of the lowest rank.

    The pieces stand in one text, each between blanks. A rank belongs to a merged piece, which several pairs may give, so
    the pattern has every way to cut it in two; a match begins and ends at blanks and takes the leftmost pair first.
    """
    def step(state: Column, _: Column) -> Column:
        def merge(tokens: Column) -> Column:
            ranks = F.transform(tokens, lambda t, i: F.coalesce(rank_of(F.concat(t, F.get(tokens, i + 1))), F.lit(NO_RANK)))

            def put(ranks: Column) -> Column:
                at = F.array_position(ranks, F.array_min(ranks)).cast("int")
                return bind(F.concat(F.get(tokens, at - 1), F.get(tokens, at)), lambda piece: bind(cuts(piece), lambda pattern: F.struct(
                    F.regexp_replace(state["text"], pattern, piece).alias("text"), F.lit(False).alias("done")
                )))

            return bind(ranks, lambda r: F.when(F.array_min(r) >= NO_RANK, F.struct(state["text"].alias("text"), F.lit(True).alias("done"))).otherwise(put(r)))

        return F.when(state["done"], state).otherwise(bind(F.split(F.btrim(state["text"]), " "), merge))

    def cuts(piece: Column) -> Column:
        ways = F.transform(F.sequence(F.lit(2), F.length(piece) - 2, F.lit(2)), lambda i: F.concat(
            F.substring(piece, F.lit(1), i), F.lit(" "), F.substring(piece, i + 1, F.length(piece))
        ))
        return F.concat(F.lit("(?<= )(?:"), F.array_join(ways, "|"), F.lit(")(?= )"))

    apart = F.struct(F.concat(F.lit(" "), F.regexp_replace(word_hex, "(..)", "$1 ")).alias("text"), F.lit(False).alias("done"))
    folded = F.aggregate(F.sequence(F.lit(1), (F.length(word_hex) / 2).cast("int")), apart, step)
    return F.btrim(folded["text"])


def encode_word(word: Column, ranks: Column, slots: int) -> Column:
    """Ids of one piece of text as decimals joined by blanks; a piece that has a rank itself is that one id."""
    def rank_of(piece: Column) -> Column:
        return look_up(ranks, slots, piece)

    def by_hex(word_hex: Column) -> Column:
        def ids(merged: Column) -> Column:
            begins = F.transform(merged, lambda e: e.bitwiseAND(F.lit(PLACES - 1)).cast("int"))
            return bind(begins, lambda b: F.transform(
                F.slice(b, F.lit(1), F.size(b) - 1),
                lambda begin, i: rank_of(F.substring(word_hex, begin + 1, F.get(b, i + 1) - begin)).cast("string"),
            ))

        short = F.array_join(bind(fold_merges(word_hex, rank_of), ids), " ")
        long = F.array_join(F.transform(F.split(fold_ranks(word_hex, rank_of), " "), lambda p: rank_of(p).cast("string")), " ")
        return F.coalesce(rank_of(word_hex).cast("string"), F.when(F.length(word_hex) <= 2 * LONG_PIECE, short).otherwise(long))

    return bind(F.hex(word.cast("binary")), by_hex)


def pieces_of(text: Column | str, pattern: str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN_PREFIX + pattern), F.lit(0))


def frequent_words(docs: DataFrame, pattern: str, text: str = "text", bound: int = FREQUENT_WORDS) -> tuple[DataFrame, int]:
    """((word), their number): the words counted most often in the whole table, `bound` of them and TABLE_BYTES at most.

    A word that occurs once is not among them, nor one of more than WORD_BYTES bytes. The least count that keeps within
    the bounds comes from a histogram of counts, so words of equal count are all taken or all left, and no sort of the
    words is needed.
    """
    words = docs.select(F.explode(pieces_of(text, pattern)).alias("word")).where(F.octet_length("word") <= WORD_BYTES)
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    counts = settle(counted.where("n > 1"))
    taken, size, least = 0, 0, None
    of_count = counts.groupBy(F.least("n", F.lit(1 << 16)).alias("n"))
    for row in sorted(of_count.agg(F.count("*").alias("words"), F.sum(F.octet_length("word")).alias("bytes")).collect(), reverse=True):
        taken, size = taken + row["words"], size + row["bytes"]
        if taken > bound or size > TABLE_BYTES:
            taken -= row["words"]
            break
        least = row["n"]
    return counts.where(F.col("n") >= least if least else F.lit(False)).select("word"), taken


def slot_of(word: Column, slots: int) -> Column:
    return (F.crc32(word.cast("binary")) % slots).cast("int")


def known_words(words: DataFrame, slots: int) -> DataFrame:
    """One row of one value: an array of small maps from words to ids; a word's hash says which of them to ask."""
    put = words.groupBy(slot_of(F.col("word"), slots).alias("slot")).agg(F.sort_array(F.collect_list(F.struct("word", "ids"))).alias("held"))
    every = words.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot")).join(put, "slot", "left")
    listed = every.agg(F.sort_array(F.collect_list(F.struct("slot", "held"))).alias("listed"))
    return listed.select(F.transform("listed", lambda s: F.when(s["held"].isNotNull(), F.map_from_entries(s["held"]))).alias("known"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", bound: int = FREQUENT_WORDS) -> DataFrame:
    """`docs` with ids (decimals joined by blanks; empty for null and empty texts)."""
    held, rank_slots = small_maps(docs.sparkSession, {piece.hex().upper(): rank for piece, rank in read_ranks(ranks_path).items()})
    frequent, taken = frequent_words(docs, pattern, text, bound)
    # A subquery has a name of its own for the analyzer alone, which wants none inside a fold; the optimizer puts it there,
    # so no row holds it.
    folded = settle(frequent.select("word", held.alias("_ranks")).select(
        "word", bind(F.col("_ranks"), lambda r: encode_word(F.col("word"), r, rank_slots)).alias("ids")
    ))
    slots = max(1, taken // WORDS_PER_SLOT)
    known = known_words(folded, slots).scalar()

    def ids_of(k: Column, r: Column) -> Column:
        return F.transform(pieces_of(text, pattern), lambda word: F.coalesce(F.get(k, slot_of(word, slots))[word], encode_word(word, r, rank_slots)))

    # Both tables are bound once: named where they are used, each use would carry a copy into every task.
    ids = bind(F.col("_known"), lambda k: bind(F.col("_ranks"), lambda r: ids_of(k, r)))
    kept = [F.col(c) for c in docs.columns if c != "ids"]
    return docs.select("*", known.alias("_known"), held.alias("_ranks")).select(*kept, F.array_join(ids, " ").alias("ids"))


def decode(ids: Column, ranks_path: str) -> Column:
    """Bytes of ids that are joined by blanks: the pieces, found by position in a literal array, one after another."""
    by_id = {rank: piece.hex() for piece, rank in read_ranks(ranks_path).items()}
    pieces = F.split(F.lit(" ".join(by_id.get(i, "") for i in range(max(by_id) + 1))), " ")
    numbers = F.split(F.when(ids != "", ids), " ")
    joined = F.array_join(F.transform(numbers, lambda i: F.get(pieces, i.cast("int"))), "")
    return F.unhex(F.coalesce(joined, F.lit("")))

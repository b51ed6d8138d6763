"""Benchmark decontamination with a distributed positional inverted index.

Test items are cut into phrases of `span` consecutive words (an item of fewer words is one phrase). The corpus is counted
once for the words of the phrases, and each phrase is asked for by its rarest terms: only their postings (document, term,
position) are stored. A posting less the term's offset in the phrase is where the phrase would begin, so the terms' lists
are intersected by a grouping on (document, phrase, beginning). Where all of the rarest terms agree, the words of the
document are compared with the whole phrase: an exact match. Where they agree within `slop` places, in whatever order and
with whatever words between, the match is one by proximity.

Everything is Spark SQL functions. Postings carry a hash of their document and no text; texts are read again for the
documents that have candidates, found by a broadcast if those are counted few and by a shuffle otherwise.

A document is known by two 64-bit hashes of its id and text, so null ids, repeated ids and repeated rows are served.
Null and empty texts have no words. Without items or without words in them, nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from marketpulse.llm.common import LOWER, UPPER, settle
from marketpulse.operators.sizing import broadcast_when_small

# Fixed value of the contract: what separates words is all of ASCII but digits and letters.
SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
SPAN = 10
RAREST = 3
SLOP = 2


def words_of(text: Column | str) -> Column:
    """Words with A-Z lower-cased. One replacement of characters does both, and is twice as fast as a pattern."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    plain = F.translate(text, UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.array_remove(F.split(plain, " "), "")


def phrases_of(items: DataFrame, span: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """(phrase, words, items): distinct phrases, their words in order, and the items that hold them."""
    words = items.select(F.col(key).alias("item"), words_of(text).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (span - 1), F.lit(1)))
    cut = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.lit(span)))).alias("words"))
    return cut.groupBy(F.array_join("words", " ").alias("phrase"), "words").agg(F.collect_set("item").alias("items"))


def with_identity(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        key, text, F.xxhash64(key, text).alias("_h1"), F.xxhash64(F.lit("identity"), text, key).alias("_h2")
    )


def rarest_terms(docs: DataFrame, phrases: DataFrame, text: str, rarest: int) -> DataFrame:
    """(term, phrase, offset, n_terms): for each phrase the places of its rarest words, counted over the whole corpus.

    A phrase with a word that the corpus lacks cannot occur and is left out.
    """
    places = phrases.select("phrase", F.posexplode("words").alias("offset", "term"))
    terms = broadcast_when_small(settle(places.select("term").distinct()))
    counts = docs.select(F.explode(words_of(text)).alias("term")).join(terms, "term").groupBy("term").agg(
        F.count("*").alias("df")
    )
    of_phrase = Window.partitionBy("phrase")
    ranked = places.join(counts, "term", "left").select(
        "*", F.row_number().over(of_phrase.orderBy("df", "offset")).alias("rank"),
        F.min(F.coalesce("df", F.lit(0))).over(of_phrase).alias("least"),
        F.count("*").over(of_phrase).alias("length"),
    )
    return ranked.where((F.col("rank") <= rarest) & (F.col("least") > 0)).select(
        "term", "phrase", "offset", F.least("length", F.lit(rarest)).alias("n_terms"), "rank"
    )


def postings(identified: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """(_h1, _h2, term, position) of the given terms in the corpus."""
    every = identified.select("_h1", "_h2", F.posexplode(words_of(text)).alias("position", "term"))
    return every.join(broadcast_when_small(terms), "term")


def intersect(lists: DataFrame, places: DataFrame, slop: int) -> DataFrame:
    """(_h1, _h2, phrase, start, exact, near): beginnings on which all rarest terms of a phrase agree.

    The rarest term's postings say where phrases may begin, and only there the next terms' postings are asked for: at
    their place for an exact match, up to `slop` places away for a near one. So work follows the rarest term's list, and
    a word repeated all over a document is met once for each place that asks for it.
    """
    rarest = places.where("rank = 1").select("term", "phrase", "offset", "n_terms")
    begun = settle(lists.join(broadcast_when_small(rarest), "term").select(
        "_h1", "_h2", "phrase", "n_terms", (F.col("position") - F.col("offset")).alias("start")
    ))
    others = places.where("rank > 1").select("term", "phrase", "offset", "rank")
    asked = begun.join(broadcast_when_small(others), "phrase").select(
        "_h1", "_h2", "phrase", "start", "term", "rank", F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("away"),
        (F.col("start") + F.col("offset")).alias("_place"),
    ).withColumn("position", F.col("_place") + F.col("away"))
    met = asked.join(lists, ["_h1", "_h2", "term", "position"]).groupBy("_h1", "_h2", "phrase", "start").agg(
        F.size(F.collect_set(F.when(F.col("away") == 0, F.col("rank")))).alias("same"), F.size(F.collect_set("rank")).alias("close")
    )
    agreed = begun.distinct().join(met, ["_h1", "_h2", "phrase", "start"], "left").fillna({"same": 0, "close": 0})
    return agreed.select(
        "_h1", "_h2", "phrase", "start", ((F.col("same") == F.col("n_terms") - 1) & (F.col("start") >= 0)).alias("exact"),
        (F.col("close") == F.col("n_terms") - 1).alias("near"),
    ).where("exact OR near")


def find_matches(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, rarest: int = RAREST,
    slop: int = SLOP,
) -> tuple[DataFrame, DataFrame]:
    """(matches, phrases). matches: _h1, _h2, phrase, start, exact, near, where an exact one has been compared whole."""
    identified = with_identity(docs, key, text)
    phrases = settle(phrases_of(items, span))
    places = settle(rarest_terms(docs, phrases, text, rarest))
    lists = settle(postings(identified, settle(places.select("term").distinct()), text))
    candidates = settle(intersect(lists, places, slop))

    exact = candidates.where("exact")
    asked = exact.groupBy("_h1", "_h2").agg(
        F.collect_set(F.struct("phrase", "start", F.size(F.split("phrase", " ")).alias("n"))).alias("asked")
    )
    # Sixteen bytes a document are broadcast, if they are few; the texts that are left are joined with what is asked.
    holders = broadcast_when_small(settle(exact.select("_h1", "_h2").distinct()))
    compared = identified.join(holders, ["_h1", "_h2"], "left_semi").join(asked, ["_h1", "_h2"]).select(
        "_h1", "_h2", "asked", words_of(text).alias("w")
    )
    proven = compared.select("_h1", "_h2", F.explode(F.filter(
        "asked", lambda a: F.array_join(F.slice("w", a["start"] + 1, a["n"]), " ") == a["phrase"]
    )).alias("m")).select("_h1", "_h2", "m.phrase", "m.start").distinct()
    near = candidates.where("near").select("_h1", "_h2", "phrase", "start")
    matches = proven.withColumn("exact", F.lit(True)).unionByName(near.withColumn("exact", F.lit(False)))
    return matches, phrases


def covered(spans: Column) -> Column:
    """Positions that the (start, n) spans cover, each counted once."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(s: Column, x: Column) -> Column:
        end = F.greatest(s["end"], x["start"] + x["n"])
        return F.struct(end.alias("end"), (s["n"] + end - F.greatest(s["end"], F.least(x["start"], end))).alias("n"))

    return F.aggregate(F.array_sort(spans), start, add)["n"]


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, rarest: int = RAREST,
    slop: int = SLOP,
) -> DataFrame:
    """(key, n_words, n_hit, items, near_items) for every document; items are sorted as text, near_items a count."""
    matches, phrases = find_matches(docs, items, key, text, span, rarest, slop)
    matches = settle(matches)
    hits = matches.where("exact").groupBy("_h1", "_h2").agg(
        covered(F.collect_set(F.struct("start", F.size(F.split("phrase", " ")).alias("n")))).alias("n_hit")
    )
    holders = phrases.select("phrase", F.explode("items").alias("item"))
    found = matches.select("_h1", "_h2", "phrase", "exact").distinct().join(broadcast_when_small(settle(holders)), "phrase")
    named = found.groupBy("_h1", "_h2").agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item").cast("string")))).alias("items"),
        F.size(F.collect_set("item")).alias("near_items"),
    )
    marked = named.join(hits, ["_h1", "_h2"], "left")
    sized = with_identity(docs, key, text).select(key, "_h1", "_h2", F.size(words_of(text)).cast("bigint").alias("n_words"))
    nothing = F.array().cast("array<string>")
    return sized.join(marked, ["_h1", "_h2"], "left").select(
        key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", nothing).alias("items"), F.coalesce("near_items", F.lit(0)).cast("bigint").alias("near_items"),
    )

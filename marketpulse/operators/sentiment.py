"""Lexicon sentiment as a join.

A text's score is the sum s of the valences of its words, squashed to s / sqrt(s*s + 15) and kept to four places
(Hutto and Gilbert, VADER, ICWSM 2014, without its booster, negation and punctuation rules). The lexicon is a table
(term, val10) with valences times ten, so sums are whole numbers and do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketpulse.functions.texts import lexicon_term, tokens
from marketpulse.operators.sizing import broadcast_when_small, repeated_keys

# Fixed value: the normalisation constant of the published formula.
ALPHA = 15.0


def compound_e4(val10: Column) -> Column:
    """Compound score times 10,000, as a whole number, from a sum of valences times ten."""
    total = val10 / F.lit(10.0)
    return F.round(total / F.sqrt(total * total + F.lit(ALPHA)) * F.lit(10000.0)).cast("bigint")


def score_posts(posts: DataFrame, keys: Sequence[str], lexicon: DataFrame, text: str = "full_text") -> DataFrame:
    """(keys, copies, sentiment_e4): the score of every text, one row per distinct (keys, text).

    Tokens meet the lexicon in a broadcast join (its size is counted first; a larger one is joined by shuffle), and are
    summed up again before the only shuffle, so that carries one short row per post and not its text. `copies` counts
    the posts that are equal in both keys and text: a post stored twice still counts twice in an average, and a text
    copied a million times arrives as one row per map task. A term that the lexicon holds twice is an error: it would
    count the posts it occurs in twice, too.
    """
    twice = repeated_keys(lexicon, ["term"]).limit(1).collect()
    if twice:
        raise ValueError(f"the lexicon holds a term more than once: {twice[0]['term']}")
    # Hashed before the explode: what stands next to it in one select would be computed again for every token.
    hashed = posts.select(*keys, F.unhex(F.sha2(text, 256)).alias("_text"), tokens(text).alias("_tokens"))
    pieces = hashed.select(*keys, "_text", F.posexplode_outer("_tokens").alias("_pos", "_token"))
    words = pieces.select(*keys, "_text", "_pos", lexicon_term("_token").alias("term"))
    first = F.col("_pos").isNull() | (F.col("_pos") == 0)
    return (
        words.join(broadcast_when_small(lexicon.select("term", "val10")), "term", "left")
        # Of the unknown words, only the first of a post is needed: it stands for the post.
        .where(first | F.col("val10").isNotNull())
        .groupBy(*keys, "_text")
        .agg(
            F.sum(F.when(first, 1).otherwise(0)).alias("copies"),
            F.coalesce(F.sum("val10"), F.lit(0)).cast("bigint").alias("_val10"),
        )
        # Equal texts have equal sums, so this division leaves no remainder.
        .select(*keys, "copies", compound_e4(F.expr("_val10 div copies")).alias("sentiment_e4"))
    )


def score_mentions(mentions: DataFrame, keys: Sequence[str], lexicon: DataFrame, text: str = "full_text") -> DataFrame:
    """What `score_posts` gives, for rows that repeat each text under several keys, as mentions do for every ticker.

    Each distinct text is cut and scored once, however many rows hold it. Repeated texts collapse in the map tasks, so a
    shuffle carries at most one copy from each; the rows themselves are counted by a hash of their text.
    """
    # An empty hash stands for a null text: nulls would not meet in the join.
    ident = F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("_id")
    counted = mentions.select(*keys, ident).groupBy(*keys, "_id").agg(F.count("*").alias("copies"))
    scored = score_posts(mentions.select(text).distinct().select(ident, text), ["_id"], lexicon, text).drop("copies")
    return counted.join(scored, "_id").select(*keys, "copies", "sentiment_e4")


def post_sentiment(posts: DataFrame, keys: Sequence[str], lexicon: DataFrame, text: str = "full_text") -> DataFrame:
    """(keys, copies, sentiment) with the score as a double in [-1, 1]; a text without a known word scores 0."""
    scored = score_posts(posts, keys, lexicon, text)
    return scored.select(*keys, "copies", (F.col("sentiment_e4") / F.lit(10000.0)).alias("sentiment"))

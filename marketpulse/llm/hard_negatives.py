"""Hard-negative mining with exact scores, by matrix products in a residue number system.

Vectors are whole numbers (`scale` times each component, rounded down), and a score is their exact inner product. For
each of several primes, both matrices are taken modulo the prime, with residues from -(p-1)/2 to (p-1)/2, and multiplied
in float32. A prime is so small that every sum on the way stays below 2^24, where float32 is exact. Primes are taken until
their product covers every score that the longest vector allows; the Chinese remainder theorem, in mixed radix, then
gives the signed score.

Anchors are a stated query set. They are taken in blocks of bounded bytes; each block is broadcast, and two passes over
the rows follow, spread over all tasks: the first finds each anchor's positives, the next, for each positive, the
negatives whose score lies in the window below the positive's. A task keeps the best few for each anchor only, so what is
shuffled does not follow the number of pairs; a window per anchor and positive then picks the first ones.

Rows with a null label, a null vector, or any null or non-finite component take no part, nor do rows without an id, which
could not be named. Of several lengths of vectors the most frequent counts (of equally frequent ones the longest), rows
of another length take no part; nor do vectors whose squared length is 2^62 or more, as their scores do not fit a long.
Rows with an anchor's id are not its partners. Repeated rows each count as a row; an anchor's id is mined once, of
several rows with that id the one with the smallest label and vector.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from math import isqrt
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketpulse.llm.common import settle

# Bytes of the whole numbers of one block of anchors: what is broadcast at once.
BLOCK_BYTES = 16 << 20
# Sums of float32 products are exact below this.
EXACT = 1 << 24
# Scores that a task holds at once.
SCORES_AT_ONCE = 1 << 21
# Components that are multiplied in one product; longer vectors take several, added up as whole numbers.
INNER = 4096


def primes_for(width: int, bound: int) -> list[int]:
    """Odd primes, the largest first, that keep `width` products exact and whose product passes twice `bound` and one."""
    chosen, product, p = [], 1, 2 * isqrt((EXACT - 1) // min(max(width, 1), INNER)) + 1
    while product <= 2 * bound + 1:
        if all(p % d for d in range(3, isqrt(p) + 1, 2)):
            chosen.append(p)
            product *= p
        p -= 2
    return chosen


def residues(vectors: Any, p: int) -> Any:
    """Whole numbers modulo p, from -(p-1)/2 to (p-1)/2, in float32."""
    import numpy as np

    r = np.mod(vectors, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def exact_scores(left: list, right: list, primes: list[int]) -> Any:
    """left x right' as int64, from the residues of both: products in float32, then mixed radix with signed digits."""
    import numpy as np

    def centred(x, p):
        x = np.mod(x, p)
        return np.where(x > p // 2, x - p, x)

    digits: list = []
    total, weight = None, 1
    for k, p in enumerate(primes):
        width = left[k].shape[1]
        products = [left[k][:, i : i + INNER] @ right[k][:, i : i + INNER].T for i in range(0, width, INNER)]
        digit = centred(sum(x.astype(np.int64) for x in products), p)
        for j, q in enumerate(primes[:k]):
            digit = centred((digit - digits[j]) * pow(q, -1, p), p)
        digits.append(digit)
        # Beyond 63 bits a weight only wraps around; the sum is right, since the score fits.
        with np.errstate(over="ignore"):
            part = digit * np.array(weight & (2**64 - 1), dtype=np.uint64).view(np.int64)
            total = part if total is None else total + part
        weight *= p
    return total


def whole_vectors(rows: DataFrame, key: str, vector: str, label: Column, scale: float) -> tuple[DataFrame, int, int]:
    """((id, label, v) of the rows that take part, length of the vectors, largest squared length), written out once."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("double"))
    fine = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    # Components of 2^31 and more are too large in any case, and must not reach the cast.
    short = F.forall("x", lambda c: F.abs(c) < float(1 << 31))
    named = rows.select(F.col(key).alias("id"), label.alias("label"), F.when(fine & (F.size(vector) > 0), x).alias("x"))
    whole = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & short)
    whole = whole.select("id", "label", F.transform("x", lambda c: c.cast("bigint")).alias("v"))
    # Whole numbers below 2^62 have floating sums of squares right to one part in 2^40 or so; the bound is drawn below.
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    kept = settle(whole.withColumn("norm", norm).where(F.col("norm") < float(1 << 62)))
    widths = kept.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max("norm").alias("norm"))
    most = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return kept.select("id", "label", "v"), 0, 0
    return kept.where(F.size("v") == most["width"]).select("id", "label", "v"), most["width"], int(most["norm"] * 1.001) + 1


def matrix(column: Any, width: int) -> Any:
    """An Arrow column of lists of one length as a matrix of int64."""
    import numpy as np

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), width)


def best_of(groups: Any, scores: Any, ids: Any, k: int) -> Any:
    """Places of the first `k` of each group, by score from the highest and then by id from the smallest."""
    import numpy as np

    order = np.lexsort((ids, -scores, groups))
    group = groups[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=np.int64)
    nth = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    return order[nth < k]


def partners(
    rows: DataFrame, width: int, primes: list[int], block: Any, k: int, wanted: Any = None, percent: int = 80
) -> DataFrame:
    """(g, id, score): for each group of a block, at most `k` best partners from every task.

    `block` broadcasts (ids, labels, vectors) of anchors and `wanted` names the groups: None for an anchor's rows of its
    own label, else (anchors, scores), for which partners of other labels count whose score is within `percent` of that.
    """

    def search(batches: Iterable) -> Iterator:
        import numpy as np

        anchor_ids, anchor_labels, anchor_vectors = block.value
        asked = wanted.value if wanted is not None else None
        left = [residues(anchor_vectors, p) for p in primes]
        held: list[tuple] = []
        size = 0

        def first_ones():
            g, i, s = (np.concatenate([h[c] for h in held]) for c in range(3))
            kept = best_of(g, s, i, k)
            return g[kept], i[kept], s[kept]

        for batch in batches:
            ids = np.asarray(batch.column(0)).astype(np.int64)
            labels = np.asarray(batch.column(1)).astype(np.int64)
            own = matrix(batch.column(2), width)
            right = [residues(own, p) for p in primes]
            at_once = max(1, SCORES_AT_ONCE // max(len(ids), 1))
            for at in range(0, len(anchor_ids), at_once):
                to = min(at + at_once, len(anchor_ids))
                scores = exact_scores([m[at:to] for m in left], right, primes)
                other = ids[None, :] != anchor_ids[at:to, None]
                same = labels[None, :] == anchor_labels[at:to, None]
                if asked is None:
                    found = [(np.arange(at, to), other & same, scores)]
                else:
                    of, given = asked
                    begin, end = np.searchsorted(of, [at, to])
                    found = []
                    # The nth positive of every anchor at a time.
                    nth = np.arange(begin, end) - np.searchsorted(of, of[begin:end])
                    for n in range(int(nth.max()) + 1 if end > begin else 0):
                        g = np.arange(begin, end)[nth == n]
                        s, bound = scores[of[g] - at], given[g][:, None]
                        # percent * bound <= 100 * s, without products that may not fit.
                        least = bound // 100 * percent - (-(bound % 100) * percent) // 100
                        inside = (s <= bound) & (s >= least)
                        found.append((g, inside & ~same[of[g] - at] & other[of[g] - at], s))
                for g, allowed, s in found:
                    row, column = best_in_rows(s, allowed, k)
                    held.append((g[row], ids[column], s[row, column]))
                    size += len(row)
            if size > 1_000_000:
                held = [first_ones()]
                size = len(held[0][0])
        if held:
            g, i, s = first_ones()
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.int64())], names=["g", "id", "score"])

    def best_in_rows(scores, allowed, k):
        """Entries that may be among the best `k` of their row: all that reach the row's k-th score."""
        import numpy as np

        least = np.iinfo(np.int64).min
        masked = np.where(allowed, scores, least)
        if masked.shape[1] > k:
            kth = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
            return np.nonzero(allowed & (masked >= kth[:, None]))
        return np.nonzero(allowed)

    return rows.select("id", "label", "v").mapInArrow(search, "g bigint, id bigint, score bigint")


def first_partners(found: DataFrame, k: int) -> DataFrame:
    """(g, id, score, rank): the first `k` over all tasks."""
    order = Window.partitionBy("g").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, label: Column | None = None, key: str = "vec_id", vector: str = "embedding",
    scale: float = 256.0, positives: int = 5, negatives: int = 5, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` is a condition on the rows, `label` an expression (the column `label` unless given). Negatives are rows of
    another label with 80 * positive_score <= 100 * negative_score <= 100 * positive_score.
    """
    spark = rows.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    marked = rows.select(
        F.col(key).cast("bigint").alias(key), vector, (F.col("label") if label is None else label).cast("bigint").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    ids = marked.where("anchor").select(F.col(key).alias("id")).distinct()
    whole, width, bound = whole_vectors(marked, key, vector, F.col("label"), scale)
    if not width:
        return spark.createDataFrame([], schema)
    primes = primes_for(width, bound)
    named = whole.join(ids, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v")).alias("own"))
    # Blocks of a bounded number of anchors, by a hash of the id: the mean is half the bound, and none is taken whole at once.
    anchors = settle(named.select("id", "own.label", "own.v"))
    per_block = max(1, block_bytes // (8 * width))
    blocks = -(-anchors.count() // max(1, per_block // 2))
    dealt = settle(anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(blocks, 1))).cast("int")))
    results = [mine_block(whole, width, primes, dealt.where(F.col("block") == b), positives, negatives) for b in range(blocks)]
    return reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], schema)


def mine_block(rows: DataFrame, width: int, primes: list[int], anchors: DataFrame, positives: int, negatives: int) -> DataFrame:
    """The result for one block of anchors, written out."""
    import numpy as np

    context = rows.sparkSession.sparkContext
    table = anchors.select("id", "label", "v").orderBy("id").toArrow()
    ids, labels = (np.asarray(table.column(c)).astype(np.int64) for c in ("id", "label"))
    block = context.broadcast((ids, labels, matrix(table.column("v"), width)))
    found = first_partners(partners(rows, width, primes, block, positives), positives)
    chosen = found.orderBy("g", "rank").toArrow()
    of, near, score = (np.asarray(chosen.column(c)).astype(np.int64) for c in ("g", "id", "score"))
    wanted = context.broadcast((of, score))
    names = rows.sparkSession.createDataFrame(
        pa.table({"g": pa.array(np.arange(len(of))), "anchor_id": pa.array(ids[of]), "positive_id": pa.array(near), "positive_score": pa.array(score)})
    )
    best = first_partners(partners(rows, width, primes, block, negatives, wanted), negatives)
    mined = settle(best.join(F.broadcast(names), "g").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    ))
    block.destroy()
    wanted.destroy()
    return mined

"""Exact components of the Jaccard join on word n-grams, filtered by prefixes under several global orders.

The result is each document's component and set size, not the join's pairs: links inside a component are not all found.

Two sets can only be as similar as asked if their prefixes meet, whichever total order of the tokens the prefixes are
taken under (prefix filtering; Chaudhuri, Ganti and Kaushik, 2006). Each further order is one more condition, so pairs
have to meet under all of them before they are verified on their whole sets.

- Sets that are equal are one class, known by a 128-bit fingerprint; all further work is on classes.
- Order 1 puts tokens that many sets hold last, as counted over all documents in a sketch of fixed size, and orders the
  rest by hash; what the sketch mixes up only moves a token within the order. Orders 2 and 3 are other hashes.
- Classes that have one of their very first tokens under order 2 or 3 in common form groups. In rounds, each component of
  a group sends one member, and all are compared with one of them, so a large group of near copies takes few comparisons.
  Members whose prefix tokens many others hold go first: among edited copies these are the ones with the fewest edits, and
  a copy that is not alike to them is hardly alike to any.
- At last, in groups of a prefix token of order 1 that still hold different components, the classes outside of a group's
  largest component are compared with all others of the group, each with the nearest by bitmap first. Pairs inside one
  component are skipped: they cannot change a component. No pair between components is left out.
- Sizes, the place of the common token and bitmaps of all tokens are compared in the join itself, so pairs that cannot be
  alike never become rows, and others become one row, not one for each common token; then prefixes under the other orders
  must meet.
- Components come from the smallest label spreading along links, with checkpoints between rounds.

Words are blank-separated after A-Z are lower-cased. A document of fewer than `n` words is one n-gram of its own; null
and empty texts, and texts of blanks, have the empty set and link with nothing. Null ids, repeated ids and repeated rows
are served, since classes are found by text: a document's component id is the smallest id among its component's rows,
null only if none has one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from marketpulse.llm.common import keyed_schema, settle
from marketpulse.operators.sizing import broadcast_when_small

ORDERS = 3
# The sketch: so many counters, in blocks that are summed apart from one another.
CELLS, BLOCKS = 1 << 24, 256
# Words of 64 bits of a class's bitmap, in which each token flips a bit; tokens of each other order that make the groups
# of the rounds; the share of the links so far that a round must find for another one; and first tokens of a class that are
# carried along to tell where two classes meet. Any numbers give the same components.
BITMAP, KEYS, WORTH, LISTED = 8, 2, 0.1, 16
# Bytes of text that a task hashes at once, which takes forty times as much memory, and the base of the polynomial: any odd
# number without a pattern.
BUFFER_BYTES, BASE = 1 << 20, 0x9E3779B97F4A7C15


def mixer() -> Callable:
    """A bijective mix of 64-bit tokens with a seed: another seed gives another order."""
    import numpy as np

    def mix(tokens, seed: int):
        x = tokens ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    return mix


def byte_values() -> tuple:
    """A random 64-bit number for each byte, the same for A-Z and a-z, and whether a byte is a blank."""
    import numpy as np

    values = np.random.default_rng(2024).integers(0, 1 << 64, size=256, dtype=np.uint64)
    values[65:91] = values[97:123]
    blank = np.zeros(256, dtype=bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return values, blank


def shingler(n: int) -> Callable[[Any], Iterator]:
    """For a column of texts, each text's sorted distinct 64-bit tokens of word n-grams.

    Many texts are cut and hashed at once: a word's hash is a polynomial of its bytes, which is the difference of two
    running sums over the whole buffer, taken back to the word's beginning by the inverse power. A mix of the hash and the
    length follows, so words do not get related numbers.
    """
    import numpy as np

    mix = mixer()
    values, blank = byte_values()
    powers = inverses = np.ones(1, dtype=np.uint64)

    def tokens_of(h):
        width = min(n, len(h))
        token = np.full(len(h) - width + 1, np.uint64(width))
        for j in range(width):
            token = mix(token ^ h[j : j + len(token)], j + 1)
        return token

    def powers_of(base: int, most: int):
        every = np.full(most + 1, np.uint64(base))
        every[0] = 1
        return np.cumprod(every, out=every)

    def of_buffer(data, bounds) -> Iterator:
        nonlocal powers, inverses
        if len(powers) <= len(data):
            powers, inverses = powers_of(BASE, len(data) + 1), powers_of(pow(BASE, -1, 1 << 64), len(data) + 1)
        inside = ~blank[data]
        # A text's first byte begins a word, and its last one ends it, whatever stands beside it in the buffer.
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[bounds] = True
        left = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        starts = np.flatnonzero(inside & (~left | edge[:-1]))
        right = np.concatenate([inside[1:], [False]]) if len(data) else inside
        ends = np.flatnonzero(inside & (~right | edge[1:])) + 1
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.multiply(values[data], powers[: len(data)], out=sums[1:])
        np.cumsum(sums[1:], out=sums[1:])
        h = mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64), 99)
        every = tokens_of(h) if len(h) >= n else h[:0]
        of_text = np.searchsorted(starts, bounds)
        for begin, end in zip(of_text[:-1], of_text[1:]):
            if end - begin >= n:
                token = np.sort(every[begin : end - n + 1])
                keep = np.ones(len(token), dtype=bool)
                np.not_equal(token[1:], token[:-1], out=keep[1:])
                yield token[keep]
            else:
                yield tokens_of(h[begin:end]) if end > begin else h[:0]

    def shingles(column) -> Iterator:
        column = pa.chunked_array([column]).combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = column.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BUFFER_BYTES, side="right")) - 1)
            yield from of_buffer(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to

    return shingles


def fingerprint(tokens) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(tokens.tobytes())


def prefix_length(size: int, percent: int) -> int:
    """Under any order, two sets as similar as asked share a token among so many first ones of each."""
    return size - -(-percent * size // 100) + 1


def survey(docs: DataFrame, n: int, key: str, text: str) -> tuple[DataFrame, bytes]:
    """One pass over the texts: (key, c, n, h1, h2) for every document, and a bitmap over the sketch's cells.

    c is the class, n the size of the set, and h1 and h2 hash the text. A cell of the bitmap is 1 where more tokens fall
    than chance explains, so that common tokens are there. Every task counts its tokens in a sketch of fixed size; the
    sketches are summed block by block, and a cell is marked by its excess over the mean of its block. The bitmap takes
    two megabytes, whatever the corpus.
    """
    per_block = CELLS // BLOCKS

    def look(batches: Iterable) -> Iterator:
        import zlib

        import numpy as np

        shingles = shingler(n)
        counts = np.zeros(CELLS, dtype=np.uint16)
        held: list = []
        size = 0

        def add() -> None:
            cells, found = np.unique((np.concatenate(held) >> np.uint64(40)).astype(np.int64), return_counts=True)
            counts[cells] = np.minimum(counts[cells].astype(np.int64) + found, 65535)

        def rows(keys, classes, sizes, h1, h2, blocks, packed):
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(classes, pa.binary()), pa.array(sizes, pa.int32()), h1, h2, pa.array(blocks, pa.int32()),
                 pa.array(packed, pa.binary())],
                names=[key, "c", "n", "h1", "h2", "block", "counts"],
            )

        kind = None
        for batch in batches:
            kind = batch.schema
            classes, sizes = [], []
            for tokens in shingles(batch.column(1)):
                classes.append(fingerprint(tokens))
                sizes.append(len(tokens))
                held.append(tokens)
                size += len(tokens)
                if size > 1_000_000:
                    add()
                    held, size = [], 0
            nothing = [None] * batch.num_rows
            yield rows(batch.column(0), classes, sizes, batch.column(2), batch.column(3), nothing, nothing)
        if held:
            add()
        if counts.any():
            packed = [zlib.compress(block.tobytes(), 1) for block in counts.reshape(BLOCKS, per_block)]
            nulls = pa.nulls(BLOCKS, pa.int64())
            yield rows(pa.nulls(BLOCKS, kind.field(0).type), [None] * BLOCKS, [None] * BLOCKS, nulls, nulls, range(BLOCKS), packed)

    def mark(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        total = np.zeros(per_block, dtype=np.int64)
        for batch in batches:
            for packed in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.uint16)
        mean = total.mean()
        marked = total > mean + 3 * np.sqrt(mean) + 3
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(marked).tobytes()])], names=["block", "bits"]
        )

    hashed = docs.select(key, text, F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"))
    seen = settle(hashed.mapInArrow(look, keyed_schema(docs, key, "c binary, n int, h1 bigint, h2 bigint, block int, counts binary")))
    sketches = seen.where("block IS NOT NULL").select("block", "counts")
    bits = {row["block"]: bytes(row["bits"]) for row in sketches.groupBy("block").applyInArrow(mark, "block int, bits binary").collect()}
    bitmap = b"".join(bits.get(block, bytes(per_block // 8)) for block in range(BLOCKS))
    return seen.where("block IS NULL").select(key, "c", "n", "h1", "h2"), bitmap


def prefixes(docs: DataFrame, n: int, percent: int, text: str, frequent: Any) -> DataFrame:
    """(c, n, first, others, bits): each class's prefix under order 1, under the other orders as arrays of 32-bit numbers,
    and a bitmap in which every token of the set flips one bit.

    A class comes once from each task that holds a document of it.
    """

    def cut(batches: Iterable) -> Iterator:
        import numpy as np

        shingles, mix = shingler(n), mixer()
        marked = np.frombuffer(frequent.value, dtype=np.uint8)
        seen: set[bytes] = set()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for tokens in shingles(batch.column(0)):
                c = fingerprint(tokens)
                if not len(tokens) or c in seen:
                    continue
                seen.add(c)
                size = prefix_length(len(tokens), percent)
                cell = (tokens >> np.uint64(40)).astype(np.int64)
                late = (marked[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1
                rank = (mix(tokens, 101) >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))
                # Tokens come sorted, so equal ranks stand in the same order in every set.
                order = np.argsort(rank, kind="stable")[:size]
                out[0].append(c)
                out[1].append(len(tokens))
                out[2].append(tokens[order].view(np.int64))
                out[3].append([
                    np.sort(mix(tokens, 101 + k))[:size].astype(np.uint32).view(np.int32) for k in range(1, ORDERS)
                ])
                flips = np.bincount((mix(tokens, 202) % np.uint64(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
                out[4].append(np.packbits(flips.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.list_(pa.int64())),
                 pa.array(out[3], pa.list_(pa.list_(pa.int32()))), pa.array(out[4], pa.list_(pa.int64()))],
                names=["c", "n", "first", "others", "bits"],
            )

    return docs.select(text).mapInArrow(cut, "c binary, n int, first array<bigint>, others array<array<int>>, bits array<bigint>")


def differing(left: str, right: str) -> Column:
    """How many bits two bitmaps differ in: each is a token that one of the classes lacks."""
    bx, by = F.col(left), F.col(right)
    return sum((F.bit_count(bx[k].bitwiseXOR(by[k])) for k in range(1, BITMAP)), F.bit_count(bx[0].bitwiseXOR(by[0])))


def maps_allow(left: tuple[str, str], right: tuple[str, str], percent: int) -> Column:
    """Whether (size, bitmap) of two classes allow the similarity."""
    (nx, bx), (ny, by) = left, right
    # Of nx + ny tokens, percent in 100 + percent at least are there twice over; the others only once.
    return (100 + percent) * differing(bx, by).cast("bigint") <= (100 - percent) * (F.col(nx) + F.col(ny)).cast("bigint")


def verified(pairs: DataFrame, signatures: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): the pairs that meet under all orders and are as similar as asked.

    First the prefixes of the other orders are joined and compared, then, for what is left, the texts.
    """
    of_a = signatures.select(F.col("c").alias("a"), F.col("others").alias("oa"))
    of_b = signatures.select(F.col("c").alias("b"), F.col("others").alias("ob"))
    meets = F.lit(True)
    for k in range(ORDERS - 1):
        meets = meets & F.arrays_overlap(F.col("oa")[k], F.col("ob")[k])
    left = settle(pairs.join(of_a, "a").join(of_b, "b").where(meets).select("a", "b"))

    def compare(batches: Iterable) -> Iterator:
        import numpy as np

        shingles = shingler(n)
        for batch in batches:
            similar = []
            for sa, sb in zip(shingles(batch.column(2)), shingles(batch.column(3))):
                both = len(np.intersect1d(sa, sb, assume_unique=True))
                similar.append((100 + percent) * both >= percent * (len(sa) + len(sb)))
            yield batch.filter(pa.array(similar, pa.bool_())).select(["a", "b"])

    ta = texts.select(F.col("c").alias("a"), F.col("t").alias("ta"))
    tb = texts.select(F.col("c").alias("b"), F.col("t").alias("tb"))
    return settle(left.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(compare, "a binary, b binary"))


def meetings(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, gap): pairs of two components in the groups of a token, as far as sizes, places and bitmaps allow them.

    Two classes meet at the first token that both have among the first few of each, and at every common token only if there
    is none. In the group, the one outside of the largest component takes the other, or the smaller class, if both are.
    """
    named_as = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("c", "n", "at", "root", "tokens", "bits")]
    minor, every = rows.where("root <> main").select("token", *named_as("x")), rows.select("token", "main", *named_as("y"))
    # All that two sets share stands from their first common token on, so that one leaves room for enough in both.
    room = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at")).cast("bigint")
    return minor.join(every, "token").where(
        (F.col("x_root") != F.col("y_root")) & ((100 + percent) * room >= percent * (F.col("x_n") + F.col("y_n")).cast("bigint"))
        & ((F.col("y_root") == F.col("main")) | (F.col("x_c") < F.col("y_c")))
        & maps_allow(("x_n", "x_bits"), ("y_n", "y_bits"), percent)
        & (F.coalesce(F.get(F.array_intersect("x_tokens", "y_tokens"), F.lit(0)), F.col("token")) == F.col("token"))
    ).select(
        F.least("x_c", "y_c").alias("a"), F.greatest("x_c", "y_c").alias("b"), (differing("x_bits", "y_bits") / (F.col("x_n") + F.col("y_n"))).alias("gap")
    )


def components(links: DataFrame) -> DataFrame:
    """(c, root) for every class in a link: root is the smallest class of its component.

    Labels take the smallest label among neighbours and then the label of their label, until nothing changes; paths get
    shorter by half or more in every round.
    """
    both = settle(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = settle(both.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m")).select("c", F.least("c", "m").alias("root")))
    while True:
        near = both.join(labels.select(F.col("c").alias("b"), "root"), "b").groupBy(F.col("a").alias("c")).agg(F.min("root").alias("m"))
        lower = labels.join(near, "c").select("c", F.least("root", "m").alias("mid"), F.col("root").alias("old"))
        jump = labels.select(F.col("c").alias("mid"), F.col("root").alias("far"))
        moved = settle(lower.join(jump, "mid").select("c", F.least("mid", "far").alias("root"), "old"))
        labels = moved.select("c", "root")
        if not moved.where("root <> old").limit(1).count():
            return labels


def link_documents(docs: DataFrame, n: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for every document: links are Jaccard similarities of percent/100 and more."""
    spark = docs.sparkSession
    named, bitmap = survey(docs, n, key, text)
    frequent = spark.sparkContext.broadcast(bitmap)
    signatures = settle(prefixes(docs, n, percent, text, frequent).dropDuplicates(["c"]))

    posted = signatures.select("c", "n", F.posexplode("first").alias("at", "token"))
    of_token = Window.partitionBy("token")
    shared = settle(
        posted.select("*", F.count("*").over(of_token).alias("m")).where("m > 1").select(
            "c", "n", "token", "at", "m"
        )
    )
    # One text for each class that shares a token with another, found by the text's hashes.
    one = named.groupBy("c").agg(F.min(F.struct("h1", "h2")).alias("h"))
    needed = settle(one.join(shared.select("c").distinct(), "c", "left_semi").select("c", "h.h1", "h.h2"))
    hashed = docs.select(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"), F.col(text).alias("t"))
    texts = settle(hashed.join(broadcast_when_small(needed), ["h1", "h2"]).select("c", "t").dropDuplicates(["c"]))

    # Rounds over groups: each component sends one member, another one in each round from among its most central ones, and the
    # most central of these is compared with the rest. Centrality is how many classes hold a token of a member's prefix on
    # the average, in steps of a fifth.
    central = shared.groupBy("c").agg(F.floor(-4 * F.log2(F.sum("m") / F.max("n"))).alias("far"))
    first_tokens = signatures.select("c", "n", F.posexplode("others").alias("order", "tokens")).select(
        "c", "n", "order", F.explode(F.slice("tokens", 1, KEYS)).alias("key")
    )
    keyed = settle(first_tokens.join(central, "c"))
    maps = signatures.select("c", "bits")
    nothing = spark.createDataFrame([], "a binary, b binary")
    links, roots, turn = nothing, components(nothing), 0
    while True:
        placed = keyed.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
        member = F.struct("far", F.xxhash64(F.lit(turn), "c").alias("turn"), "c", "n")
        sent = placed.groupBy("order", "key", "root").agg(F.min(member).alias("x"))
        heads = sent.groupBy("order", "key").agg(F.count("*").alias("roots"), F.min(F.struct("x", "root")).alias("y")).where("roots > 1")
        first, last = F.least("x.n", "y.x.n").cast("bigint"), F.greatest("x.n", "y.x.n").cast("bigint")
        met = sent.join(heads, ["order", "key"]).where((F.col("root") != F.col("y.root")) & (100 * first >= percent * last)).select(
            F.col("x.c").alias("x"), F.col("x.n").alias("nx"), F.col("y.x.c").alias("y"), F.col("y.x.n").alias("ny")
        ).distinct()
        met = met.join(maps.select(F.col("c").alias("x"), F.col("bits").alias("bx")), "x").join(
            maps.select(F.col("c").alias("y"), F.col("bits").alias("by")), "y"
        ).where(maps_allow(("nx", "bx"), ("ny", "by"), percent))
        tried = settle(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        found = verified(tried, signatures, texts, n, percent)
        links, turn = links.unionByName(found), turn + 1
        roots = components(links)
        if found.count() <= WORTH * links.count():
            break

    # What is left: in groups of order 1 that still hold several components, all outside of the largest with all others.
    held = shared.drop("m").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    sizes = held.groupBy("token", "root").agg(F.count("*").alias("rows"))
    mixed = sizes.groupBy("token").agg(F.count("*").alias("roots"), F.max_by("root", "rows").alias("main")).where("roots > 1")
    rows = held.join(mixed.select("token", "main"), "token")
    # A class's first tokens of such groups tell where it meets another.
    listed = rows.groupBy("c").agg(F.slice(F.sort_array(F.collect_list(F.struct("at", "token")))["token"], 1, LISTED).alias("tokens"))
    rows = settle(rows.join(listed, "c").join(signatures.select("c", "bits"), "c"))
    pairs = settle(meetings(rows, percent).distinct())
    # Each class with the one nearest to it by bitmap comes first, which joins most of what belongs together; then all pairs
    # that still lie in two components.
    nearest = pairs.groupBy("a").agg(F.min_by("b", F.struct("gap", "b")).alias("b")).unionByName(
        pairs.groupBy("b").agg(F.min_by("a", F.struct("gap", "a")).alias("a"))
    ).distinct()
    links = links.unionByName(verified(nearest, signatures, texts, n, percent))
    roots = components(links)
    of_a, of_b = (roots.select(F.col("c").alias(side), F.col("root").alias(f"root_{side}")) for side in ("a", "b"))
    apart = pairs.join(of_a, "a", "left").join(of_b, "b", "left").where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    links = links.unionByName(verified(apart.select("a", "b"), signatures, texts, n, percent))
    roots = components(links)

    lowest = named.where("n > 0").groupBy("c").agg(F.min(key).alias("low"))
    rooted = lowest.join(roots, "c", "left").select("c", F.coalesce("root", "c").alias("root"), "low")
    ids = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("c", "component_id")
    return named.join(ids, "c", "left").select(
        key, F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col(key)).otherwise(F.col("component_id")).alias("component_id"),
    )

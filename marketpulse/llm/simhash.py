"""Near duplicates by SimHash, found with the generalised pigeonhole principle.

A fingerprint has 64 bits; a bit is 1 if it is set in more than half of the hashes of the text's word shingles, repeats
included. Two documents link when their fingerprints differ in `distance` bits at most, and the result is each
document's component.

The bits are grouped into parts. If thresholds t_1 .. t_m add up to distance - m + 1, fingerprints within the distance
are within t_i in at least one part i; a part with the threshold -1 need not be looked at (Qin et al., GPH, 2018). So:

- Fingerprints that are equal are one class; all further work is on classes, however many documents share one.
- Bits that go together share a part, which leaves the other parts more telling. How bits go together is counted over
  all classes, and so are the pairs that would meet in each part, by a sketch of fixed size (Alon, Matias and Szegedy).
- For each number of parts, dynamic programming allots thresholds by the estimated cost of probes and of candidates; the
  cheapest plan is taken. Any plan gives the same result.
- Every class is posted under its bits of a part, and probes the keys within the part's threshold. A group of a key is
  compared in one task while it is small; a larger one is split first by the pigeonhole principle over the bits that its
  members need not share, again and again. Distinct fingerprints that agree in all but b bits are 2^b at most, so every
  group gets small and none is cut off. A group gives a link from each member to its component, not all pairs.

Words are blank-separated after A-Z are lower-cased. A text of fewer words than a shingle is one shingle; null and empty
texts, and texts of blanks, have the fingerprint zero and are linked like others. Null ids, repeated ids and repeated rows
are served: a document's component id is the smallest id among the documents of its component, null if none has one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import accumulate, combinations
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketpulse.llm.common import keyed_schema, settle
from marketpulse.llm.jaccard_join import components
from marketpulse.operators.sizing import broadcast_when_small

# Fixed values of the contract: bits of a fingerprint, seed of the hash.
BITS, SEED = 64, 42
# Shingles that are hashed before their bits are counted.
SHINGLES_AT_ONCE = 1 << 15
# Rows of a key that one task compares with one another; larger groups are split first.
GROUP_ROWS = 1 << 14
# Cells of the sketch that estimates how many pairs meet in a part.
CELLS = 1 << 12
# Cost of a probe, which is a row that is shuffled, in comparisons of two fingerprints.
PROBE_COST = 300
MOST_PARTS = 5


def fingerprinter(n: int) -> Callable[[str], int]:
    """A function from a text to its fingerprint, an unsigned number. Shingles have `n` words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    def of(text: str) -> int:
        # bytes.lower() changes A-Z only, and bytes.split() cuts at 0x20 and 0x09 to 0x0D only.
        words = text.encode().lower().split()
        if not words:
            return 0
        width = min(n, len(words))
        line = b" ".join(words)
        begins = list(accumulate(map(len, words), lambda at, size: at + size + 1, initial=0))
        total = len(words) - width + 1
        counts = np.zeros(BITS, dtype=np.int64)
        for at in range(0, total, SHINGLES_AT_ONCE):
            to = min(at + SHINGLES_AT_ONCE, total)
            hashes = np.array(
                [xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(begins[at:to], begins[at + width : to + width])],
                dtype="<u8",
            )
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += np.add.reduce(bits, axis=0, dtype=np.uint16)
        return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])

    return of


def fingerprints(docs: DataFrame, n: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the 64 bits as a signed bigint."""

    def hash_texts(batches: Iterable) -> Iterator:
        import numpy as np

        of = fingerprinter(n)
        for batch in batches:
            found = np.array([of(text.as_py() or "") for text in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[key, "fp"])

    return docs.select(key, text).mapInArrow(hash_texts, keyed_schema(docs, key, "fp bigint"))


def mask_of(part: Sequence[int]) -> int:
    return sum(1 << bit for bit in part)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def bits_together(classes: DataFrame) -> Any:
    """counts[i, j]: the classes in which bits i and j are both 1. Tasks add up matrices; 2,080 numbers are collected."""

    def count(batches: Iterable) -> Iterator:
        import numpy as np

        total = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            bytes_ = np.array(batch.column(0)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(bytes_, axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i * BITS + j), pa.array(total[i, j])], names=["cell", "n"])

    import numpy as np

    counts = np.zeros(BITS * BITS, dtype=np.int64)
    for row in classes.select("fp").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    counts = counts.reshape(BITS, BITS)
    return np.maximum(counts, counts.T)


def parts_of(together: Any, total: int, m: int) -> list[list[int]]:
    """The bits in `m` parts of nearly equal width; a part takes in the bit that goes together best with what it holds."""
    import numpy as np

    share = np.diag(together) / total
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    alike = np.abs(together / total - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(alike, 0)
    free, parts = set(range(BITS)), []
    for k in range(m):
        width = len(free) // (m - k)
        part = [max(sorted(free), key=lambda b: alike[b, sorted(free)].sum())]
        free.discard(part[0])
        while len(part) < width:
            part.append(max(sorted(free), key=lambda b: alike[b, part].sum()))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def pairs_that_meet(classes: DataFrame, masks: Sequence[int]) -> list[float]:
    """For each mask, about how many ordered pairs of classes are equal under it, a class with itself included.

    A random sign for each key is added up in a cell of its own hash; the sum of the cells' squares is the estimate, and
    cells of all tasks add up. All classes count.
    """
    masks = list(masks)

    def sketch(batches: Iterable) -> Iterator:
        import numpy as np

        cells = np.zeros((len(masks), CELLS), dtype=np.int64)
        for batch in batches:
            fps = np.array(batch.column(0)).view(np.uint64)
            for k, mask in enumerate(masks):
                x = (fps & np.uint64(mask)) * np.uint64(0x9E3779B97F4A7C15)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                x ^= x >> np.uint64(32)
                sign = np.where(x >> np.uint64(63), 1, -1)
                cells[k] += np.bincount((x & np.uint64(CELLS - 1)).astype(np.int64), weights=sign, minlength=CELLS).astype(np.int64)
        k, cell = np.nonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(cell), pa.array(cells[k, cell])], names=["k", "cell", "n"])

    summed = classes.select("fp").mapInArrow(sketch, "k bigint, cell bigint, n bigint").groupBy("k", "cell").agg(F.sum("n").alias("n"))
    found = {row["k"]: row["pairs"] for row in summed.groupBy("k").agg(F.sum(F.col("n").cast("double") ** 2).alias("pairs")).collect()}
    return [found.get(k, 0.0) for k in range(len(masks))]


def allot(costs: Sequence[Sequence[float]], budget: int) -> tuple[float, list[int]]:
    """(cost, thresholds): thresholds from -1 on that add up to `budget` at the least cost; costs[i][t + 1] is part i's."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, own in enumerate(part, start=-1):
                if spent + t not in step or cost + own < step[spent + t][0]:
                    step[spent + t] = (cost + own, [*chosen, t])
        best = step
    return best[budget]


def plan(classes: DataFrame, total: int, distance: int) -> list[tuple[list[int], int]]:
    """[(bits of a part, its threshold)] of the plan that is estimated to be the cheapest; parts at -1 are left out."""
    import numpy as np

    together = bits_together(classes)
    layouts = {m: parts_of(together, total, m) for m in range(1, MOST_PARTS + 1)}
    masks = [mask_of(part) for parts in layouts.values() for part in parts]
    meet = iter(pairs_that_meet(classes, masks))
    share = np.diag(together) / total
    # Odds that two classes differ in a bit.
    odds = [2 * p * (1 - p) / (1 - 2 * p * (1 - p)) for p in share]
    plans = []
    for m, parts in layouts.items():
        costs = []
        for part in parts:
            equal = max(next(meet) - total, 0.0) / 2
            own, widening, probes = [0.0], 0.0, 0
            for t in range(distance + 1):
                widening += sum(float(np.prod([odds[b] for b in flips])) for flips in combinations(part, t)) if t < 3 else 0.0
                probes += sum(1 for _ in combinations(part, t))
                own.append(PROBE_COST * total * (1 if t == 0 else probes / 2) + equal * widening)
            costs.append(own)
        cost, thresholds = allot(costs, distance - m + 1)
        plans.append((cost, m, [(part, t) for part, t in zip(parts, thresholds) if t >= 0]))
    return min(plans, key=lambda p: p[:2])[2]


def post_and_probe(classes: DataFrame, parts: Sequence[tuple[Sequence[int], int]]) -> DataFrame:
    """(mask, key, fp, probe): each class under its own key of each part, and as a probe under the keys near it.

    Of two classes that differ in some bits of a part, only the one with a 0 in the lowest of them probes the other.
    """
    moves = [
        (mask_of(part), mask_of(flips), flips[0] if flips else -1)
        for part, threshold in parts for t in range(threshold + 1) for flips in combinations(part, t)
    ]

    def emit(batches: Iterable) -> Iterator:
        import numpy as np

        for batch in batches:
            fps = np.array(batch.column(0)).view(np.uint64)
            for mask, flips, lowest in moves:
                own = fps if lowest < 0 else fps[(fps >> np.uint64(lowest)) & np.uint64(1) == 0]
                keys = (own & np.uint64(mask)) ^ np.uint64(flips)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), signed(mask))), pa.array(keys.view(np.int64)), pa.array(own.view(np.int64)),
                     pa.array(np.full(len(own), lowest >= 0))],
                    names=["mask", "key", "fp", "probe"],
                )

    return classes.select("fp").mapInArrow(emit, "mask bigint, key bigint, fp bigint, probe boolean")


def split(rows: DataFrame, distance: int) -> DataFrame:
    """Rows of too large groups under finer keys: the bits outside of the mask in distance + 1 parts, one of them equal."""

    def refine(batches: Iterable) -> Iterator:
        import numpy as np

        finer: dict[int, list[int]] = {}
        for batch in batches:
            masks, keys, fps = (np.array(batch.column(k)).view(np.uint64) for k in range(3))
            probe = np.array(batch.column(3))
            for mask in np.unique(masks).tolist():
                if mask not in finer:
                    rest = [b for b in range(BITS) if not mask >> b & 1]
                    finer[mask] = [mask_of(rest[k :: distance + 1]) for k in range(distance + 1)]
                own = masks == np.uint64(mask)
                for more in finer[mask]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(own.sum(), signed(mask | more))),
                         pa.array((keys[own] | (fps[own] & np.uint64(more))).view(np.int64)),
                         pa.array(fps[own].view(np.int64)), pa.array(probe[own])],
                        names=["mask", "key", "fp", "probe"],
                    )

    return rows.mapInArrow(refine, rows.schema)


def compared(rows: DataFrame, distance: int) -> DataFrame:
    """(a, b): links inside the groups of (mask, key), enough to connect what is connected; a is not above b."""

    def near(x, y):
        import numpy as np

        return np.bitwise_count(x ^ y) <= distance

    def spanning(fps, probe):
        """Links of one group: pairs are compared block by block, and each member points at its component's first."""
        import numpy as np

        posts = np.unique(fps[~probe])
        members = np.unique(fps)
        root = np.arange(len(members))
        place = np.searchsorted(members, posts)
        step = max(1, (1 << 20) // max(len(posts), 1))
        for at in range(0, len(members), step):
            i, j = np.nonzero(near(members[at : at + step, None], posts[None, :]))
            i, j = i + at, place[j]
            while True:
                low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
                apart = low != high
                if not apart.any():
                    break
                np.minimum.at(root, high[apart], low[apart])
                while (root != root[root]).any():
                    root = root[root]
        moved = np.flatnonzero(root != np.arange(len(members)))
        return members[root[moved]], members[moved]

    def compare(batches: Iterable) -> Iterator:
        import numpy as np

        def links(mask, key, fps, probe):
            """All groups of sorted rows: those of two rows at once, larger ones one by one."""
            first = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            size = np.diff(np.r_[first, len(key)])
            two = first[size == 2]
            two = two[near(fps[two], fps[two + 1]) & ~(probe[two] & probe[two + 1]) & (fps[two] != fps[two + 1])]
            a, b = [fps[two]], [fps[two + 1]]
            for at, n in zip(first[size > 2], size[size > 2]):
                if not probe[at : at + n].all():
                    low, high = spanning(fps[at : at + n], probe[at : at + n])
                    a.append(low)
                    b.append(high)
            a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        held = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)]
        for batch in batches:
            new = [np.array(batch.column(k)).view(np.uint64) for k in range(3)] + [np.array(batch.column(3), dtype=bool)]
            held = [np.concatenate(both) for both in zip(held, new)]
            mask, key = held[0], held[1]
            # The last group may go on in the next batch.
            open_ = (mask == mask[-1]) & (key == key[-1]) if len(key) else np.zeros(0, bool)
            if not open_.all():
                yield links(*(column[~open_] for column in held))
                held = [column[open_] for column in held]
        if len(held[0]):
            yield links(*held)

    dealt = rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(compare, "a bigint, b bigint")


def links_between(classes: DataFrame, distance: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that connect all classes whose fingerprints differ in `distance` bits at most."""
    total = classes.count()
    if total < 2:
        return classes.sparkSession.createDataFrame([], "a bigint, b bigint")
    rows = settle(post_and_probe(classes, plan(classes, total, distance)))
    found = []
    while True:
        groups = rows.groupBy("mask", "key").agg(F.count("*").alias("rows"), F.min("probe").alias("unposted"))
        # With no more bits open than may differ, a group is small whatever the input.
        divisible = (F.col("rows") > group_rows) & ~F.col("unposted") & (F.bit_count("mask") < BITS - distance)
        large = settle(groups.where(divisible).select("mask", "key"))
        if large.isEmpty():
            found.append(compared(rows, distance))
            break
        named = broadcast_when_small(large)
        found.append(settle(compared(rows.join(named, ["mask", "key"], "left_anti").select(*rows.columns), distance)))
        rows = settle(split(rows.join(named, ["mask", "key"], "left_semi").select(*rows.columns), distance))
    return settle(reduce(DataFrame.unionByName, found).distinct())


def link_documents(
    docs: DataFrame, n: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(key, fingerprint, component_id) for every document; the fingerprint as 16 lowercase hex digits.

    `group_rows` bounds what one task compares at a time; results are the same for any.
    """
    named = settle(fingerprints(docs, n, key, text))
    classes = settle(named.groupBy("fp").agg(F.min(key).alias("low")))
    roots = components(links_between(classes, distance, group_rows))
    rooted = settle(classes.join(roots.withColumnRenamed("c", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = settle(rooted.join(lowest, "root").select("fp", "component_id"))
    return named.join(broadcast_when_small(ids), "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

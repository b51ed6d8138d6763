"""The trie of conversation prefixes, in node tables addressed by minimal perfect hashes.

A conversation is rebuilt from the first turns of its family's first one and its own later turns (`rebuild`). Each distinct
sequence of first turns is a node, known by a 128-bit digest: the exclusive or of a hash of every turn with its depth, so
that digests of all prefixes are one running fold. Two ways to the same digest are told apart by a third hash, and a
mismatch is an error.

- Nodes are enumerated once: members are counted for each digest, in the map tasks first, so that a hot prefix (the root
  is in every conversation) is a row for each task.
- A node belongs to its smallest member, and the nodes of one member are the end of its path. Such a chain, cut every
  `LEVELS` levels, is a unit; units are dealt over shards by hash. No unit is longer, however hot a prefix is.
- A shard is a table of flat NumPy arrays. A minimal perfect hash of the shard's digests gives each node a slot; the
  digest stored in the slot tells whether a looked-up one is there at all. Counts are scattered into the slots, parents
  are looked up as slots, and sums go up through the array of parent slots, from the deepest level on.
- What a unit's top owes to its parent in another shard is first summed for each unit, then over the tree of units by
  doubling the distance to the ancestor, which takes as many rounds as the logarithm of its height. A second pass over the
  shards scatters these totals into the slots that they hang on, and adds up once more.

Turns are ordered by turn number (null first), then role and text. A conversation's rows are numbered by parts of a range
partitioning and the parts' offsets, so that one conversation may be longer than a task. Null roles and texts are empty;
rows without a conversation id belong to no conversation; repeated rows are turns like others. Without conversations
there is no node.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketpulse.llm.common import settle
from marketpulse.operators.sizing import broadcast_when_small

# Levels of a unit, and nodes of a shard on average.
LEVELS, NODES_PER_SHARD = 1 << 16, 1 << 18
# Ids that are joined to one text before they are hashed.
IDS_AT_ONCE = 4096
# Turns that a conversation may take over from its family's first one.
FAMILY, MOST_SHARED = 5, 8

DIGEST = ["h1", "h2"]


def running(rows: DataFrame, key: str, order: list[Column], folds: dict[str, tuple[str, Column]]) -> DataFrame:
    """`rows` with running folds over the rows of a key, in order: name -> ("count" or "bit_xor", column).

    Rows are range partitioned by key and order, so a key may span parts. Each part folds its own rows, and the folds of
    the parts before it, a few numbers for each key that spans parts, are put in front.
    """
    fold = {"count": F.count, "bit_xor": F.bit_xor}
    ordered = [F.col(key), *order]
    parts = settle(rows.repartitionByRange(*ordered).withColumn("_part", F.spark_partition_id()))
    whole = parts.groupBy(key, "_part").agg(*[fold[how](column).alias(f"_{name}") for name, (how, column) in folds.items()])
    spans = Window.partitionBy(key)
    before = spans.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # Only keys that span parts have anything in front of them: at most one row for each part.
    offsets = settle(
        whole.withColumn("_parts", F.count("*").over(spans)).where("_parts > 1").select(
            key, "_part", *[(F.sum if how == "count" else fold[how])(f"_{name}").over(before).alias(f"_{name}") for name, (how, _) in folds.items()]
        )
    )
    here = Window.partitionBy(key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = parts.join(broadcast_when_small(offsets), [key, "_part"], "left")
    for name, (how, column) in folds.items():
        folded, front = fold[how](column).over(here), F.coalesce(F.col(f"_{name}"), F.lit(0))
        own = own.withColumn(name, folded.bitwiseXOR(front) if how == "bit_xor" else folded + front)
    return own.drop("_part", *[f"_{name}" for name in folds])


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, role, text), (conv, n)): the turns of the rebuilt conversations, and their lengths, 0 included."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).where("conv IS NOT NULL")
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    numbered = settle(running(turns, "conv", order, {"at": ("count", F.lit(1))}).select("conv", "at", "role", "text"))
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    lengths = settle(numbered.groupBy("conv").agg(F.max("at").alias("own")))
    named = lengths.select("conv", "own", shared.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("first"))
    firsts = lengths.select(F.col("conv").alias("first"), F.least("own", F.lit(MOST_SHARED)).alias("there"))
    convs = settle(named.join(firsts, "first", "left").select(
        "conv", "first", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"), "own"
    ))
    kept = numbered.join(convs.select("conv", "h", "taken"), "conv").where(F.col("at") > F.col("h")).select(
        "conv", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "role", "text"
    )
    heads = numbered.where((F.col("conv") % FAMILY == 0) & (F.col("at") <= MOST_SHARED)).withColumnRenamed("conv", "first")
    taken = heads.join(convs.where("taken > 0").select("conv", "first", "taken"), "first").where(F.col("at") <= F.col("taken")).select(
        "conv", F.col("at").alias("depth"), "role", "text"
    )
    sizes = convs.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return kept.unionByName(taken), sizes


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, h1, h2, p1, p2, check, bytes): every prefix of one turn and more, with its parent's digest."""
    hashed = turns.select(
        "conv", "depth", F.octet_length("text").cast("bigint").alias("bytes"), F.xxhash64("role", "text").alias("check"),
        F.xxhash64(F.lit("first"), "depth", "role", "text").alias("t1"), F.xxhash64(F.lit("second"), "depth", "role", "text").alias("t2"),
    )
    folds = {"h1": ("bit_xor", F.col("t1")), "h2": ("bit_xor", F.col("t2"))}
    own = running(hashed, "conv", [F.col("depth")], folds)
    return own.select(
        "conv", "depth", "h1", "h2", F.col("h1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("h2").bitwiseXOR(F.col("t2")).alias("p2"), "check", "bytes"
    )


def enumerate_nodes(paths: DataFrame, sizes: DataFrame) -> DataFrame:
    """(h1, h2, p1, p2, depth, low, n_convs, bytes): one row for each node; the root's digest is zero, its parent null."""
    counted = paths.groupBy("depth", *DIGEST).agg(
        F.min("conv").alias("low"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        ((F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2")) & (F.min("check") == F.max("check"))).alias("same"),
    )
    checked = F.when(F.col("same"), F.col("n_convs")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("bigint"))
    below = counted.select(*DIGEST, "p1", "p2", "depth", "low", checked.alias("n_convs"), "bytes")
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    root = sizes.agg(F.min("conv").alias("low"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("h1"), zero.alias("h2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), "low", "n_convs", zero.alias("bytes")
    )
    return below.unionByName(root)


class NodeTable:
    """A minimal perfect hash of distinct 128-bit digests: slots 0 to n - 1, each with its digest beside it.

    Levels of bitmaps: a digest that has a place of a level for itself gets it, those that collide go to the next level.
    The number of places taken before is the slot.
    """

    def __init__(self, h1: Any, h2: Any):
        import numpy as np

        self.levels: list = []
        left, rank = np.arange(len(h1)), 0
        self.h1, self.h2 = np.empty_like(h1), np.empty_like(h2)
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("a digest is there twice")
            size = 2 * len(left) + 1
            place = self.place(h1[left], h2[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            slots = np.cumsum(alone) - 1 + rank
            self.levels.append((size, alone, slots))
            placed = alone[place]
            own = slots[place[placed]]
            self.h1[own], self.h2[own] = h1[left[placed]], h2[left[placed]]
            rank += int(alone.sum())
            left = left[~placed]

    @staticmethod
    def place(h1: Any, h2: Any, level: int, size: int) -> Any:
        import numpy as np

        x = h1.view(np.uint64) ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + h2.view(np.uint64)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def slots(self, h1: Any, h2: Any) -> Any:
        """The slot of each digest; -1 for one that is not in the table, as the digest in the slot tells."""
        import numpy as np

        found, open_ = np.full(len(h1), -1), np.arange(len(h1))
        for level, (size, alone, slots) in enumerate(self.levels):
            place = self.place(h1[open_], h2[open_], level, size)
            here = alone[place]
            found[open_[here]] = slots[place[here]]
            open_ = open_[~here]
        if len(self.h1):
            found[(self.h1[found] != h1) | (self.h2[found] != h2)] = -1
        return found


def add_up(columns: dict[str, Any], final: bool) -> Any:
    """The nodes of a shard with what hangs on them: (the tops' sums) or (all nodes' results), as Arrow columns.

    `columns` holds nodes and, where `hung` is set, rows that bring children, leaves and saved bytes of units below.
    """
    import numpy as np

    is_node = ~columns["hung"]
    node = {name: column[is_node] for name, column in columns.items()}
    table = NodeTable(node["h1"], node["h2"])
    own = table.slots(node["h1"], node["h2"])
    n = len(own)

    def scattered(name: str) -> Any:
        out = np.zeros(n, dtype=np.int64)
        out[own] = node[name]
        return out

    low, depth, convs, size, unit_low = (scattered(name) for name in ("low", "depth", "n_convs", "bytes", "low"))
    p1, p2, rooted = scattered("p1"), scattered("p2"), scattered("rooted").astype(bool)
    parent = table.slots(p1, p2)
    # A parent in another unit of the shard counts as one in another shard: what it gets comes as a hung row.
    block = depth // LEVELS
    inside = (parent >= 0) & rooted
    inside &= (low[parent] == unit_low) & (block[parent] == block)
    hung = {name: column[columns["hung"]] for name, column in columns.items()}
    at = table.slots(hung["h1"], hung["h2"])
    children, leaves, saved = (np.zeros(n, dtype=np.int64) for _ in range(3))
    np.add.at(children, at, hung["n_children"])
    np.add.at(leaves, at, hung["n_leaves"])
    np.add.at(saved, at, hung["saved"])
    np.add.at(children, parent[inside], 1)
    leaves += children == 0
    saved += (convs - 1) * size
    # From the deepest level up: all children of a slot are done before it hands on its sums.
    order = np.argsort(-depth, kind="stable")
    ends = np.r_[np.flatnonzero(np.diff(depth[order])) + 1, n] if n else []
    begin = 0
    for end in ends:
        level = order[begin:end]
        level = level[inside[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
        begin = end
    top = ~inside
    if not final:
        return [low[top], block[top], leaves[top], saved[top]]
    parent_low = np.where(inside, low[parent], scattered("parent_low"))
    return [table.h1, table.h2, low, depth, np.where(rooted, parent_low, 0), rooted, convs, children, leaves, saved]


def over_shards(rows: DataFrame, shards: int, final: bool) -> DataFrame:
    """One pass over the node tables: each shard's rows are one group."""
    names = ["h1", "h2", "p1", "p2", "depth", "low", "n_convs", "bytes", "parent_low", "n_children", "n_leaves", "saved"]
    out = "h1 bigint, h2 bigint, low bigint, depth bigint, parent_low bigint, rooted boolean, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint"
    schema = out if final else "low bigint, block bigint, n_leaves bigint, saved bigint"
    fields = [field.split()[0] for field in schema.split(", ")]

    def accumulate(batches: Iterable) -> Iterator:
        import numpy as np

        held: dict[str, list] = {name: [] for name in [*names, "rooted", "hung"]}
        current: list = []

        def finish():
            columns = {name: np.concatenate(parts) for name, parts in held.items()}
            for parts in held.values():
                parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in add_up(columns, final)], names=fields)

        for batch in batches:
            shard = np.asarray(batch.column("shard"))
            bounds = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)]
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if end == begin:
                    continue
                if current and current[0] != shard[begin]:
                    yield finish()
                current[:] = [shard[begin]]
                part = batch.slice(begin, end - begin)
                for name in names:
                    held[name].append(np.asarray(part.column(name).fill_null(0)).astype(np.int64))
                held["rooted"].append(~np.asarray(part.column("p1").is_null()))
                held["hung"].append(np.asarray(part.column("hung").fill_null(False)).astype(bool))
        if current:
            yield finish()

    placed = rows.withColumn("shard", F.pmod(F.xxhash64("low", F.col("block")), F.lit(shards)))
    dealt = placed.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(accumulate, schema)


def unit_totals(units: DataFrame) -> DataFrame:
    """(low, block, n_leaves, saved) over each unit and all units below it, from rows with `up_low`, `up_block` (null on top).

    In round k a unit hands its sum to its ancestor 2^k units up and asks that one for its own: sums of all units less than
    2^k below become sums of all less than 2^(k+1) below.
    """
    unit, up = ["low", "block"], ["up_low", "up_block"]
    state = units
    while not state.where("up_low IS NOT NULL").isEmpty():
        open_ = state.where("up_low IS NOT NULL")
        gained = open_.groupBy(*up).agg(F.sum("n_leaves").alias("more"), F.sum("saved").alias("most")).withColumnsRenamed(dict(zip(up, unit)))
        further = state.select(F.col("low").alias("up_low"), F.col("block").alias("up_block"), F.col("up_low").alias("far_low"), F.col("up_block").alias("far_block"))
        moved = open_.join(further, up).select(*unit, F.col("far_low").alias("up_low"), F.col("far_block").alias("up_block"), "n_leaves", "saved")
        kept = moved.unionByName(state.where("up_low IS NULL"))
        state = settle(kept.join(gained, unit, "left").select(
            *unit, *up, (F.col("n_leaves") + F.coalesce("more", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("most", F.lit(0))).alias("saved")
        ))
    return state.select(*unit, "n_leaves", "saved")


def end_digests(ends: DataFrame) -> DataFrame:
    """(h1, h2, ends_sha256): SHA-256 of the ids that end at a node, ascending, joined by commas.

    Ids are range partitioned by node and id, so the ids of a hot node are sorted and joined by many tasks, some thousands
    at a time; only these pieces meet in the task that hashes them, one after another.
    """
    def join_ids(batches: Iterable) -> Iterator:
        import numpy as np

        for batch in batches:
            h1, h2, conv = (np.asarray(batch.column(k)) for k in range(3))
            cut = np.flatnonzero((np.diff(h1) != 0) | (np.diff(h2) != 0)) + 1
            bounds = np.unique(np.r_[0, cut, np.arange(0, len(h1), IDS_AT_ONCE), len(h1)])
            firsts = bounds[:-1]
            texts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(firsts, bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(h1[firsts]), pa.array(h2[firsts]), pa.array(conv[firsts]), pa.array(texts, pa.string())], names=["h1", "h2", "first", "ids"])

    def digest(batches: Iterable) -> Iterator:
        from hashlib import sha256

        node, state = None, None
        for batch in batches:
            out: list = []
            for h1, h2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if node == (h1, h2):
                    state.update(b"," + ids.encode())
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (h1, h2), sha256(ids.encode())
            yield batch_of(out)
        if node is not None:
            yield batch_of([(*node, state.hexdigest())])

    def batch_of(rows: list):
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=["h1", "h2", "ends_sha256"])

    by_node = ends.select(*DIGEST, "conv").repartitionByRange(*DIGEST, "conv").sortWithinPartitions(*DIGEST, "conv")
    pieces = settle(by_node.mapInArrow(join_ids, "h1 bigint, h2 bigint, first bigint, ids string"))
    return pieces.repartition(*DIGEST).sortWithinPartitions(*DIGEST, "first").mapInArrow(digest, "h1 bigint, h2 bigint, ends_sha256 string")


def build_trie(conversations: DataFrame, nodes_per_shard: int = NODES_PER_SHARD) -> DataFrame:
    """One row for each node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    turns, sizes = rebuild(conversations)
    sizes = settle(sizes)
    paths = settle(prefixes(turns))
    nodes = settle(enumerate_nodes(paths, sizes).withColumn("block", F.floor(F.col("depth") / LEVELS)))
    shards = -(-nodes.count() // nodes_per_shard) or 1

    # Tops of units, with the unit of their parent: the member below is not the parent's smallest, or the level is cut.
    above = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("depth").alias("_up"), F.col("low").alias("up_low"), F.col("block").alias("up_block"))
    children = nodes.where("p1 IS NOT NULL")
    met = children.join(above, (children["p1"] == above["p1"]) & (children["p2"] == above["p2"]) & (children["depth"] == above["_up"] + 1)).select(
        *[children[c] for c in nodes.columns], "up_low", "up_block"
    )
    tops = settle(met.where((F.col("low") != F.col("up_low")) | (F.col("block") != F.col("up_block"))).select(
        *DIGEST, "p1", "p2", "low", "block", "up_low", "up_block"
    ))
    zero = F.lit(0).cast("bigint")
    no_sums = {"parent_low": zero, "n_children": zero, "n_leaves": zero, "saved": zero}
    plain = nodes.withColumns({**no_sums, "hung": F.lit(False)})

    def hung_rows(leaves: Column, saved: Column, rows: DataFrame) -> DataFrame:
        """What hangs on a node of another unit, summed for each node first."""
        summed = rows.groupBy("p1", "p2", "up_low", "up_block").agg(
            F.count("*").alias("n_children"), F.sum(leaves).alias("n_leaves"), F.sum(saved).alias("saved")
        )
        return summed.select(
            F.col("p1").alias("h1"), F.col("p2").alias("h2"), zero.alias("p1"), zero.alias("p2"), zero.alias("depth"), F.col("up_low").alias("low"),
            zero.alias("n_convs"), zero.alias("bytes"), F.col("up_block").alias("block"), zero.alias("parent_low"), "n_children", "n_leaves", "saved",
            F.lit(True).alias("hung"),
        )

    own = over_shards(plain.unionByName(hung_rows(zero, zero, tops)), shards, final=False)
    units = settle(own.join(tops.select("low", "block", "up_low", "up_block"), ["low", "block"], "left").select(
        "low", "block", "up_low", "up_block", "n_leaves", "saved"
    ))
    totals = unit_totals(units)
    owed = settle(tops.join(totals, ["low", "block"]))
    parents = owed.select(*DIGEST, F.col("up_low").alias("_low"))
    known = plain.drop("parent_low").join(parents, DIGEST, "left").withColumn("parent_low", F.coalesce("_low", zero)).drop("_low")
    results = over_shards(known.unionByName(hung_rows(F.col("n_leaves"), F.col("saved"), owed)), shards, final=True)

    lasts = paths.join(sizes, "conv").where(F.col("depth") == F.col("n")).select(*DIGEST, "conv")
    ends = end_digests(lasts.unionByName(sizes.where("n = 0").select(zero.alias("h1"), zero.alias("h2"), "conv")))
    return results.join(ends, DIGEST, "left").select(
        F.col("low").alias("conv_id"), "depth", F.when(F.col("rooted"), F.col("parent_low")).alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )

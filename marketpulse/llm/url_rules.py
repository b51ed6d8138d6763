"""URL filtering with a sorted digest array.

Rules are keyed by host and path prefix. Their 64-bit xxhash keys stand sorted in a file that tasks map into memory; a
batch of candidate keys is probed with one vectorised binary search, and a hit counts only if the stored string is the
candidate itself, so two strings with one digest cannot be mixed up.

A url's candidates are its host and parent domains of as many labels as some rule's host, each with every prefix of its
path as long as some rule's path; a host of any length has no more candidates than that.
The longest rule that is found decides; a url that no rule fits gets the method's own verdict, `default`.

Null urls and urls without `://` have an empty host and path, and no rule fits them. Rules with equal keys: the last one
counts. No rules: every url gets the default.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence
from uuid import uuid4

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.llm.common import ascii_lower, keyed_schema
from marketpulse.session import ensure_checkpoint_dir

# What the digest file may hold, since every executor gets a copy of it.
INDEX_BYTES = 1 << 30


def host_of(url: Column | str) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column | str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def build_index(spark: SparkSession, rules: Sequence[tuple[str, str, str]], max_bytes: int = INDEX_BYTES) -> str:
    """Write (verdict, host, path) rules as a digest file to the shared folder, give it to all executors, return its name.

    Layout: the number of rules, then sorted keys, ends of the strings, verdicts (1 for block), and the strings.
    """
    import numpy as np
    import xxhash

    last = {host + path: verdict for verdict, host, path in rules}
    entries = sorted((xxhash.xxh64_intdigest(rule.encode()), rule.encode(), verdict == "block") for rule, verdict in last.items())
    blob = b"".join(
        (
            struct.pack("<q", len(entries)),
            np.array([e[0] for e in entries], dtype="<u8").tobytes(),
            np.cumsum([len(e[1]) for e in entries], dtype="<i8").tobytes(),
            np.array([e[2] for e in entries], dtype="<i8").tobytes(),
            *(e[1] for e in entries),
        )
    )
    if len(blob) > max_bytes:
        raise ValueError(f"the rules take {len(blob)} bytes, more than the {max_bytes} that executors are to hold")
    name = f"url-rules-{uuid4().hex}.bin"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark), name)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(blob))
    out.close()
    spark.sparkContext.addFile(target.toString())
    return name


class DigestArray:
    """The memory-mapped file of `build_index`."""

    def __init__(self, path: str):
        import numpy as np

        size = int(np.fromfile(path, dtype="<i8", count=1)[0])
        whole = np.memmap(path, dtype=np.uint8, mode="r")
        cut = 8 + 24 * size
        self.keys = whole[8 : 8 + 8 * size].view("<u8")
        self.ends = whole[8 + 8 * size : 8 + 16 * size].view("<i8")
        self.blocks = whole[8 + 16 * size : cut].view("<i8")
        self.strings = whole[cut:]

    def find(self, candidates: Sequence[str]):
        """Position of each candidate, or -1. Equal digests stand side by side, and each is tried."""
        import numpy as np
        import xxhash

        found = np.full(len(candidates), -1, dtype=np.int64)
        if not len(self.keys) or not candidates:
            return found
        raw = [c.encode() for c in candidates]
        digests = np.fromiter((xxhash.xxh64_intdigest(c) for c in raw), dtype=np.uint64, count=len(raw))
        at = np.searchsorted(self.keys, digests)
        hits = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests))
        for i in hits:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:
                if self.stored(k) == raw[i]:
                    found[i] = k
                    break
                k += 1
        return found

    def stored(self, k: int) -> bytes:
        return self.strings[(int(self.ends[k - 1]) if k else 0) : int(self.ends[k])].tobytes()


def parents(host: str, labels: Sequence[int]) -> list[str]:
    """The host's endings (itself or domains above it) of as many labels as given; no other could be a rule's host."""
    found = []
    for n in labels if host else ():
        pieces = host.rsplit(".", n)
        if len(pieces) >= n:
            found.append(".".join(pieces[-n:]))
    return found


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url", key: str = "page_id", default: str = "allow"
) -> DataFrame:
    """(key, host, path, rule, verdict) for every page; one pass over the urls, no shuffle."""
    name = build_index(pages.sparkSession, rules)
    lengths = sorted({len(path) for _, _, path in rules})
    labels = sorted({host.count(".") + 1 for _, host, _ in rules})
    rows = pages.select(key, host_of(url).alias("host"), path_of(url).alias("path"))

    def probe(batches: Iterable) -> Iterator:
        import pyarrow as pa

        index = DigestArray(SparkFiles.get(name))
        for batch in batches:
            candidates: list[str] = []
            owner: list[int] = []
            for i, (host, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for domain in parents(host, labels):
                    for length in lengths:
                        if length <= len(path):
                            candidates.append(domain + path[:length])
                            owner.append(i)
            best: list[int] = [-1] * batch.num_rows
            size: list[int] = [-1] * batch.num_rows
            hits = index.find(candidates)
            for j in (hits >= 0).nonzero()[0]:
                if len(candidates[j]) > size[owner[j]]:
                    best[owner[j]], size[owner[j]] = int(hits[j]), len(candidates[j])
            rule = [index.stored(k).decode() if k >= 0 else None for k in best]
            verdict = [default if k < 0 else "block" if index.blocks[k] else "allow" for k in best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=[key, "host", "path", "rule", "verdict"],
            )

    return rows.mapInArrow(probe, keyed_schema(pages, key, "host string, path string, rule string, verdict string"))

"""Conflict-constrained best-fit packing of documents into sequences.

Documents are cut into segments of at most ``capacity`` tokens; a full
segment is a sequence of its own. The rest goes, longest first, into the bin
with the tightest fitting residual that holds neither a document of the same
source nor one of the same duplicate cluster (a component of near copies, as
``bottomk`` finds them: five-word shingles, 0.75 or more). Bins are kept in residual
order and carry a bitmap of their sources and one of their clusters; the
search starts at the successor of the length and goes on until a compatible
bin is found (blocks of bins whose common bits already conflict are skipped
whole), else a new bin opens.

Bins never cross shards. A shard is a set of documents by a hash of doc_id
with at most some ``docs_per_shard`` rows of five numbers each, whatever the
distribution of sources and clusters; texts stay out of the shuffle.

Defined cases: a null or empty text has only its end token; a null source or
cluster counts as one more value; rows that repeat a doc_id are packed each,
equal ones in separate bins, as they are one cluster; ties in length go by
doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import bottomk
from attrition.llm.common import parts_for, prepare, stored

CAPACITY = 8192
DOCS_PER_SHARD = 8192


class ResidualOrder:
    """Bins in residual order, in blocks that know the bits common to all their bins."""

    WIDTH = 64

    def __init__(self):
        self.blocks: list[list[tuple[int, int]]] = []
        self.common: list[tuple[int, int]] = []
        self.sources: dict[int, int] = {}
        self.clusters: dict[int, int] = {}

    def _refresh(self, i: int) -> None:
        s = c = -1
        for _, b in self.blocks[i]:
            s &= self.sources[b]
            c &= self.clusters[b]
        self.common[i] = (s, c)

    def _block(self, key: tuple[int, int]) -> int:
        lo, hi = 0, len(self.blocks)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.blocks[mid][-1] < key:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def add(self, residual: int, number: int) -> None:
        key = (residual, number)
        i = min(self._block(key), len(self.blocks) - 1)
        if i < 0:
            self.blocks.append([key])
            self.common.append((0, 0))
            i = 0
        else:
            insort(self.blocks[i], key)
            if len(self.blocks[i]) > 2 * self.WIDTH:
                self.blocks.insert(i + 1, self.blocks[i][self.WIDTH:])
                self.common.insert(i + 1, (0, 0))
                del self.blocks[i][self.WIDTH:]
                self._refresh(i + 1)
        self._refresh(i)

    def take(self, length: int, source: int, cluster: int) -> tuple[int, int] | None:
        """Remove and return the tightest compatible bin (residual, number), if there is one."""
        key = (length, -1)
        i = self._block(key)
        at = bisect_left(self.blocks[i], key) if i < len(self.blocks) else 0
        while i < len(self.blocks):
            s, c = self.common[i]
            if not (s & source or c & cluster):
                block = self.blocks[i]
                for k in range(at, len(block)):
                    b = block[k][1]
                    if not (self.sources[b] & source or self.clusters[b] & cluster):
                        found = block.pop(k)
                        if block:
                            self._refresh(i)
                        else:
                            del self.blocks[i], self.common[i]
                        return found
            i, at = i + 1, 0
        return None


def pack_shard(items: list[tuple], capacity: int) -> list[tuple]:
    """(item index, segment, start, length, bin, position) of items (doc_id, length, source, cluster)."""
    out: list[tuple] = []
    rest = []
    bins = 0
    for i, (_, length, _, _) in enumerate(items):
        full = length // capacity
        for k in range(full):
            out.append((i, k, k * capacity, capacity, bins, 0))
            bins += 1
        if length % capacity or not full:
            rest.append((length - full * capacity, i, full))
    rest.sort(key=lambda r: (-r[0], items[r[1]][0] is not None, items[r[1]][0] or 0, r[1]))
    source_bit: dict = {}
    cluster_bit: dict = {}
    seen: dict = {}
    for _, i, _ in rest:
        seen[items[i][3]] = seen.get(items[i][3], 0) + 1
    order = ResidualOrder()
    for length, i, segment in rest:
        _, _, source, cluster = items[i]
        s = 1 << source_bit.setdefault(source, len(source_bit))
        # a cluster with one document here conflicts with nothing and needs no bit
        c = 1 << cluster_bit.setdefault(cluster, len(cluster_bit)) if seen[cluster] > 1 else 0
        found = order.take(length, s, c)
        if found is None:
            found = (capacity, bins)
            order.sources[bins] = order.clusters[bins] = 0
            bins += 1
        residual, number = found
        out.append((i, segment, segment * capacity, length, number, capacity - residual))
        order.sources[number] |= s
        order.clusters[number] |= c
        if residual > length:
            order.add(residual - length, number)
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """bin_id, bin_start, doc_id, segment, doc_start, length for doc_id, length, source, cluster."""
    spark = docs.sparkSession
    prepare(spark)
    shards = parts_for(spark, docs.count(), docs_per_shard)
    # rows without an id are alike: a number of their own deals them out
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    rows = docs.select("doc_id", F.col("length").cast("long").alias("length"), F.col("source").cast("string").alias("source"),
                       "cluster", F.pmod(F.xxhash64("doc_id", "length", "cluster", spread), F.lit(shards)).alias("shard"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        none = pdf["doc_id"].isna()
        ids = [None if gone else int(d) for d, gone in zip(pdf["doc_id"], none)]
        items = list(zip(ids, pdf["length"].tolist(), pdf["source"].tolist(), pdf["cluster"].tolist()))
        items.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], str(t[2]), str(t[3])))
        placed = pack_shard(items, capacity)
        out = pd.DataFrame([(int(key[0]) << 32 | b, pos, items[i][0], seg, start, n) for i, seg, start, n, b, pos in placed],
                           columns=["bin_id", "bin_start", "doc_id", "segment", "doc_start", "length"])
        return out.astype({"doc_id": "Int64"})

    return rows.groupBy("shard").applyInPandas(
        run, "bin_id bigint, bin_start int, doc_id bigint, segment int, doc_start bigint, length int")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack doc_id, text, source by byte tokens (UTF-8 bytes and an end token); clusters are near-duplicate components.

    A document is known by a hash of its id and text there, so null and repeated ids take part row by row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.xxhash64("doc_id", text).alias("doc_id"), text.alias("text"), F.col("doc_id").alias("own_id"),
                       (F.octet_length(text) + 1).alias("length"), "source", F.xxhash64(text).alias("hash"))
    near = bottomk.near_duplicates(rows, "own_id", "length", "source", "hash")
    # texts without words are in no component: equal ones are a cluster
    cluster = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("hash"))
    return pack(stored(near.select(F.col("own_id").alias("doc_id"), "length", "source", cluster.alias("cluster")), "lengths"), capacity)


def pack_distinct(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack documents of which no two are near copies, in the same way; equal texts are the only clusters looked for."""
    text = F.coalesce("text", F.lit(""))
    return pack(docs.select("doc_id", (F.octet_length(text) + 1).alias("length"), "source", F.xxhash64(text).alias("cluster")), capacity)

"""Nearest neighbours by multi-index hashing over learned binary codes.

A bounded sample trains iterative quantization: principal axes and several
learned rotations, whose signs are the bits of a code. Every row is coded and
indexed. Codes are split into 16-bit substrings, one table each: by the
pigeonhole principle a code within Hamming radius ``r`` of the query agrees
with it up to ``r // m`` bits in at least one of the ``m`` substrings, so
probing those buckets of every table retrieves all codes within ``r``. They
are filtered by their full Hamming distance and reranked by the exact
Euclidean distance on the original vectors.

The radius is learned on the sample as a high quantile of the Hamming
distance of true neighbours; true neighbours in the whole table are closer.
A query with fewer than k rows inside the radius widens it in that block.

Layout: rows are dealt by a hash of vec_id over blocks of bounded size, so
equal vectors (a hot vector may hold a third of all rows) spread over all
blocks; the stated query set is copied to every block, and each block returns
at most k rows per query. Nothing else crosses the shuffle twice.

Defined cases: vectors that are null, zero, hold null or non-finite
components or have another dimension than most take no part; rows that repeat
a vec_id count once (the smallest vector); ties go to the smaller vec_id;
fewer than k candidates give all of them; an empty table gives no rows.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.common import parts_for, prepare

#: Rows of the bounded sample that trains rotations and radius.
SAMPLE_ROWS = 4096
ROTATIONS = 4
SUB_BITS = 16
#: Quantile of the sample's true-neighbour Hamming distances that becomes the radius.
RADIUS_QUANTILE = 0.98
ROWS_PER_BLOCK = 65536


def valid_vector(c: Column, dim: int) -> Column:
    ok = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return c.isNotNull() & (F.size(c) == dim) & F.coalesce(ok, F.lit(False)) & F.exists(c, lambda x: x != 0)


def train_codes(x: np.ndarray, rotations: int = ROTATIONS, rounds: int = 25, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): ITQ rotations of the principal axes, side by side."""
    mean = x.mean(0)
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    v = centred @ axes[:, ::-1]
    rng = np.random.default_rng(seed)
    mats = []
    for _ in range(rotations):
        r, _ = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))
        for _ in range(rounds):
            u, _, wt = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ wt).T
        mats.append(axes[:, ::-1] @ r)
    return mean, np.concatenate(mats, axis=1)


def encode(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """Substrings of the codes: uint16 array (rows, tables); spare bits of the last are 0."""
    bits = (x - mean) @ proj >= 0
    spare = -bits.shape[1] % SUB_BITS
    if spare:
        bits = np.pad(bits, ((0, 0), (0, spare)))
    return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


def learn_radius(x: np.ndarray, mean: np.ndarray, proj: np.ndarray, k: int, queries: int = 256) -> int:
    """The Hamming radius that holds nearly all true neighbours of sampled queries."""
    subs = encode(x, mean, proj)
    seen = []
    for i in range(min(queries, len(x))):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(x) - 1)]
        seen.extend(np.bitwise_count(subs[near] ^ subs[i]).sum(1))
    return int(np.ceil(np.quantile(seen, RADIUS_QUANTILE))) if seen else proj.shape[1]


class SubstringTables:
    """One sorted bucket table per substring over the codes of a block."""

    def __init__(self, subs: np.ndarray):
        self.subs = subs
        self.order, self.values, self.starts = [], [], []
        for t in range(subs.shape[1]):
            order = np.argsort(subs[:, t], kind="stable")
            values, starts = np.unique(subs[order, t], return_index=True)
            self.order.append(order)
            self.values.append(values)
            self.starts.append(np.append(starts, len(order)))
        self.flips = {0: np.zeros(1, np.uint16)}

    def _masks(self, r: int) -> np.ndarray:
        if r not in self.flips:
            every = np.arange(1 << SUB_BITS, dtype=np.uint32).astype(np.uint16)
            self.flips[r] = every[np.bitwise_count(every) <= r]
        return self.flips[r]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Row numbers of every code within the Hamming radius of ``code``."""
        r = min(radius // len(code), SUB_BITS)
        probes = sum(comb(SUB_BITS, i) for i in range(r + 1))
        hit = np.zeros(len(self.subs), bool)
        for t, value in enumerate(code):
            values, starts = self.values[t], self.starts[t]
            if probes < len(values):   # visit the probed buckets
                at = np.searchsorted(values, self._masks(r) ^ value)
                at = at[at < len(values)]
                at = np.unique(at[np.bitwise_count(values[at] ^ value) <= r])
            else:                      # visit the occupied buckets
                at = np.flatnonzero(np.bitwise_count(values ^ value) <= r)
            if len(at) == len(values):
                hit[:] = True
                break
            sizes = starts[at + 1] - starts[at]
            rows = np.repeat(starts[at] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            hit[self.order[t][rows]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.subs[found] ^ code).sum(1) <= radius]


def search_block(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, mean: np.ndarray,
                 proj: np.ndarray, radius: int, k: int) -> list[tuple[int, int, float]]:
    """(query_id, vec_id, distance) of the k nearest rows found for each query in one block."""
    tables = SubstringTables(encode(x, mean, proj))
    codes = encode(q, mean, proj)
    out: list[tuple[int, int, float]] = []
    for qid, vec, code in zip(qids, q, codes):
        own = int(np.searchsorted(ids, qid) < len(ids) and ids[np.searchsorted(ids, qid)] == qid)
        want, r = min(k, len(ids) - own), radius
        while True:
            rows = tables.within(code, r)
            if own:
                rows = rows[ids[rows] != qid]
            if len(rows) >= want or r >= proj.shape[1] + SUB_BITS:
                break
            r += SUB_BITS
        d = np.sqrt(((x[rows] - vec) ** 2).sum(1))
        if len(rows) > k:   # all ties of the k-th stay for the id order
            near = d <= np.partition(d, k - 1)[k - 1]
            rows, d = rows[near], d[near]
        best = np.lexsort((ids[rows], d))[:k]
        out.extend((int(qid), int(ids[rows[i]]), float(d[i])) for i in best)
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, sample_rows: int = SAMPLE_ROWS,
            rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for the rows where ``is_query``.

    ``vectors``: vec_id (bigint), embedding (array of float or double).
    """
    spark = vectors.sparkSession
    prepare(spark)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    dims = vectors.groupBy(F.size("embedding").alias("d")).count().filter("d > 0").orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], schema)
    rows = vectors.filter(valid_vector(F.col("embedding"), dims["d"]) & F.col("vec_id").isNotNull()).select(
        "vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("is_query"))
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("embedding").toPandas()
    if n == 0:
        return spark.createDataFrame([], schema)
    x = np.stack(sample["embedding"].to_numpy()).astype(np.float64)
    mean, proj = train_codes(x)
    radius = learn_radius(x, mean, proj, k)
    blocks = parts_for(spark, n, rows_per_block)
    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "embedding")
    asked = rows.filter("is_query").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                                           F.col("vec_id").alias("query_id"), "embedding")

    def distinct(ids: pd.Series, vecs: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        v = np.stack(vecs.to_numpy()).astype(np.float64)
        order = np.lexsort((*v.T[::-1], ids.to_numpy()))
        i = ids.to_numpy()[order]
        first = np.append(True, i[1:] != i[:-1])
        return i[first], v[order][first]

    def search(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(block) and len(queries):
            found = search_block(*distinct(block["vec_id"], block["embedding"]),
                                 *distinct(queries["query_id"], queries["embedding"]), mean, proj, radius, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    parts = dealt.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(
        search, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

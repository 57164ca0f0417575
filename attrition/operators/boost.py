"""Second-order gradient boosting over histograms, many fits in one loop (M2, M3, M6).

Spark ML's boosted trees are first-order, grow level by level to a fixed depth
and fit one model at a time. Here

* features are cut into at most 255 bins at quantiles, of the rows or of the
  start hessian (``bin_weight``: a row counts by its weight); a missing value has a bin of its own, and every
  split learns the side that it goes to;
* a node's histogram holds the sums of gradient, hessian and rows of each bin;
  of two siblings only the smaller one is counted, the other is the parent
  less it. Gradients are rounded to multiples of 2**-20 and summed as integers,
  so a fit does not depend on how the rows are dealt out;
* a tree grows level by level, or best first up to ``max_leaves``. Best-first
  growth asks for the children of all leaves that may still be split in one
  pass, and decides between them when their gains are known: the tree is the
  one that single steps would give, in as many passes as it is deep;
* rows and columns are sampled anew for each tree, by hashes;
* several fits (learners, folds) share each pass: the fit is one more key of
  the histogram. A fit with a held fold does not learn from it, yet every
  row's margin under every fit is kept, so out-of-fold scores come for free.

The binned rows are blocks of numpy arrays in a cached RDD, so a pass is one small
job: each task counts its blocks, and only sums per (fit, node, feature, bin)
leave the executors, however many rows there are. Features of few bins are kept
and counted several at once, as one feature whose bins are the combinations of
theirs; label, fold and weights are kept once for each combination that occurs,
so a row is some two bytes a feature pair and a margin a fit. Fits that cut the
features alike share their codes. The margins move on with each round of trees;
every ``REFRESH`` rounds the blocks are checkpointed in the shared folder, so no
lineage grows and a lost executor loses a few rounds of margins, no tree.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import partial
from math import log
from typing import NamedTuple, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, ensure_checkpoint_dir
from .prefix import ordered_cumsum

MAX_BINS = 255
#: Gradients and hessians are whole multiples of 1 / SCALE.
SCALE = 1 << 20
#: Rounds of margins after which the blocks are checkpointed anew.
REFRESH = 10
#: Rows for each task of a pass, at least; rows of a block, at most (by whole batches); rows for each task
#: from which on there are more tasks than cores.
PART_ROWS, BLOCK_ROWS, FULL_ROWS = 50_000, 1 << 16, 1 << 20
#: Bins, at most, of features that are counted as one.
GROUP_BINS = 1024
#: Tasks, at most, whose sums the driver adds up itself.
DRIVER_SUMS = 32

_GOLD, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class BoostParams:
    """``max_leaves`` 0: level by level; else best first. Sampling shares are per tree."""

    rounds: int = 200
    step: float = 0.05
    max_depth: int = 6
    max_leaves: int = 0
    row_share: float = 1.0
    column_share: float = 1.0
    l2: float = 1.0
    min_rows: int = 1
    min_hessian: float = 1.0
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """One model of a common training loop; ``held`` is a fold that it does not learn from."""

    name: str
    params: BoostParams
    weight: str
    held: int | None = None
    cut: str | None = None   # the weight column of the bins' quantiles (None: the loop's ``bin_weight``)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def _share(keys: np.ndarray, seed: int, tree: int, kind: int) -> np.ndarray:
    """A number in [0, 1) for each key, new for each tree."""
    with np.errstate(over="ignore"):
        salt = _mix(np.array([(seed * 1_000_003 + tree) * 4 + kind], np.uint64) * _GOLD)
        return (_mix(keys.astype(np.uint64) * _GOLD ^ salt) >> np.uint64(11)) / 2.0 ** 53


def sampled_rows(row_hash: np.ndarray, p: BoostParams, tree: int) -> np.ndarray:
    """Which rows a tree is grown on."""
    return np.ones(len(row_hash), bool) if p.row_share >= 1 else _share(row_hash, p.seed, tree, 0) < p.row_share


def sampled_columns(n: int, p: BoostParams, tree: int) -> np.ndarray:
    """Which features a tree may split on."""
    keep = max(1, int(p.column_share * n))
    order = np.argsort(_share(np.arange(n), p.seed, tree, 1), kind="stable")
    return np.isin(np.arange(n), order[:keep])


# --- binning ---------------------------------------------------------------------


def bin_edges(df: DataFrame, vec: str, n_features: int, weight: Column, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """The upper bounds of each feature's bins: every value its own if there are few,
    else quantiles of ``weight``. The sums run over range parts; only bounds come to the driver."""
    long = df.select(weight.cast("double").alias("h"), F.posexplode(vec).alias("f", "v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    values = long.groupBy("f", "v").agg(F.sum("h").alias("h"), F.lit(1).alias("one"))
    summed = ordered_cumsum(values, "v", ["h", "one"], by=["f"])
    totals = summed.groupBy("f").agg(F.max("cum_h").alias("total"), F.max("cum_one").alias("n"))
    at = F.when(F.col("n") <= max_bins, F.col("cum_one") - 1).otherwise(
        F.least(F.floor((F.col("cum_h") - F.col("h")) * max_bins / F.col("total")), F.lit(max_bins - 1)))
    rows = summed.join(totals, "f").groupBy("f", at.alias("bin")).agg(F.max("v").alias("edge")).toPandas()
    return [np.sort(rows.loc[rows["f"] == f, "edge"].to_numpy(np.float64)) for f in range(n_features)]


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers (rows, features): 0 for a missing value, else from 1."""
    out = np.zeros(x.shape, np.uint8)
    for f, e in enumerate(edges):
        if len(e):
            there = ~np.isnan(x[:, f])
            out[there, f] = 1 + np.minimum(np.searchsorted(e, x[there, f]), len(e) - 1)
    return out


# --- trees -----------------------------------------------------------------------


@dataclass
class Node:
    depth: int
    grad: int
    hess: int
    rows: int
    cells: np.ndarray | None = None      # (cells, 3): gradient, hessian, rows
    split: tuple | None = None           # gain, feature, bin, missing goes left, sums of the left side
    children: tuple[int, int] | None = None
    known: bool = False                  # the split (or that there is none) is decided


class Grower:
    """One tree of one fit, grown from histograms that come in pass by pass."""

    def __init__(self, params: BoostParams, tree: int, sizes: Sequence[int]):
        self.p, self.tree = params, tree
        self.first = np.concatenate(([0], np.cumsum([s + 1 for s in sizes])))   # a feature's cells: missing, then bins
        self.nodes: list[Node] = [Node(0, 0, 0, 0)]
        columns = sampled_columns(len(sizes), params, tree)
        feature = np.repeat(np.arange(len(sizes)), [s + 1 for s in sizes])
        self.feature, self.bin = feature, np.arange(len(feature)) - self.first[feature]
        self.able = columns[feature] & (self.bin > 0)
        self.asked: list[int] = [0]
        self.final: list[int] | None = None

    def receive(self, cells: dict[int, np.ndarray]) -> None:
        """Take the histograms asked for and ask for the next ones, or finish."""
        for at, x in cells.items():
            node = self.nodes[at]
            node.cells = x
            if at == 0:
                node.grad, node.hess, node.rows = (int(v) for v in x[:self.first[1]].sum(0))
        for node in self.nodes:   # the larger sibling by subtraction
            if node.children and node.cells is not None:
                a, b = (self.nodes[c] for c in node.children)
                for one, other in ((a, b), (b, a)):
                    if one.cells is None and not one.known and other.cells is not None:
                        one.cells = node.cells - other.cells
                node.cells = None
        self._decide([n for n in self.nodes if not n.known and n.cells is not None])
        self._advance()

    def _decide(self, nodes: list[Node]) -> None:
        """Give each node the split of the greatest gain; ties go to the first feature, then the lowest bin, missing to the right."""
        p, k = self.p, len(nodes)
        if not k:
            return
        lam, first = p.l2 * SCALE, self.first[:-1]
        x = np.stack([n.cells for n in nodes])
        run = np.cumsum(x, 1)
        missing = x[:, first]
        below = (run - (run[:, first] - missing)[:, self.feature])[:, self.able]   # of each bin, with the missing ones
        without = below - missing[:, self.feature[self.able]]
        g, h, c = np.concatenate((without, below), 1).transpose(2, 0, 1)
        grad, hess, rows = np.array([(n.grad, n.hess, n.rows) for n in nodes], np.int64).T[:, :, None]
        least, weight = max(1, p.min_rows), p.min_hessian * SCALE
        ok = (c >= least) & (rows - c >= least) & (h >= weight) & (hess - h >= weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            gl, hl = g.astype(float), h.astype(float)
            gr, hr = (grad - g).astype(float), (hess - h).astype(float)
            gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - grad.astype(float) * grad / (hess + lam)
        gain = np.where(ok, gain, -np.inf)
        best, cells = gain.argmax(1) if gain.shape[1] else np.zeros(k, np.int64), np.flatnonzero(self.able)
        for i, node in enumerate(nodes):
            node.known = True
            j = int(best[i])
            if len(cells) and gain[i, j] > 0:
                at = cells[j % len(cells)]
                node.split = (float(gain[i, j]), int(self.feature[at]), int(self.bin[at]), j >= len(cells),
                              (int(g[i, j]), int(h[i, j]), int(c[i, j])))

    def _advance(self) -> None:
        """Best-first growth over what is known; leaves whose children matter and are not known get asked for."""
        limit = self.p.max_leaves or 1 << 30
        heap = [(-self.nodes[0].split[0], 0)] if self.nodes[0].split else []
        done, unknown, leaves = [], [], 1
        while heap and leaves < limit:
            at = heapq.heappop(heap)[1]
            node = self.nodes[at]
            done.append(at)
            leaves += 1
            if node.children is None:
                unknown.append(at)
                continue
            for c in node.children:
                if self.nodes[c].split:
                    heapq.heappush(heap, (-self.nodes[c].split[0], c))
        self.asked = []
        for at in unknown:
            self._open(at)
        if not self.asked:
            if any(self.nodes[c].split for at in unknown for c in self.nodes[at].children):
                return self._advance()
            self.final = done

    def _open(self, at: int) -> None:
        node = self.nodes[at]
        g, h, c = node.split[4]
        one = Node(node.depth + 1, g, h, c)
        two = Node(node.depth + 1, node.grad - g, node.hess - h, node.rows - c)
        node.children = (len(self.nodes), len(self.nodes) + 1)
        self.nodes += [one, two]
        if node.depth + 1 >= self.p.max_depth:
            one.known = two.known = True
            node.cells = None
        else:
            self.asked.append(node.children[0 if one.rows <= two.rows else 1])

    def arrays(self) -> dict[str, np.ndarray]:
        """What a task needs to send rows down all splits made so far."""
        n = len(self.nodes)
        out = {"feature": np.full(n, -1, np.int32), "bin": np.zeros(n, np.int32), "miss": np.zeros(n, bool),
               "left": np.zeros(n, np.int32), "right": np.zeros(n, np.int32)}
        for i, node in enumerate(self.nodes):
            if node.children:
                _, out["feature"][i], out["bin"][i], out["miss"][i], _ = node.split
                out["left"][i], out["right"][i] = node.children
        return out

    def on_the_way(self) -> np.ndarray:
        """Which nodes are asked for or above one that is."""
        out = np.zeros(len(self.nodes), bool)
        out[self.asked] = True
        for i in range(len(self.nodes) - 1, -1, -1):   # children come after their parents
            if self.nodes[i].children:
                out[i] |= out[list(self.nodes[i].children)].any()
        return out

    def result(self) -> pd.DataFrame:
        """The finished tree, one row per node, numbered from the root in the order of its splits."""
        final, rows, number = set(self.final), [], {0: 0}
        for at in self.final:
            for c in self.nodes[at].children:
                number[c] = len(number)
        for at, i in number.items():
            node, inner = self.nodes[at], at in final
            gain, feature, cut, miss, _ = node.split if inner else (0.0, -1, 0, False, None)
            left, right = (number[c] for c in node.children) if inner else (-1, -1)
            value = -self.p.step * node.grad / (node.hess + self.p.l2 * SCALE) if node.hess + self.p.l2 * SCALE > 0 else 0.0
            rows.append((self.tree, i, node.depth, feature, cut, miss, left, right, value, gain / SCALE, node.hess / SCALE, node.rows))
        return pd.DataFrame(rows, columns=["tree", "node", "depth", "feature", "bin", "missing_left", "left", "right",
                                           "value", "gain", "cover", "rows"])


class Codes(NamedTuple):
    """How the bins of the features are kept: groups of features, each with one code per row."""

    widths: list                 # bins of each feature, with that of missing values
    groups: list                 # features of each group

    def sizes(self) -> list[int]:
        return [int(np.prod([self.widths[f] for f in g])) for g in self.groups]

    def places(self) -> dict[int, tuple[int, np.ndarray]]:
        """Of each feature its group and the bin that each code of the group stands for."""
        out = {}
        for i, (group, size) in enumerate(zip(self.groups, self.sizes())):
            step = size
            for f in group:
                step //= self.widths[f]
                out[f] = i, (np.arange(size) // step % self.widths[f]).astype(np.uint8)
        return out


def _goes_left(bins: np.ndarray, cut: int, missing_left: bool) -> np.ndarray:
    """Whether each bin is on the left of a split; bin 0 holds the missing values."""
    return bins <= cut if missing_left else (bins > 0) & (bins <= cut)


def descend(t: dict[str, np.ndarray], places: dict, codes: Sequence[np.ndarray], rows: np.ndarray,
            need: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The rows by the node that they end in, of blocks of codes; with ``need`` only those nodes are entered."""
    todo = [(0, rows)]
    while todo:
        node, rows = todo.pop()
        f = t["feature"][node]
        if f < 0:
            yield node, rows
            continue
        group, bins = places[f]
        left = _goes_left(bins, t["bin"][node], t["miss"][node]).take(codes[group].take(rows))
        for child, side in ((t["left"][node], left), (t["right"][node], ~left)):
            if need is None or need[child]:
                todo.append((child, rows[side]))


#: Multiplied with a power of two, its upper six bits tell which one.
_DE_BRUIJN = 0x03F79D71B4CB0A89


class LeafMasks:
    """A tree of up to 64 leaves as bits: each code of a group of features rules out the leaves that lie to the left
    of a split that it passes on the right, and of those that no group rules out the leftmost one is the row's."""

    def __init__(self, t: dict[str, np.ndarray], places: dict):
        self.values, last, todo, first = np.zeros(64), 0, [(0, False)], {}
        masks: dict[int, np.ndarray] = {}
        while todo:
            node, seen = todo.pop()
            f = int(t["feature"][node])
            if f < 0:
                self.values[((1 << last) * _DE_BRUIJN >> 58) & 63] = t["value"][node]
                last += 1
            elif not seen:   # its left side, then itself, then its right side
                first[node] = last
                todo += [(t["right"][node], False), (node, True), (t["left"][node], False)]
            else:
                group, bins = places[f]
                keep = np.uint64(~((1 << last) - (1 << first[node])) & (1 << 64) - 1)
                right = ~_goes_left(bins, t["bin"][node], t["miss"][node])
                masks.setdefault(group, np.full(len(bins), np.uint64((1 << 64) - 1)))[right] &= keep
        self.masks = list(masks.items())

    @staticmethod
    def fit(t: dict[str, np.ndarray]) -> bool:
        return (t["feature"] < 0).sum() <= 64

    def __call__(self, codes: Sequence[np.ndarray], n: int) -> np.ndarray:
        """The value of the leaf of each row."""
        left = np.full(n, np.uint64((1 << 64) - 1))
        for group, mask in self.masks:
            left &= mask.take(codes[group])
        left &= ~left + np.uint64(1)
        return self.values.take((left * np.uint64(_DE_BRUIJN) >> np.uint64(58)).astype(np.intp))


def leaf_values(t: dict[str, np.ndarray], places: dict, codes: Sequence[np.ndarray], n: int) -> np.ndarray:
    """The value of the leaf of each row, of a tree of any size."""
    if LeafMasks.fit(t):
        return LeafMasks(t, places)(codes, n)
    out = np.zeros(n)
    for node, at in descend(t, places, codes, np.arange(n)):
        out[at] = t["value"][node]
    return out


# --- the training loop ---------------------------------------------------------------


class Block(NamedTuple):
    """Some rows of a training table, column by column."""

    key: np.ndarray | None      # None: the loop has no keys
    no_key: np.ndarray | None   # None: every row has one
    row: np.ndarray | None      # unsigned, names the row for the sampling (None: no fit samples)
    kind: np.ndarray            # of label, fold and weights: which of ``kinds``
    kinds: np.ndarray           # (2 + weight columns, kinds)
    codes: list                 # of each cut: of each group of features
    margin: np.ndarray          # (fits, rows)


def feature_groups(widths: Sequence[int], most: int | None = None) -> list[list[int]]:
    """Features that are counted as one: narrow ones, whose bins have no more than ``most`` (``GROUP_BINS``) combinations."""
    groups: list[list[int]] = []
    most = most or GROUP_BINS
    size = most + 1
    for f in sorted(range(len(widths)), key=lambda f: widths[f]):
        if size * widths[f] > most:
            groups.append([])
            size = 1
        groups[-1].append(f)
        size *= widths[f]
    return groups


def group_codes(bins: np.ndarray, codes: Codes) -> list[np.ndarray]:
    """The combination of bins (features, rows) of each group of features."""
    out = []
    for group, size in zip(codes.groups, codes.sizes()):
        code = np.zeros(bins.shape[1], np.uint32)
        for f in group:
            code = code * np.uint32(codes.widths[f]) + bins[f]
        out.append(code.astype(np.min_scalar_type(size - 1)))
    return out


@dataclass
class Training:
    """Fitted models by fit name and the blocks of rows with their margins under every fit."""

    models: dict
    blocks: RDD = field(repr=False)
    fits: list

    def margins(self) -> DataFrame:
        """key, label, fold and one margin column per fit."""
        names = [f.name for f in self.fits]

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for raw in batch.column(0):
                    b = Block(*pickle.loads(raw.as_py()))
                    key = pa.nulls(len(b.kind), pa.int64()) if b.key is None else pa.array(b.key, pa.int64(), mask=b.no_key)
                    yield pa.RecordBatch.from_arrays(
                        [key, pa.array(b.kinds[0][b.kind], pa.float64(), from_pandas=True),
                         pa.array(b.kinds[1][b.kind], pa.int32(), from_pandas=True), *[pa.array(m) for m in b.margin]],
                        ["key", "label", "fold", *names])

        packed = self.blocks.map(lambda b: (pickle.dumps(tuple(b)),))
        return SparkSession.active().createDataFrame(packed, "block binary").mapInArrow(
            rows, "key bigint, label double, fold int, " + ", ".join(f"`{n}` double" for n in names))


class Booster:
    """The state of a training loop: fits, their trees and the binned rows."""

    def __init__(self, df: DataFrame, vec: str, features: Sequence[str], label: str, fits: Sequence[Fit],
                 row_key: Column | None = None, fold: str | None = None, key: str | None = None,
                 bin_weight: Column | None = None, max_bins: int = MAX_BINS):
        self.spark, self.features, self.fits = df.sparkSession, list(features), list(fits)
        self.weights = sorted({f.weight for f in fits})
        self.cuts = sorted({f.cut for f in fits}, key=str)
        self.cut = [self.cuts.index(f.cut) for f in self.fits]
        x = F.col(vec)
        base = df.select(F.transform(x, lambda v: v.cast("double")).alias("x"), F.col(label).cast("double").alias("label"),
                         (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"),
                         (row_key if row_key is not None else F.xxhash64(x, label)).cast("long").alias("row"),
                         (F.col(key) if key else F.lit(None)).cast("long").alias("key"),
                         (bin_weight if bin_weight is not None else F.lit(1)).alias("bw"),
                         *[F.col(c).cast("double").alias(f"cut{i}") for i, c in enumerate(self.cuts) if c],
                         *[F.col(w).cast("double").alias(f"w{i}") for i, w in enumerate(self.weights)])
        sums = base.groupBy("fold").agg(F.count("*").alias("n"), *[a for i in range(len(self.weights)) for a in (
            F.sum(f"w{i}").alias(f"s{i}"), F.sum(F.col(f"w{i}") * F.col("label")).alias(f"p{i}"))]).collect()
        self.starts = []
        for f in self.fits:
            i = self.weights.index(f.weight)
            mine = [r for r in sums if f.held is None or r["fold"] != f.held]
            total, pos = sum(r[f"s{i}"] for r in mine), sum(r[f"p{i}"] for r in mine)
            self.starts.append(log(pos / (total - pos)) if 0 < pos < total else 0.0)
        # all rows start at one probability, so the start hessian of a row goes by its weight
        self.edges = [bin_edges(base, "x", len(self.features), F.col(f"cut{i}" if c else "bw"), max_bins)
                      for i, c in enumerate(self.cuts)]
        self.sizes = [[len(e) for e in edges] for edges in self.edges]
        widths = [[s + 1 for s in sizes] for sizes in self.sizes]
        self.codes = [Codes(w, feature_groups(w, 4 * GROUP_BINS)) for w in widths]
        self.keyed, self.sampled = key is not None, any(f.params.row_share < 1 for f in self.fits)
        n = sum(r["n"] for r in sums)
        # few rows need few tasks; many a task for each core, or more
        self.parts = max(1, min(-(-n // PART_ROWS), max(self.spark.sparkContext.defaultParallelism, -(-n // FULL_ROWS))))
        self.blocks = self._blocks(base.drop("bw", *[f"cut{i}" for i in range(len(self.cuts))]))
        self.rounds, self.stale, self.saved = 0, [], None
        self.trees: list[list[pd.DataFrame]] = [[] for _ in self.fits]
        self.pending: list[list[dict]] = [[] for _ in self.fits]

    def _blocks(self, base: DataFrame) -> RDD:
        """The rows, binned and dealt out evenly, as blocks."""
        edges, starts, codes, keyed, sampled = self.edges, np.array(self.starts), self.codes, self.keyed, self.sampled
        n_weights = len(self.weights)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= BLOCK_ROWS:
                    yield block(held)
                    held, n = [], 0
            if n:
                yield block(held)

        def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(batches).combine_chunks()
            col = {c: t[c].to_numpy() for c in t.column_names if c not in ("x", "key")}
            x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in t["x"].chunks])
            x = x.reshape(t.num_rows, len(edges[0]))
            kinds = np.stack([col["label"], col["fold"].astype(float), *[col[f"w{i}"] for i in range(n_weights)]], 1)
            _, at, kind = np.unique(kinds.view(f"V{8 * kinds.shape[1]}").ravel(), return_index=True, return_inverse=True)
            no_key = t["key"].is_null().to_numpy()
            out = Block(t["key"].fill_null(0).to_numpy() if keyed else None, no_key if keyed and no_key.any() else None,
                        col["row"].view(np.uint64) if sampled else None, kind.astype(np.min_scalar_type(len(at))), kinds[at].T.copy(),
                        [group_codes(binned(x, e).T, c) for e, c in zip(edges, codes)], np.repeat(starts[:, None], t.num_rows, 1))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(out))], pa.binary())], ["block"])

        ensure_checkpoint_dir(self.spark)
        blocks = base.repartition(self.parts).mapInArrow(pack, "block binary").rdd.map(lambda r: Block(*pickle.loads(r[0])))
        blocks.persist(StorageLevel.MEMORY_AND_DISK).checkpoint()
        return blocks

    def _refresh(self) -> None:
        """Move the margins on by all finished trees; the next pass makes the new blocks on its way."""
        pending, codes, cut = self.pending, self.codes, self.cut

        def run(blocks: Iterator[Block]) -> Iterator[Block]:
            places = [c.places() for c in codes]
            trees = [[LeafMasks(t, places[cut[m]]) if LeafMasks.fit(t) else partial(leaf_values, t, places[cut[m]]) for t in new]
                     for m, new in enumerate(pending)]
            for b in blocks:
                margin = b.margin.copy()
                for m, new in enumerate(trees):
                    for tree in new:
                        margin[m] += tree(b.codes[cut[m]], len(b.kind))
                yield b._replace(margin=margin)

        self.stale.append(self.blocks)
        self.blocks = self.blocks.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)
        self.rounds += 1
        if self.rounds % REFRESH == 0:
            self.blocks.checkpoint()
        self.pending = [[] for _ in self.fits]

    def _forget(self) -> None:
        """Drop the blocks that newer ones replace, and checkpoints before the last."""
        for old in self.stale:
            old.unpersist()
        self.stale = []
        saved = self.blocks.getCheckpointFile()
        if saved:
            if self.saved and self.saved != saved:
                drop_path(self.spark, self.saved)
            self.saved = saved

    def _pass(self, growers: list) -> dict[tuple[int, int], np.ndarray]:
        """The histograms that the growers ask for: (fit, node) -> (cells, 3)."""
        # of each fit: its slots' histograms in one array, and where that begins among those of all fits
        work, spans, end = [], {}, 0
        for m, g in enumerate(growers):
            if g and g.asked:
                shape = 3, len(g.asked), sum(s + 1 for s in self.sizes[self.cut[m]])
                spans[m] = end, shape
                work.append((m, g.arrays(), g.on_the_way(), {at: s for s, at in enumerate(g.asked)}, g.tree, self.fits[m],
                             self.weights.index(self.fits[m].weight) + 2, self.cut[m], end, shape))
                end += shape[0] * shape[1] * shape[2]
        pending, codes, cut = self.pending, self.codes, self.cut

        def run(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
            total = np.zeros(end, np.int64)
            places = [c.places() for c in codes]
            for b in blocks:
                for m, tree, need, slot, number, fit, w, c, begin, shape in work:
                    into = total[begin:begin + shape[0] * shape[1] * shape[2]].reshape(shape)
                    _count(into, b, fit, number, tree, need, slot, w, codes[c], places[c], b.codes[c],
                           _margin(b, m, pending, places[c], b.codes[c]))
            yield total

        got = self.blocks.mapPartitions(run)
        total = got.treeReduce(np.add) if self.parts > DRIVER_SUMS else sum(got.collect())
        self._forget()
        found = {m: total[at:at + shape[0] * shape[1] * shape[2]].reshape(shape) for m, (at, shape) in spans.items()}
        return {(m, at): found[m][:, i].T for m in found for i, at in enumerate(growers[m].asked)}

    def train(self) -> "Training":
        growers: list = [Grower(f.params, 0, self.sizes[self.cut[m]]) if f.params.rounds else None for m, f in enumerate(self.fits)]
        while any(growers):
            found = self._pass(growers)
            for m, g in enumerate(growers):
                if g is None:
                    continue
                g.receive({at: found[m, at] for at in g.asked})
                if g.final is not None:
                    tree = g.result()
                    self.trees[m].append(tree)
                    self.pending[m].append(_routes(tree))
                    more = g.tree + 1 < self.fits[m].params.rounds
                    growers[m] = Grower(g.p, g.tree + 1, self.sizes[self.cut[m]]) if more else None
            # once for each round of all fits, also if some are ahead
            if sum(map(len, self.pending)) >= sum(g is not None for g in growers):
                self._refresh()
        if any(self.pending):
            self._refresh()
        for made in (*self.stale, self.blocks):   # the margins can be made from the last checkpoint
            made.unpersist()
        models = {f.name: BoostedTrees.of(self.trees[m], self.starts[m], self.edges[self.cut[m]], self.features,
                                          "splits" if f.params.max_leaves else "gain") for m, f in enumerate(self.fits)}
        return Training(models, self.blocks, self.fits)


def _routes(tree: pd.DataFrame) -> dict[str, np.ndarray]:
    return {"feature": tree["feature"].to_numpy(np.int32), "bin": tree["bin"].to_numpy(np.int32),
            "miss": tree["missing_left"].to_numpy(bool), "left": tree["left"].to_numpy(np.int32),
            "right": tree["right"].to_numpy(np.int32), "value": tree["value"].to_numpy(np.float64)}


def _margin(b: Block, m: int, pending: list, places: dict, codes: Sequence[np.ndarray]) -> np.ndarray:
    """The margins of a block's rows under a fit, with its trees that are not in the block yet."""
    margin = b.margin[m]
    for t in pending[m]:
        margin = margin + leaf_values(t, places, codes, len(margin))
    return margin


def _count(into: np.ndarray, b: Block, fit: Fit, number: int, tree: dict, need: np.ndarray, slot: dict, w: int,
           kept: Codes, places: dict, codes: Sequence[np.ndarray], margin: np.ndarray) -> None:
    """Add the histograms of a block's rows to ``into`` (gradient, hessian and rows; slots; cells)."""
    use = np.ones(len(b.kind), bool) if b.row is None else sampled_rows(b.row, fit.params, number)
    if fit.held is not None:
        use &= (b.kinds[1] != fit.held)[b.kind]
    ends = [(slot[at], rows) for at, rows in descend(tree, places, codes, np.flatnonzero(use), need) if at in slot]
    rows = np.concatenate([r for _, r in ends])
    place = np.repeat(np.arange(len(ends)), [len(r) for _, r in ends])
    at = [s for s, _ in ends]
    kind = b.kind[rows]
    p, weight = 1 / (1 + np.exp(-margin[rows])), b.kinds[w][kind]
    grad, hess = np.rint((p - b.kinds[0][kind]) * weight * SCALE), np.rint(p * (1 - p) * weight * SCALE)
    # hessians and rows in one sum, if both are exact in it
    one = float(1 << 36) if len(rows) < 1 << 17 and hess.min(initial=0) >= 0 and hess.sum() < 1 << 36 else 0.0
    if one:
        hess += one
    first = np.concatenate(([0], np.cumsum(kept.widths)))
    for group, size, code in zip(kept.groups, kept.sizes(), codes):
        dims = [kept.widths[f] for f in group]
        cell = place * size + code.take(rows)
        g, h = (np.bincount(cell, x, len(ends) * size) for x in (grad, hess))
        if one:
            c = np.floor(h / one)
            h -= c * one
        else:
            c = np.bincount(cell, None, len(ends) * size)
        for k, x in enumerate((g, h, c)):
            found = x.astype(np.int64).reshape(len(ends), *dims)
            for i, f in enumerate(group):
                others = tuple(j + 1 for j in range(len(group)) if j != i)
                into[k, at, first[f]:first[f + 1]] += found.sum(others)


NODE_SCHEMA = ("tree int, node int, depth int, feature int, name string, threshold double, missing_left boolean, "
               "left int, right int, value double, gain double, cover double, rows bigint")

_HEAD = "start double, features array<string>, kind string"


@dataclass
class BoostedTrees:
    """A fitted model: a start margin and a table of nodes (bounded by rounds x nodes of a tree)."""

    start: float
    features: list
    nodes: pd.DataFrame = field(repr=False)
    kind: str = "gain"   # of its importances: gain or splits

    @classmethod
    def of(cls, trees: list[pd.DataFrame], start: float, edges: Sequence[np.ndarray], features: Sequence[str],
           kind: str = "gain") -> "BoostedTrees":
        empty = pd.DataFrame({c.split()[0]: [] for c in NODE_SCHEMA.split(", ")} | {"bin": []})
        nodes = pd.concat(trees, ignore_index=True) if trees else empty
        inner = nodes["feature"] >= 0
        nodes["name"] = [features[f] if f >= 0 else None for f in nodes["feature"]]
        nodes["threshold"] = [edges[f][b - 1] if i else np.nan for f, b, i in zip(nodes["feature"], nodes["bin"], inner)]
        return cls(start, list(features), nodes.drop(columns="bin")[[c.split()[0] for c in NODE_SCHEMA.split(", ")]], kind)

    def node_table(self, spark: SparkSession) -> DataFrame:
        """Every node of every tree as rows."""
        pdf = self.nodes.astype({"threshold": object}).where(self.nodes["feature"] >= 0, self.nodes.assign(threshold=None, name=None))
        return spark.createDataFrame(list(pdf.itertuples(index=False, name=None)), NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.start, self.features, self.kind)], _HEAD).coalesce(1) \
            .write.mode("overwrite").json(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        head = spark.read.schema(_HEAD).json(f"{path}/model").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"], ignore_index=True)
        return cls(head["start"], list(head["features"]), nodes, head["kind"])

    def _bits(self) -> tuple[list[np.ndarray], list]:
        """The thresholds of each feature, and the trees over the ranks of its values among them; made once in a process."""
        if not hasattr(self, "_made"):
            nodes = self.nodes
            feature, threshold = nodes["feature"].to_numpy(np.int64), nodes["threshold"].to_numpy(float)
            edges = [np.unique(threshold[feature == f]) for f in range(len(self.features))]
            codes = Codes([len(e) + 2 for e in edges], [[f] for f in range(len(edges))])
            places = {f: (f, np.arange(w)) for f, w in enumerate(codes.widths)}
            trees = []
            for _, t in nodes.groupby("tree", sort=True):
                routes = {"feature": t["feature"].to_numpy(np.int64), "miss": t["missing_left"].to_numpy(bool),
                          "left": t["left"].to_numpy(np.int64), "right": t["right"].to_numpy(np.int64), "value": t["value"].to_numpy(float)}
                routes["bin"] = np.array([np.searchsorted(edges[f], v) + 1 if f >= 0 else 0
                                          for f, v in zip(routes["feature"], t["threshold"].to_numpy(float))], np.int64)
                trees.append(LeafMasks(routes, places) if LeafMasks.fit(routes) else partial(leaf_values, routes, places))
            self._made = edges, trees
        return self._made

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The margins of rows (rows, features); NaN is missing."""
        edges, trees = self._bits()
        out = np.full(len(x), self.start)
        codes = [np.where(np.isnan(v), 0, np.searchsorted(e, v) + 1) for v, e in zip(x.T, edges)]
        for tree in trees:
            out += tree(codes, len(x))
        return out

    def score(self, df: DataFrame, vec: Column, out: str) -> DataFrame:
        """Add the class-1 probability of the feature array ``vec``."""
        shared, width = df.sparkSession.sparkContext.broadcast(self), len(self.features)

        @F.arrow_udf("double")
        def probability(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            return pa.array(1 / (1 + np.exp(-shared.value.margin(x))))

        return df.withColumn(out, probability(vec))


def fit_together(df: DataFrame, vec: str, features: Sequence[str], label: str, fits: Sequence[Fit],
                 row_key: Column | None = None, fold: str | None = None, key: str | None = None,
                 bin_weight: Column | None = None, max_bins: int = MAX_BINS) -> Training:
    """Train all ``fits`` on the feature arrays ``vec`` of ``df`` in one loop.

    ``row_key`` names a row for the sampling (default: a hash of its values), ``key`` is a column that the
    margins carry, ``bin_weight`` the weight of a row in the quantiles of the bins (default: 1)."""
    return Booster(df, vec, features, label, fits, row_key, fold, key, bin_weight, max_bins).train()


def importances(nodes: DataFrame, kind: str = "gain") -> DataFrame:
    """feature, importance from a node table: the share of the mean gain of a feature's splits, or their number."""
    inner = nodes.filter("feature >= 0")
    if kind == "splits":
        return inner.groupBy(F.col("name").alias("feature")).agg(F.count("*").cast("double").alias("importance"))
    mean = inner.groupBy(F.col("name").alias("feature")).agg(F.avg("gain").alias("g"))
    total = mean.agg(F.sum("g")).scalar()
    return mean.select("feature", (F.col("g") / total).alias("importance"))


def with_rounds(p: BoostParams, overrides: dict | None) -> BoostParams:
    """``p`` with fewer rounds or another depth (tests)."""
    o = overrides or {}
    return replace(p, rounds=o.get("maxIter", p.rounds), max_depth=o.get("maxDepth", p.max_depth))

"""Benchmark decontamination with a BM25 index of the test items and block-max WAND.

Test items are cut into units of at most ``UNIT_WORDS`` words; an inverted
index holds the BM25 weight of each word in each unit, divided by the score
of the unit against itself, so a score is the share of the unit that is
covered and one threshold serves all. Posting lists are in blocks with their
largest weight.

Every passage (overlapping windows of words, so that each unit fits whole
into one) of every document is a query. Passages that cannot reach the
threshold by an upper bound are passed over: in each unit the commonest
words, worth less than the threshold together, are inessential, and the
essential words of a passage plus all inessential ones must reach it. The
others are searched with block-max WAND, and everything above the threshold
is retrieved. A hit is verified on the words themselves: enough of the word
n-grams of the question and of the answer (the item's last sentence) occur
around the passage, in the whole item or in the unit that was retrieved. In a
part of fewer than ``SHORT`` words one changed word can take most n-grams
away: such an answer is judged by its words, and where either part is short it
is enough that the n-grams of both together occur.

The items are few against the corpus, but no bound is assumed: Spark deals
them by a hash into shards of about ``SHARD_WORDS`` words and counts the units,
their mean length and the units of each word over all items, so a score is the
same at any number of shards. The shards are searched one after the other: one
is indexed and broadcast at a time, and its hits are written before the next.
Documents are independent and never shuffled.

Tolerance: verbatim copies are found whatever surrounds them. With words
changed at random the share of copies found falls fast, as each takes GRAM
n-grams and both parts must hold: of 300 items of 30 to 60 words with answers
of 10 to 15 (``test_tolerance_for_changed_words``) 89 % are found with 5 % of
the words changed, 66 % with 10 %, 13 % with 20 %, 1 % with 30 %.

Defined cases: null or empty texts and items without words match nothing; an
item of a single word or sentence has its last quarter as answer; repeated
items or rows give repeated results; no items: no hits; other columns are
ignored. Long texts are worked window by window, whole.
"""

from __future__ import annotations

import re
from collections import Counter
from math import fsum, log
from typing import Iterator, NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import drop_stored, prepare, stored

UNIT_WORDS = 64
THRESHOLD = 0.6
#: Weight of a unit that its commonest words may hold as inessential; below the threshold.
INESSENTIAL = 0.35
BLOCK = 8
GRAM = 3
OVERLAP = 0.6
#: From so many words on, one changed word leaves a share of OVERLAP of the n-grams.
SHORT = 10
SHARD_WORDS = 2_000_000
K1, B = 1.2, 0.75

MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
TO_SPACE = bytes.maketrans(MARKS, b" " * len(MARKS))
SENTENCE = re.compile(r"[.?!。？！]+(?=\s|$)|\n")
HIT = "array<struct<item_id: bigint, score: double, question: double, answer: double, word: bigint>>"


def words_of(text: str) -> list[bytes]:
    """Lower-cased words: runs of letters, digits and characters beyond ASCII."""
    return text.lower().encode("utf-8", "replace").translate(TO_SPACE).split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The item's words before its last sentence, and those of it (or the last quarter, if it is the only one)."""
    parts = [p for p in (words_of(x) for x in SENTENCE.split(text)) if p]
    if not parts:
        return [], []
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0]
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def grams(words: list[bytes]) -> set[tuple]:
    n = min(GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def held(part: list[bytes], near: list[bytes]) -> float:
    """The share of a part's n-grams that occur in ``near``."""
    want, n = grams(part), min(GRAM, len(part))
    have = {tuple(near[i:i + n]) for i in range(len(near) - n + 1)}
    return len(want & have) / len(want) if want else 1.0


def verified(question: list[bytes], answer: list[bytes], near: list[bytes], overlap: float) -> tuple[float, float] | None:
    """The shares of question and answer in ``near``, if they are enough."""
    q, a = held(question, near), held(answer, near)
    if answer and len(answer) < SHORT:
        a = len(set(answer) & set(near)) / len(set(answer))
    if min(q, a) >= overlap:
        return q, a
    short = min(len(question), len(answer)) < SHORT
    return (q, a) if short and held(question + answer, near) >= overlap else None


def unit_spans(n_words: int) -> list[tuple[int, int]]:
    """The units of an item of so many words: spans of about the same length."""
    n = -(-n_words // UNIT_WORDS)
    return [(u * n_words // n, (u + 1) * n_words // n) for u in range(n)]


class UnitStats(NamedTuple):
    """Counts over the units of all items, whatever shard they are in."""

    units: int
    mean: float
    df: dict[bytes, int]


class BlockMaxIndex:
    """BM25 weights of words in units, as shares of each unit's own score.

    ``stats`` are the counts over all items, of which these are a shard (default: these are all)."""

    def __init__(self, items: list[tuple[int, str]], stats: UnitStats | None = None):
        self.items = [(i, *question_answer(t or "")) for i, t in items]
        units: list[tuple[int, list[bytes]]] = []
        self.spans: list[tuple[int, int]] = []   # of the units in their items' words
        for k, (_, q, a) in enumerate(self.items):
            words = q + a
            for span in unit_spans(len(words)):
                self.spans.append(span)
                units.append((k, words[slice(*span)]))
        self.unit_item = [k for k, _ in units]
        tfs = [Counter(w) for _, w in units]
        if stats is None:
            stats = UnitStats(len(units), sum(len(w) for _, w in units) / max(1, len(units)), Counter(w for tf in tfs for w in tf))
        all_units, mean, df = stats
        self.term = {w: i for i, w in enumerate(sorted({w for tf in tfs for w in tf}))}
        lists: list[list[tuple[int, float]]] = [[] for _ in self.term]
        self.weights: list[dict[int, float]] = []
        for u, tf in enumerate(tfs):
            norm = K1 * (1 - B + B * len(units[u][1]) / mean)
            raw = {self.term[w]: log(1 + (all_units - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in tf.items()}
            own = sum(raw.values())
            self.weights.append({t: v / own for t, v in raw.items()})
            for t, v in self.weights[-1].items():
                lists[t].append((u, v))
        self.postings = [([u for u, _ in p], [v for _, v in p]) for p in lists]
        self.block_max = [[max(v[i:i + BLOCK]) for i in range(0, len(v), BLOCK)] for _, v in self.postings]
        self.list_max = [max(v) for _, v in self.postings]
        self._essential()

    def _essential(self) -> None:
        """Essential postings as flat arrays, and per unit what its inessential words can add."""
        rows: list[list[tuple[int, float]]] = [[] for _ in self.term]
        self.rest = np.zeros(len(self.weights))
        for u, own in enumerate(self.weights):
            for t, v in sorted(own.items(), key=lambda x: (-len(self.postings[x[0]][0]), x[0])):
                if self.rest[u] + v < INESSENTIAL:
                    self.rest[u] += v
                else:
                    rows[t].append((u, v))
        self.first = np.cumsum([0] + [len(r) for r in rows])
        self.unit = np.array([u for r in rows for u, _ in r], np.int64)
        self.value = np.array([v for r in rows for _, v in r], float)

    def search(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """(unit, score) of every unit that the distinct ``terms`` cover to at least the threshold."""
        least = threshold - 1e-9
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]   # unit, position, term
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += self.list_max[t]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # bound by the blocks that can hold the target
            shallow, skip = 0.0, None
            for _, pos, t in cursors[:pivot + 1]:
                units = self.postings[t][0]
                b = pos // BLOCK
                while (b + 1) * BLOCK <= len(units) and units[min((b + 1) * BLOCK, len(units)) - 1] < target:
                    b += 1
                if b * BLOCK < len(units):
                    shallow += self.block_max[t][b]
                    end = units[min((b + 1) * BLOCK, len(units)) - 1] + 1
                    skip = end if skip is None else min(skip, end)
            if shallow >= least:
                if cursors[0][0] == target:
                    score = fsum(self.postings[t][1][pos] for u, pos, t in cursors[:pivot + 1] if u == target)
                    if score >= least:
                        found.append((target, score))
                    goal = target + 1
                else:
                    goal = target
            else:   # no unit before the end of these blocks, or before the next list, can do it
                goal = max(target + 1, skip or 0)
                if pivot + 1 < len(cursors):
                    goal = max(target + 1, min(goal, cursors[pivot + 1][0]))
            moved = []
            for k, (u, pos, t) in enumerate(cursors):
                if k <= pivot and u < goal:
                    units = self.postings[t][0]
                    while pos < len(units) and units[pos] < goal:
                        pos += 1
                    if pos == len(units):
                        continue
                    u = units[pos]
                moved.append([u, pos, t])
            cursors = moved
        return found

    def _passages(self, at: np.ndarray, term: np.ndarray, threshold: float) -> np.ndarray:
        """Numbers of the passages that the upper bound lets reach the threshold."""
        n = self.first[term + 1] - self.first[term]
        hit = n > 0
        if not hit.any():
            return np.zeros(0, np.int64)
        at, term, n = at[hit], term[hit], n[hit]
        index = np.repeat(self.first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        unit, value, step = self.unit[index], self.value[index], np.repeat(at // UNIT_WORDS, n)
        # passage p covers steps p and p + 1; a word repeated within one counts again, which keeps the bound
        where = np.concatenate((step, step - 1))
        keys = where * len(self.rest) + np.tile(unit, 2)
        keys, back = np.unique(keys, return_inverse=True)
        sums = np.bincount(back, weights=np.tile(value, 2))
        return np.unique(keys[sums + self.rest[keys % len(self.rest)] >= threshold - 1e-9] // len(self.rest))

    def hits(self, text: str | None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple]:
        """(item_id, score, question and answer overlap, first word) of the items found in a text."""
        if not text or not self.weights:
            return []
        words = words_of(text)
        get = self.term.get
        terms = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        at = np.flatnonzero(terms >= 0)
        best: dict[int, tuple] = {}
        for p in self._passages(at, terms[at], threshold).tolist():
            low, high = max(0, p) * UNIT_WORDS, (p + 2) * UNIT_WORDS
            inside = np.unique(terms[low:high])
            for unit, score in self.search(inside[inside >= 0].tolist(), threshold):
                item = self.unit_item[unit]
                if item in best and best[item][1] >= score:
                    continue
                _, q, a = self.items[item]
                for first, last in dict.fromkeys([(0, len(q) + len(a)), self.spans[unit]]):
                    one, two = q[first:last], a[max(0, first - len(q)):max(0, last - len(q))]
                    reach = len(one) + len(two)
                    shares = verified(one, two, words[max(0, low - reach):high + reach], overlap)
                    if shares:
                        best[item] = (self.items[item][0], min(1.0, score), *shares, low)
                        break
        return sorted(best.values(), key=lambda h: h[0])


def units_of(texts: pd.Series) -> pd.Series:
    """The units of each item: their numbers of words and their distinct words."""
    out = []
    for text in texts:
        question, answer = question_answer(text or "")
        words = question + answer
        out.append([{"n": b - a, "words": sorted({w.decode() for w in words[a:b]})} for a, b in unit_spans(len(words))])
    return pd.Series(out)


UNITS = "array<struct<n: int, words: array<string>>>"


def item_shards(items: DataFrame, shard_words: int = SHARD_WORDS) -> Iterator[tuple[BlockMaxIndex, bool]]:
    """The test items (item_id, text) in indexes of about ``shard_words`` words, one at a time, and whether it is the last.

    What is counted over all items is counted by Spark; the driver holds one
    shard: its items and the counts of the words in them."""
    prepare(items.sparkSession)
    known = items.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    units = known.select("item_id", "text", F.explode(F.pandas_udf(units_of, UNITS)("text")).alias("u"))
    size = units.agg(F.count(F.lit(1)).alias("units"), F.coalesce(F.sum("u.n"), F.lit(0)).alias("words")).first()
    n = max(1, -(-size["words"] // shard_words))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).alias("shard")
    # every word with its number of units over all items, once for each shard that holds it
    at = units.select(shard, F.explode("u.words").alias("word")).groupBy("word", "shard").agg(F.count(F.lit(1)).alias("k"))
    df = stored(at.groupBy("word").agg(F.sum("k").alias("df"), F.collect_list("shard").alias("shards")), "item-words")
    for i in range(n):
        part = sorted((r["item_id"], r["text"]) for r in known.filter(shard == i).collect())
        held_words = df.filter(F.array_contains("shards", F.lit(i).cast("long"))).select("word", "df")
        stats = UnitStats(size["units"], size["words"] / max(1, size["units"]), {r["word"].encode(): r["df"] for r in held_words.collect()})
        yield BlockMaxIndex(part, stats), i == n - 1
    drop_stored(df)


def _finder(index: Broadcast, threshold: float):
    """The vectorized function that finds the items of one broadcast index."""

    @F.pandas_udf(HIT)
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("item_id", "score", "question", "answer", "word"), h))
                           for h in index.value.hits(t, threshold)] for t in texts])

    return find


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, score, question, answer, word."""
    out = None
    for index, last in item_shards(items, shard_words):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        found = docs.select("doc_id", F.explode(_finder(sent, threshold)(F.col("text"))).alias("h")).select("doc_id", "h.*")
        if not last:   # only one shard is held at a time
            found = stored(found, "item-hits")
            sent.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents in which no test item is found; all columns pass through."""
    before = None
    for index, last in item_shards(items, shard_words):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.filter(F.size(_finder(sent, threshold)(docs["text"])) == 0)
        if not last:
            docs = stored(docs, "clean-docs")
            sent.destroy()
            drop_stored(before)
            before = docs
    return docs

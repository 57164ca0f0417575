"""Importance resampling of documents towards a target distribution.

Documents are drawn by how much likelier their hashed word features are in a
target set than in the corpus, with Gumbel noise, so that the highest scores
are a weighted sample without replacement.

1. Features (runs of 1 to ``ngram`` consecutive words) fall into ``buckets``
   by crc32. Every task adds up an array of bucket counts over all its texts;
   the arrays are summed by bucket.
2. Each bucket's gain, floor(1000 * ln of the smoothed ratio), stands in an
   array of ``buckets`` numbers, the only thing that is broadcast. A
   document's weight is the sum of the gains of its features, looked up in
   that array; the score adds noise from a hash of its id.
3. The cutoff of the drawn documents is found by weighted median-of-medians
   selection: every partition names the median of its remaining keys, and the
   median of these, weighted by how many keys remain in each partition, is the
   pivot. One pass counts the keys on both sides of it and names the medians
   of both for the next pivot. Each pass discards at least a quarter of the
   keys, until few enough for one sort remain or the pivot is the cutoff
   itself. Only a row of numbers for each partition comes to the driver.
4. The winners, known by comparison with the cutoff, are sorted over range
   parts and numbered; no row is joined back.

Defined cases: a null or empty text has no features, weight 0; a null doc_id
has the noise of an empty id and comes last among equal scores; repeated rows
are documents of their own, and where equal ones stand at the cutoff just as
many are drawn as fit; an empty target or corpus has counts of 0; an empty
table gives no rows; other columns are ignored. Long words are not kept in
the lookup, which is emptied when it is full.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import prepare, stored
from attrition.llm.words import words_of
from attrition.operators.prefix import ordered_row_number

BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
#: Keys left at which the selection ends with one sort on the driver.
LAST_KEYS = 4096
#: Distinct words that a task keeps at once, and the longest of them in bytes.
KEPT_WORDS, KEPT_BYTES = 200_000, 64

#: Ascending order of keys is drawing order: high scores first, then small ids, null ids last.
KEY = ("k_score", "k_none", "k_id", "k_size")


def features_of(text: bytes | None, ngram: int) -> tuple[int, list[bytes]]:
    """The number of words of a text, and its features."""
    words = words_of(text)
    out = list(words)
    for n in range(2, ngram + 1):
        out += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    return len(words), out


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, ngram: int = 1) -> np.ndarray:
    """How often features of each bucket occur in all rows of ``text``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(buckets, np.int64), Counter()

        def empty() -> None:
            at = np.fromiter((crc32(w) % buckets for w in seen), np.int64, len(seen))
            np.add.at(total, at, np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()

        for pdf in batches:
            for text in pdf["text"]:
                seen.update(features_of(text, ngram)[1])
                if len(seen) > KEPT_WORDS:
                    empty()
        empty()
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    rows = (texts.select(F.col("text").cast("binary").alias("text")).filter("text is not null")
            .mapInPandas(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(ratio)) of the smoothed shares of each bucket."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([floor(1000 * log(float((t + 1) * (s_all + b)) / float((s + 1) * (t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


class _Gains(dict):
    """Feature -> gain, filled when first asked for."""

    def __init__(self, gains: list[int]):
        super().__init__()
        self.gains = gains

    def __missing__(self, feature: bytes) -> int:
        gain = self.gains[crc32(feature) % len(self.gains)]
        if len(feature) <= KEPT_BYTES:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[feature] = gain
        return gain


def weighed(docs: DataFrame, gains: np.ndarray, ngram: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row of doc_id, text."""
    shared = docs.sparkSession.sparkContext.broadcast(gains.tolist())

    @F.pandas_udf("n_words bigint, n_features bigint, weight bigint")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gain = _Gains(shared.value)
        for texts in batches:
            rows = []
            for text in texts:
                words, features = features_of(text, ngram)
                rows.append((words, len(features), sum(map(gain.__getitem__, features))))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype=np.int64)

    return docs.select("doc_id", weigh(F.col("text").cast("binary")).alias("w")).select("doc_id", "w.*")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256('seed:doc_id')."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _sorted_keys(parts: list[pd.DataFrame]) -> np.ndarray:
    """The rows of key columns, ascending."""
    x = np.concatenate([p[list(KEY)].to_numpy(np.int64) for p in parts]) if parts else np.zeros((0, len(KEY)), np.int64)
    return x[np.lexsort(x.T[::-1])]


def _before(row: tuple, strict: bool = True) -> Column:
    """Whether a row's key comes before ``row`` (or is equal, unless strict)."""
    test = F.lit(not strict)
    for name, v in reversed(list(zip(KEY, row))):
        test = (F.col(name) < v) | ((F.col(name) == v) & test)
    return test


def _sides(pivot: tuple | None):
    """The function that gives, for a partition, the numbers of keys before, at and after the
    pivot and the lower medians of those before and after it (no pivot: all count as after)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = _sorted_keys(list(batches))
        if not len(x):
            return
        lo = hi = 0
        if pivot is not None:
            rows = list(map(tuple, x.tolist()))
            lo, hi = bisect_left(rows, pivot), bisect_right(rows, pivot)
        row: list = [lo, hi - lo, len(x) - hi]
        for part in (x[:lo], x[hi:]):
            row.append(part[(len(part) - 1) // 2].tolist() if len(part) else None)
        yield pd.DataFrame([row], columns=["before", "equal", "after", "low", "high"])

    return run


def _weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    half, run = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        run += n
        if run >= half:
            return key
    raise ValueError("no medians")


def select_cutoff(keys: DataFrame, k: int, last_keys: int = LAST_KEYS) -> tuple | None:
    """The k-th smallest key of all rows (columns ``KEY``), or None if there are fewer."""
    schema = "before bigint, equal bigint, after bigint, low array<bigint>, high array<bigint>"
    rest, pivot, stored_rows = keys.select(*KEY), None, None
    while True:
        rows = rest.mapInPandas(_sides(pivot), schema).collect()
        before, equal, after = (sum(r[c] for r in rows) for c in ("before", "equal", "after"))
        if k > before + equal + after:
            return None
        if before < k <= before + equal:
            return pivot
        if k <= before:
            rest, left, side, count = rest.filter(_before(pivot)), before, "low", "before"
        else:
            if pivot is not None:
                rest = rest.filter(~_before(pivot, strict=False))
            k, left, side, count = k - before - equal, after, "high", "after"
        if left <= last_keys:
            return tuple(_sorted_keys([rest.toPandas()])[k - 1].tolist())
        stored_rows = stored_rows or left
        if left * 8 <= stored_rows:   # so that all passes together read a bounded multiple of the keys
            rest, stored_rows = stored(rest, "keys"), left
        pivot = _weighted_median([(tuple(r[side]), r[count]) for r in rows if r[count]])


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, ngram: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each row of doc_id, text; rank numbers the drawn ones from 1.

    Of the N documents with at least ``min_words`` words, floor(percent * N / 100) are drawn."""
    prepare(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, buckets, ngram), bucket_counts(target, buckets, ngram))
    score = F.col("weight") + gumbel(F.col("doc_id"), seed)
    rows = stored(weighed(docs, gains, ngram).withColumn("score", score.cast("long")), "scored")
    out = ["doc_id", "n_features", "weight", "score"]
    keyed = rows.withColumns({"k_score": -F.col("score"), "k_none": F.col("doc_id").isNull().cast("long"),
                              "k_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "k_size": F.col("n_features")})
    able = F.col("n_words") >= min_words
    k = percent * rows.filter(able).count() // 100
    cut = select_cutoff(keyed.filter(able), k) if k else None
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return rows.select(*out, none)
    drawn = able & _before(cut, strict=False)
    ranked = ordered_row_number(keyed.filter(drawn).select(*out, *KEY), [F.col(c) for c in KEY], out="rank")
    return ranked.select(*out, F.when(F.col("rank") <= k, F.col("rank")).alias("rank")).union(
        keyed.filter(~drawn).select(*out, none))


OP12_SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
), w AS (
  SELECT doc_id, row_number() OVER () AS r, true AS is_doc, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL SELECT NULL, row_number() OVER (), false, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), x AS (SELECT r, is_doc, word, count(*) AS c FROM (SELECT r, is_doc, unnest(ws) AS word FROM w) GROUP BY ALL),
b AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, CAST(length(hex(word)) // 2 AS BIGINT)), lambda i:
    CAST('0x' || substr(hex(word), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM x), crc
), n AS (
  SELECT bucket, coalesce(sum(c) FILTER (is_doc), 0) AS s, coalesce(sum(c) FILTER (NOT is_doc), 0) AS t
  FROM x JOIN b USING (word) GROUP BY bucket
), tot AS (SELECT sum(s) AS ss, sum(t) AS tt FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000)::DOUBLE / ((s + 1)::DOUBLE * (tt + 10000)::DOUBLE))) AS BIGINT) AS gain FROM n, tot),
d AS (SELECT r, sum(c * gain) AS weight FROM x JOIN b USING (word) JOIN g USING (bucket) WHERE is_doc GROUP BY r),
p AS (
  SELECT w.r, doc_id, len(ws) AS n_features, CAST(coalesce(d.weight, 0) AS BIGINT) AS weight,
    CAST(('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS h
  FROM w LEFT JOIN d USING (r) WHERE is_doc
), q AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM p),
z AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS able
  FROM q WHERE n_features >= 20
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, CAST(score AS BIGINT) AS score,
       CASE WHEN rank <= 10 * able // 100 THEN CAST(rank AS BIGINT) END AS rank
FROM q LEFT JOIN z USING (r)
"""

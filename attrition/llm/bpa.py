"""Ranked lexical search by the Best Position Algorithm.

A document scores the sum of its terms' impacts over a query's terms; an
impact is a function of the term's rarity, its count in the document and the
document's length. Steps:

1. Queries are taken in blocks of bounded size, whose terms form a vocabulary.
   One pass over the documents writes the counts of these terms in each
   (``postings``); all corpus statistics come from all documents.
2. The documents are searched in shards of bounded size inside the tasks. A
   shard has one impact list per term, highest first, and a table of every
   document's position in every list for direct access.
3. Best Position Algorithm: the lists of a query are read from the top in
   parallel; each document met is scored whole by direct accesses, which also
   show its positions in the other lists. The best position of a list is the
   end of its unbroken run of seen positions. No unseen document can beat the
   sum of the impacts there, which is at most the sum at the last positions
   read; the search stops when it lies strictly below the k-th best score, so
   equal scores are all met. Best scores of earlier shards of the same task
   count for the k-th.
4. The best k of every task are ranked once more for each query.

Defined cases: a null or empty text has no terms, is never found and does not
count as a document; a query without terms finds nothing; repeated queries
give their results each, repeated documents are found each; equal scores go by
doc_id, null ids last; an empty table gives no rows; other columns are
ignored. Texts are worked whole; a document's numbers are exact integers, and
its length factor does not overflow.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.common import prepare, stored
from attrition.llm.words import words_of

K = 20
#: Weight of a document's length in an impact, in percent.
LENGTH_PERCENT = 25
#: Words of the queries that are searched together; more make more blocks.
BLOCK_WORDS = 200_000
#: Cells of a shard's table of positions (2 bytes each), and the bounds of its documents.
CELLS, LEAST_DOCS, MOST_DOCS = 1 << 24, 256, 4096
#: Positions read from each list at first; later rounds read twice as many as before.
FIRST_READ = 8


class Shard:
    """Impact lists of the documents of one shard and their positions."""

    def __init__(self, ids: list, terms: list[np.ndarray], tfs: list[np.ndarray], lengths: list[int], weights: np.ndarray):
        """``lengths`` are the documents' length factors."""
        self.ids = ids
        doc = np.repeat(np.arange(len(ids)), [len(t) for t in terms])
        term, tf = np.concatenate(terms), np.concatenate(tfs).astype(np.int64)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * np.array(lengths, np.int64)[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.terms, self.first, self.size = np.unique(term, return_index=True, return_counts=True)
        row = np.repeat(np.arange(len(self.terms)), self.size)
        self.place = np.full((len(self.terms), len(ids)), -1, np.int16)
        self.place[row, self.doc] = np.arange(len(term)) - self.first[row]

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, top: list[tuple]) -> tuple[list[tuple], int]:
        """The best k of (-score, id is null, id) among ``top`` and this shard, and the positions read."""
        at = np.searchsorted(self.terms, terms)
        have = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)
        at, times = at[have], times[have]
        if not len(at):
            return top, 0
        first, size, place = self.first[at], self.size[at], self.place[at]
        seen = np.zeros((len(at), int(size.max()) + 1), bool)   # the last column stays unseen
        known = np.zeros(len(self.ids), bool)
        read, step, most = 0, FIRST_READ, int(size.max())
        while True:
            upto = np.minimum(size, read + step)
            new = np.unique(np.concatenate([self.doc[f + min(read, u):f + u] for f, u in zip(first, upto)]))
            new = new[~known[new]]
            if len(new):
                known[new] = True
                p = place[:, new]
                hit = p >= 0
                score = (np.where(hit, self.impact[first[:, None] + p * hit], 0) * times[:, None]).sum(0)
                row, col = np.nonzero(hit)
                seen[row, p[row, col]] = True
                good = score > 0 if len(top) < k else score >= -top[-1][0]
                if good.any():
                    found = [(-s, self.ids[d] is None, self.ids[d] or 0) for s, d in zip(score[good].tolist(), new[good].tolist())]
                    top = sorted([t for t in found if t[0]] + top)[:k]
            read += step
            if read >= most:
                return top, read
            best = seen.argmin(1)   # positions seen without a gap
            bound = int((times * np.where(best < size, self.impact[first + np.maximum(best, 1) - 1], 0)).sum())
            if len(top) == k and bound < -top[-1][0]:
                return top, read
            step *= 2


def _blocks(items: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """row, block, item_id, terms (with repeats) of the queries that have terms, and the number of blocks."""

    @F.pandas_udf("array<binary>")
    def terms(texts: pd.Series) -> pd.Series:
        return pd.Series([words_of(t) for t in texts])

    rows = stored(items.select("item_id", terms(F.col("text").cast("binary")).alias("terms")).filter(F.size("terms") > 0)
                  .withColumn("row", F.monotonically_increasing_id()), "queries")
    words = rows.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"]
    n = -(-words // block_words)
    return rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, n)))), n


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), ids and tfs of the vocabulary's terms, of all rows that have terms."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("n bigint, ids array<int>, tfs array<int>")
    def count(texts: pd.Series) -> pd.DataFrame:
        get, rows = known.value.get, []
        for text in texts:
            words = words_of(text)
            tf = Counter(map(get, words))
            tf.pop(None, None)
            rows.append((len(words), np.fromiter(tf.keys(), np.int32, len(tf)), np.fromiter(tf.values(), np.int32, len(tf))))
        return pd.DataFrame(rows, columns=["n", "ids", "tfs"])

    return docs.select("doc_id", count(F.col("text").cast("binary")).alias("p")).select("doc_id", "p.*").filter("n > 0")


def _searcher(queries: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int, k: int, spark):
    """The function that searches the postings of a partition shard by shard."""
    shared = spark.sparkContext.broadcast((queries, weights))
    docs = max(LEAST_DOCS, min(MOST_DOCS, CELLS // max(1, len(weights))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, weight = shared.value
        tops: list[list[tuple]] = [[] for _ in asked]
        held: list[tuple] = []

        def search() -> None:
            rows = [r for r in held if len(r[2])]
            held.clear()
            if rows:
                shard = Shard([r[0] for r in rows], [r[2] for r in rows], [r[3] for r in rows],
                              [100 - LENGTH_PERCENT + LENGTH_PERCENT * r[1] * n_docs // n_terms for r in rows], weight)
                for q, (_, _, terms, times) in enumerate(asked):
                    tops[q] = shard.best(terms, times, k, tops[q])[0]

        for pdf in batches:
            ids = [None if gone else int(d) for d, gone in zip(pdf["doc_id"], pdf["doc_id"].isna())]
            for row in zip(ids, pdf["n"].tolist(), pdf["ids"], pdf["tfs"]):
                held.append(row)
                if len(held) >= docs:
                    search()
        search()
        out = [(q[0], q[1], None if none else d, -s) for q, top in zip(asked, tops) for s, none, d in top]
        yield pd.DataFrame(out, columns=["row", "item_id", "doc_id", "score"]).astype({"item_id": "Int64", "doc_id": "Int64"})

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_words: int = BLOCK_WORDS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of each query (item_id, text)."""
    spark = docs.sparkSession
    prepare(spark)
    rows, n = _blocks(items, block_words)
    found = None
    for block in range(n):
        part = [(r["row"], r["item_id"], Counter(map(bytes, r["terms"]))) for r in rows.filter(F.col("block") == block).collect()]
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, _, tf in part for t in tf}))}
        held = stored(postings(docs, vocabulary), "postings")
        total = held.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = {r["term"]: r["df"] for r in held.select(F.explode("ids").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
        weights = np.array([floor(1000 * log((2 * total["docs"] + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
        queries = [(r, i, np.array([vocabulary[t] for t in sorted(tf)], np.int64), np.array([tf[t] for t in sorted(tf)], np.int64))
                   for r, i, tf in part]
        best = held.mapInPandas(_searcher(queries, weights, total["docs"], total["terms"], k, spark),
                                "row bigint, item_id bigint, doc_id bigint, score bigint")
        found = best if found is None else found.union(best)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark
), c AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
it AS (SELECT q, item_id, word, count(*) AS times FROM (SELECT q, item_id, unnest(ws) AS word FROM i) GROUP BY ALL),
tf AS (SELECT r, word, count(*) AS tf FROM (SELECT r, unnest(ws) AS word FROM d) WHERE word IN (SELECT word FROM it) GROUP BY ALL),
w AS (SELECT word, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY word),
m AS (SELECT r, doc_id, 75 + (25 * len(ws) * n_docs) // n_terms AS m FROM d, c),
s AS (
  SELECT q, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM it JOIN tf USING (word) JOIN w USING (word) JOIN m USING (r) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""

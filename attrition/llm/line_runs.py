"""Line dedup over levelled sorted runs of line hashes.

Each batch of documents is reduced to (line hash, documents, largest doc id).
The batch is merge-anti-joined with the runs: keys that some run already
shows in ``min_docs`` documents are settled and are not written again, the
rest becomes a new sorted run of level 0. Whenever a level holds ``fanout``
runs they are merged into one run of the next level. Batches go from large to
small doc ids, so a settled key already has its final keeper.

Line hashes are 128 bits (two seeded 64-bit hashes). Everything is built-in
Spark expressions; a hot line is one row per task after the partial
aggregation, and texts are shuffled once, by doc_id.

Defined cases: a null or empty text is one empty line; a null doc_id takes no
part in the dedup (its lines stay); rows that repeat a doc_id count as one
document and lose the same lines; keys shorter than ``min_chars`` code points
always stay; an empty table gives an empty result; other columns pass through
``dedup_lines`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import ASCII_SPACE, ascii_lower, fresh, prepare, stored
from attrition.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


class LineRuns:
    """The manifest of levelled runs: folders of sorted Parquet files under the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2, min_docs: int = MIN_DOCS):
        self.spark, self.fanout, self.min_docs = spark, fanout, min_docs
        self.base = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        path = f"{self.base}/level={level}/run={self.written}"
        self.written += 1
        rows.sortWithinPartitions("a", "b").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("a bigint, b bigint, n bigint, keeper bigint").parquet(*paths)

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def add(self, batch: DataFrame) -> None:
        """``batch``: distinct (doc_id, a, b). Documents of two batches must not overlap."""
        keys = batch.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        if self.paths():
            settled = self._read(self.paths()).filter(F.col("n") >= self.min_docs).select("a", "b")
            keys = keys.join(settled.hint("merge"), ["a", "b"], "left_anti")
        self._write(keys, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self._write(self._merged(self._read(self.levels[level])), level + 1)
            self.levels[level] = []
            level += 1

    def condemned(self) -> DataFrame:
        """(a, b, keeper) of the keys found in at least ``min_docs`` documents."""
        return self._merged(self._read(self.paths())).filter(F.col("n") >= self.min_docs).drop("n")


def dropped_hashes(docs: DataFrame, n_batches: int = 4, min_chars: int = MIN_CHARS,
                   min_docs: int = MIN_DOCS, fanout: int = 2) -> DataFrame:
    """(doc_id, drops): for each document that loses lines, the hashes of the keys it loses."""
    spark = docs.sparkSession
    prepare(spark)
    ids = docs.filter(F.col("doc_id").isNotNull())
    cuts = ids.agg(F.percentile_approx("doc_id", [i / n_batches for i in range(n_batches - 1, 0, -1)], 1000)
                   .alias("c")).first()["c"] or []
    batch = F.lit(0)
    for cut in cuts:   # batch 0 holds the largest ids
        batch = batch + F.when(F.col("doc_id") <= cut, 1).otherwise(0)
    keys = F.transform(F.filter(F.transform(split_lines(F.col("text")), line_key),
                                lambda k: F.length(k) >= min_chars), _hash)
    lines = (ids.select("doc_id", F.explode(F.array_distinct(keys)).alias("h"))
             .select("doc_id", "h.a", "h.b", batch.alias("batch")))
    staged = f"{scratch_path(spark, 'line-keys')}"
    lines.write.partitionBy("batch").parquet(staged)
    staged_lines = spark.read.schema("doc_id bigint, a bigint, b bigint, batch int").parquet(staged)
    runs = LineRuns(spark, fanout, min_docs)
    for i in range(len(cuts) + 1):
        runs.add(staged_lines.filter(F.col("batch") == i).select("doc_id", "a", "b").distinct())
    # written first: the join is then between two plain shuffles, of which a hot line's can be split
    condemned = stored(runs.condemned(), "line-condemned")
    return (staged_lines.join(condemned, ["a", "b"])
            .filter(F.col("doc_id") != F.col("keeper"))
            .groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("drops")))


def dedup_lines(docs: DataFrame, n_batches: int = 4, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, fanout: int = 2) -> DataFrame:
    """``docs`` with ``text`` cut to its kept lines; every other column passes through.

    Needs columns doc_id (bigint) and text. ``line_counts`` has the digest.
    """
    return _cut(docs, "text", *fresh(docs, "n_lines", "n_dropped"), n_batches, min_chars, min_docs, fanout).select(*docs.columns)


def line_counts(docs: DataFrame, n_batches: int = 4, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, fanout: int = 2) -> DataFrame:
    """doc_id, text (its kept lines), n_lines (before dropping), n_dropped."""
    return _cut(docs.select("doc_id", "text"), "text", "n_lines", "n_dropped", n_batches, min_chars, min_docs, fanout)


def _cut(docs: DataFrame, text: str, n_lines: str, n_dropped: str, n_batches: int, min_chars: int,
         min_docs: int, fanout: int) -> DataFrame:
    drops = dropped_hashes(docs, n_batches, min_chars, min_docs, fanout)
    drop_id, gone, kept = fresh(docs, "drop_id", "gone", "kept")
    keyed = drops.select(F.col("doc_id").alias(drop_id), F.col("drops").alias(gone))
    lines = split_lines(F.col(text))
    joined = docs.join(keyed, docs["doc_id"] == keyed[drop_id], "left")

    def stays(line: Column) -> Column:
        key = line_key(line)
        return ~((F.length(key) >= min_chars) & F.array_contains(F.col(gone), _hash(key)))

    out = joined.withColumns({n_lines: F.size(lines).cast("long"),
                              kept: F.when(F.col(gone).isNull(), lines).otherwise(F.filter(lines, stays))})
    out = out.withColumn(n_dropped, F.col(n_lines) - F.size(kept))
    cut = F.when(F.col(n_dropped) > 0, F.array_join(kept, "\n")).otherwise(F.col(text))
    return out.withColumn(text, cut).select(*docs.columns, n_lines, n_dropped)


def op9_digest(docs: DataFrame) -> DataFrame:
    out = line_counts(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), hot AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT l.doc_id, count(*)::BIGINT AS n_lines,
       (count(*) FILTER (WHERE h.k IS NOT NULL AND h.keeper <> l.doc_id))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
              FILTER (WHERE h.k IS NULL OR h.keeper = l.doc_id), '')) AS kept_sha256
FROM lines l LEFT JOIN hot h ON l.k = h.k
GROUP BY l.doc_id
"""

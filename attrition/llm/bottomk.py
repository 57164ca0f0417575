"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set is its distinct 5-word shingles, hashed to 64 bits; the
sketch is the ``K`` smallest hashes, and the overlap of two sketches estimates
their Jaccard similarity. Words and shingles of many texts are hashed together,
as arrays. Steps:

1. Equal sets (by size and two 64-bit sums) collapse into classes; the rest
   works on one row per class.
2. Inverted lists. Two sets at the similarity asked for share well over
   ``3/8`` of a sketch of ``K`` = 48 (the chance of fewer is about 1e-8), so
   each class is listed only under its rarest values, up to the prefix that
   two such sketches cannot both miss. Values that occur once are dropped;
   values of common passages come last in the order and mostly stay out.
3. Pairs. Lists of up to ``SMALL_LIST`` classes give all their pairs. In a
   longer list every class is paired with a few hubs only: the classes that
   have the fewest values of their own, which is what the origin of a group
   of near copies looks like, and one by hash.
4. Pairs are filtered by size and by the union sketch's estimate, and what is
   left is verified on the full sets, from the texts.
5. Links become components (large-star / small-star, reliable checkpoints).
6. Long lists may still hold more than one component. Of their classes,
   those that have more than a quarter of their shingles to themselves are
   similar to none. The rest, grouped by the lists they share, are compared
   block by block on their full sets, inside the tasks; a pair of blocks
   returns only the links that join components. So no list is cut and no
   link between components is lost, and a large group of near copies makes
   pairs neither through its hubs nor through its stragglers.

A class is known by a number of its own, not by a doc_id, which may stand on
several texts. Steps are pinned as Parquet in the shared folder, and a step's files
go when the next ones no longer read them. Nothing about single documents reaches the driver. One join picks the texts
of the listed classes; later steps read these only.

Defined cases: a text with fewer than five words has its whole word sequence
as one shingle; without words (or null) the set is empty, linked with
nothing; a null doc_id takes no part (its component is null, it is kept);
rows that repeat a doc_id are one document when their texts are equal, else
each row is judged by its text, and a component is named by the smallest doc_id of
its rows; an empty table gives no rows; other columns
are ignored. Words are separated by U+0020 and U+0009 to U+000D, A-Z
lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import ASCII_SPACE, drop_stored, fresh, prepare, stored
from attrition.session import release

SHINGLE = 5
K = 48
#: Least share of a sketch that two linked documents have in common, as a fraction.
SHARE = (3, 8)
#: Similarity asked for, in percent.
PERCENT = 75
SMALL_LIST = 16
BLOCK_ROWS = 1024
#: Bytes of texts that are cut into words and hashed together.
CHUNK_BYTES = 1 << 18
#: Words of more bytes are hashed one by one.
LONG_WORD = 64

_FOLD = bytes(32 if c in ASCII_SPACE.encode() else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Masks of the first 0 to 8 bytes of a little-endian word.
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of the texts in order, and where each text's words begin (one entry more than texts).

    A word is read eight bytes at a time, all words of the texts together; the few beyond
    ``LONG_WORD`` bytes are hashed one by one."""
    buf = b"".join((b" ", b" ".join(texts), b" " * 8)).translate(_FOLD)
    space = np.frombuffer(buf, np.uint8) == 32
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, length = edge[::2], edge[1::2] - edge[::2]
    first = np.searchsorted(start, np.cumsum([1] + [len(t) + 1 for t in texts]))
    eight = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    h = _mix((eight[start] & _BYTES[np.minimum(length, 8)]) ^ length.astype(np.uint64) * _STEP)
    at, more = 8, np.flatnonzero(length > 8)
    while len(more) and at < LONG_WORD:
        h[more] = _mix(h[more] * _STEP + (eight[start[more] + at] & _BYTES[np.minimum(length[more] - at, 8)]))
        at += 8
        more = more[length[more] > at]
    for i in more.tolist():
        h[i] = xxhash.xxh3_64_intdigest(buf[start[i]:start[i] + length[i]])
    return h, first


def _shingles(h: np.ndarray, width: int) -> np.ndarray:
    """The hashes (signed) of all runs of ``width`` words."""
    n = max(0, len(h) - width + 1)
    x = np.full(n, np.uint64(width))
    for i in range(width):
        x = _mix(x * _STEP + h[i:i + n])
    return x.view(np.int64)


def _joined_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of the texts one after the other, and their bounds."""
    h, first = _word_hashes(texts)
    words = np.diff(first)
    bounds = np.concatenate(([0], np.cumsum(np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0))))
    every, x = _shingles(h, SHINGLE), np.empty(bounds[-1], np.int64)
    for w, k, lo, hi in zip(words.tolist(), first.tolist(), bounds.tolist(), bounds[1:].tolist()):
        if w:
            x[lo:hi] = every[k:k + hi - lo] if w >= SHINGLE else _shingles(h[k:k + w], w)
            x[lo:hi].sort()
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    new[bounds[:-1][words > 0]] = True
    return x[new], np.concatenate(([0], np.cumsum(new)))[bounds]


def _chunks(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    """The texts (null: empty) in order, in lists of some ``CHUNK_BYTES``, at least one text each."""
    chunk, size = [], 0
    for t in texts:
        chunk.append(t or b"")
        size += len(chunk[-1])
        if size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def shingle_sets(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes (signed) of each UTF-8 text's shingles."""
    for chunk in _chunks(texts):
        x, bounds = _joined_sets(chunk)
        yield from np.split(x, bounds[1:-1])


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    x = np.concatenate((a, b))
    x.sort()
    both = int(np.count_nonzero(x[1:] == x[:-1]))
    return bool(both) and 100 * both >= percent * (len(a) + len(b) - both)


def _sketch(texts: pd.Series) -> pd.DataFrame:
    out = []
    for chunk in _chunks(texts):
        x, bounds = _joined_sets(chunk)
        n, u = np.diff(bounds), x.view(np.uint64)
        some = bounds[:-1][n > 0]
        sums = np.zeros((2, len(n)), np.int64)
        if len(some):
            sums[0, n > 0] = np.add.reduceat(u, some).view(np.int64)
            sums[1, n > 0] = np.add.reduceat(_mix(u ^ _STEP), some).view(np.int64)
        least = [x[lo:hi] for lo, hi in zip(bounds.tolist(), np.minimum(bounds[1:], bounds[:-1] + K).tolist())]
        out.append(pd.DataFrame({"n": n, "s1": sums[0], "s2": sums[1], "sketch": least}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=["n", "s1", "s2", "sketch"])


def _verify(a: pd.Series, text_a: pd.Series, text_b: pd.Series) -> pd.Series:
    key, new = a.to_numpy(), np.ones(len(a), bool)
    new[1:] = key[1:] != key[:-1]   # rows come sorted by the left document
    lefts, own, out = shingle_sets(text_a[new]), None, []
    for first, other in zip(new.tolist(), shingle_sets(text_b)):
        if first:
            own = next(lefts)
        out.append(similar(own, other))
    return pd.Series(out, dtype=bool)


def _least(size: Column) -> Column:
    """The least overlap of linked sketches, one of which has this size."""
    return F.ceil(size * SHARE[0] / F.lit(SHARE[1])).cast("int")


def sketches(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, carried columns, n, s1, s2, sketch of each row of doc_id, text."""
    sketch = F.pandas_udf(_sketch, "n bigint, s1 bigint, s2 bigint, sketch array<bigint>")
    return docs.select("doc_id", *carry, sketch(F.col("text").cast("binary")).alias("s")).select("doc_id", *carry, "s.*")


def listed_classes(classes: DataFrame) -> DataFrame:
    """class, keys, common, weight: the retained values under which each class
    (class, sketch) is listed, rarest first; the share of its sketch that
    others have too, and how common these values are."""
    values = classes.select("class", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("f")).filter("f > 1")
    own = values.join(shared, "value").groupBy("class", "size").agg(
        F.sort_array(F.collect_list(F.struct("f", "value"))).alias("shared"), F.sum(F.log("f")).alias("weight"))
    # values that occur once fill the prefix first
    room = F.col("size") - _least(F.col("size")) + 1 - (F.col("size") - F.size("shared"))
    return own.filter(room > 0).select(
        "class", F.transform(F.slice("shared", F.lit(1), room), lambda s: s["value"]).alias("keys"),
        (F.size("shared") / F.col("size")).alias("common"), "weight")


def list_pairs(listed: DataFrame) -> DataFrame:
    """Distinct pairs (a < b): all of short lists, members with hubs in long ones.

    The long lists of a class mostly name the same hubs, which are gathered by class before they make pairs."""
    index = listed.select("class", "common", "weight", F.explode("keys").alias("value"))
    tie = F.xxhash64("class")
    hubs = F.array(F.max_by("class", F.struct(F.col("common"), F.col("weight"), tie)),
                   F.max_by("class", F.struct(F.col("weight"), tie)), F.max_by("class", tie))
    lists = index.groupBy("value").agg(F.count("*").alias("size"), hubs.alias("hubs")).filter("size > 1")
    small = index.join(lists.filter(F.col("size") <= SMALL_LIST).select("value"), "value")
    pairs = small.select("value", F.col("class").alias("a")).join(
        small.select("value", F.col("class").alias("b")), "value").filter("a < b").select("a", "b")
    met = index.join(lists.filter(F.col("size") > SMALL_LIST), "value").groupBy("class").agg(
        F.array_distinct(F.flatten(F.collect_set("hubs"))).alias("hubs"))
    large = met.select("class", F.explode("hubs").alias("hub")).filter("class <> hub")
    return pairs.union(large.select(F.least("class", "hub"), F.greatest("class", "hub"))).distinct()


def listed_texts(docs: DataFrame, classes: DataFrame, listed: DataFrame) -> DataFrame:
    """class, text (UTF-8) of the listed classes, in the shared folder, from the rows (doc_id, text hash) that stand for them."""
    own = classes.join(listed.select("class"), "class").select("class", F.col("one.doc_id").alias("_id"), F.col("one.hash").alias("_hash"))
    text = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("text"))
    return stored(text.join(own, (F.col("doc_id") == F.col("_id")) & (F.col("hash") == F.col("_hash")))
                  .groupBy("class").agg(F.first("text").alias("text")), "near-texts")


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sizes and union sketch allow the similarity."""
    left = classes.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    right = classes.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
    both = pairs.join(left, "a").join(right, "b").filter(
        100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    union = F.slice(F.array_sort(F.array_union("ka", "kb")), 1, K)
    shared = F.size(F.array_intersect(union, F.array_intersect("ka", "kb")))
    return both.filter(shared * SHARE[1] >= F.size(union) * SHARE[0]).select("a", "b")


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar (texts: class, text)."""
    one = texts.select(F.col("class").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("class").alias("b"), F.col("text").alias("tb"))
    return pairs.join(two, "b").join(one, "a").filter(F.pandas_udf(_verify, "boolean")("a", "ta", "tb")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link
    (a, b), by large-star and small-star steps until all edges are stars."""
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        # large star: neighbours above u go to the smallest neighbour
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        big = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # small star: u and its neighbours below go to the smallest of them
        big = big.distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(small.distinct(), "edges")
        drop_stored(before)
        before = edges
        release(spark)
        # stars: a node has one edge up and none down, or none up
        ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("v", F.lit(0), F.lit(1))).groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter("up > 1 or (up = 1 and down = 1)").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct())


def _incidence(owner: np.ndarray, values: np.ndarray, rows: int):
    """Slices of the 0/1 matrix (rows, values), for values of at least two rows."""
    _, value, count = np.unique(values, return_inverse=True, return_counts=True)
    use = count[value] > 1
    _, value = np.unique(value[use], return_inverse=True)
    owner = owner[use]
    for at in range(0, int(value.max(initial=-1)) + 1, 2048):
        part = (value >= at) & (value < at + 2048)
        x = np.zeros((rows, 2048), np.float32)
        x[owner[part], value[part] - at] = 1
        yield x


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links (a < b) of one pair of blocks that join its components into a forest."""
    rows = pdf.drop_duplicates("class").reset_index(drop=True)
    i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
    own = rows["own"].to_numpy()
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    n, root, name = (rows[x].to_numpy() for x in ("n", "root", "class"))
    sets = rows["shingles"].tolist()
    c = np.array([len(x) for x in sets])
    # shingles that a set has to itself are in no intersection
    most = np.minimum(c[left][:, None], c[right][None])
    total = n[left][:, None] + n[right][None]
    good = (root[left][:, None] != root[right][None]) & (100 * most >= PERCENT * (total - most))
    if good.any():
        shared = np.zeros(good.shape, np.int64)
        for x in _incidence(np.repeat(np.arange(len(rows)), c), np.concatenate(sets), len(rows)):
            shared += np.rint(x[left] @ x[right].T).astype(np.int64)
        good &= 100 * shared >= PERCENT * (total - shared)
    above: dict[int, int] = {}

    def top(r: int) -> int:
        while r in above:
            r = above[r]
        return r

    out = []
    for p, q in zip(*np.nonzero(good)):
        a, b = left[p], right[q]
        x, y = top(root[a]), top(root[b])
        if x != y:
            above[max(x, y)] = min(x, y)
            out.append((min(name[a], name[b]), max(name[a], name[b])))
    return pd.DataFrame(out, columns=["a", "b"])


def _full_set(texts: pd.Series) -> pd.Series:
    return pd.Series(list(shingle_sets(texts)))


def shared_shingles(texts: DataFrame) -> DataFrame:
    """class, shingles: those of each set that some other set of ``texts`` has too."""
    every = texts.select("class", F.explode(F.pandas_udf(_full_set, "array<bigint>")("text")).alias("shingle"))
    common = every.groupBy("shingle").agg(F.count("*").alias("f")).filter("f > 1").select("shingle")
    return every.join(common, "shingle").groupBy("class").agg(F.collect_list("shingle").alias("shingles"))


def unfinished_links(listed: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Links between the components that meet in long lists (None: none meet)."""
    named = listed.select("class", "keys").join(roots.withColumnRenamed("node", "class"), "class", "left")
    index = named.select("class", F.coalesce("root", "class").alias("root"), F.explode("keys").alias("value"))

    def mixed(rows: DataFrame, least: int) -> DataFrame:
        return rows.groupBy("value").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"),
                                         F.min("class").alias("first")).filter(
            (F.col("size") > least) & (F.col("lo") != F.col("hi"))).select("value", "first")

    rows = met = stored(index.join(mixed(index, SMALL_LIST).select("value"), "value"), "met")
    if rows.isEmpty():
        return None
    sets = shared_shingles(texts.join(rows.select("class").distinct(), "class"))
    # a set with too many shingles to itself is similar to no other
    facts = stored(sets.join(classes.select("class", "n"), "class").filter(
        100 * F.size("shingles") >= PERCENT * F.col("n")), "shared")
    rows = rows.join(facts.select("class"), "class")
    meets = rows.join(mixed(rows, 1), "value").filter("class <> first").select(
        F.col("first").alias("a"), F.col("class").alias("b"))
    groups = components(meets).select(F.col("node").alias("class"), F.col("root").alias("group"))
    sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    members = groups.join(rows.select("class", "root").distinct(), "class").join(sizes, "group")
    dealt = (members.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class", "root"))
    out = stored(dealt.join(facts, "class").groupBy("group", "i", "j").applyInPandas(_block_links, "a bigint, b bigint"), "more-links")
    drop_stored(met, facts)
    return out


def duplicate_groups(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, _text_hash, n_shingles, _group, component_id and the carried columns of each row of doc_id, text.

    ``_group`` tells components apart; it is null where a row takes no part."""
    spark = docs.sparkSession
    prepare(spark)
    rows = stored(sketches(docs.withColumn("_text_hash", F.xxhash64("text")), "_text_hash", *carry)
                  .withColumn("_row", F.monotonically_increasing_id()), "sketches")
    classes = stored(rows.filter("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(
        F.min("_row").alias("class"), F.min("doc_id").alias("least"), F.first("sketch").alias("sketch"),
        F.min_by(F.struct("doc_id", F.col("_text_hash").alias("hash")), "_row").alias("one")), "classes")
    facts = classes.select("class", "n", "sketch")
    listed = stored(listed_classes(facts), "listed")
    texts = listed_texts(docs, classes.select("class", "one"), listed)
    pairs = stored(estimated(list_pairs(listed), facts), "pairs")
    links = stored(linked(pairs, texts), "links")
    drop_stored(pairs)
    release(spark)
    roots = components(links)
    more = unfinished_links(listed, facts, texts, roots)
    if more is not None and not more.isEmpty():
        roots = components(links.union(more))
    drop_stored(listed, texts, links, more)
    release(spark)
    named = classes.select("n", "s1", "s2", "class", "least").join(roots.withColumnRenamed("node", "class"), "class", "left")
    names = named.filter("root is not null").groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(names.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"), "left").select(
        F.col("n").alias("cn"), F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.coalesce("root", "class").alias("group"),
        F.coalesce("component", "least").alias("component"))
    joined = rows.select("doc_id", "_text_hash", "n", "s1", "s2", *carry).join(
        named, (F.col("n") == F.col("cn")) & (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")), "left")
    here = F.col("doc_id").isNotNull()
    return joined.select("doc_id", "_text_hash", F.col("n").alias("n_shingles"), F.when(here, F.col("group")).alias("_group"),
                         F.when(here, F.coalesce("component", "doc_id")).alias("component_id"), *carry)


def near_duplicates(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and the carried columns of each row of doc_id, text."""
    return duplicate_groups(docs, *carry).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *carry)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of the smallest (doc_id, text hash)
    stays, once. Rows without words or doc_id stay."""
    groups = stored(duplicate_groups(docs).select("doc_id", F.col("_text_hash").alias("hash"), F.col("_group").alias("group")), "groups")
    several = groups.filter("group is not null").groupBy(F.col("group").alias("of")).agg(
        F.min(F.struct("doc_id", "hash")).alias("best"), F.count("*").alias("rows")).filter("rows > 1")
    members = groups.join(several, F.col("group") == F.col("of"))
    here, k_id, k_hash = fresh(docs, "hash", "k_id", "k_hash")
    keys = lambda x: x.groupBy(F.col("doc_id").alias(k_id), F.col("hash").alias(k_hash)).agg(F.count("*").alias("n"))
    gone = keys(members.filter(F.struct("doc_id", "hash") != F.col("best"))).select(k_id, k_hash)
    # rows equal to the one that stays
    again = keys(members.filter(F.struct("doc_id", "hash") == F.col("best"))).filter("n > 1").select(k_id, k_hash)
    same = (F.col("doc_id") == F.col(k_id)) & (F.col(here) == F.col(k_hash))
    rest = docs.withColumn(here, F.xxhash64("text")).join(gone, same, "left_anti")
    once = rest.join(again, same, "left_semi").dropDuplicates(["doc_id", here])
    return rest.join(again, same, "left_anti").union(once).select(*docs.columns)


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles FROM w
), k AS (SELECT doc_id, len(shingles) AS n, md5(array_to_string(list_sort(shingles), chr(10))) AS sig, shingles FROM s),
c AS (SELECT sig, n, min(doc_id) AS class, any_value(shingles) AS shingles FROM k WHERE n > 0 GROUP BY sig, n),
x AS (SELECT class, n, unnest(shingles) AS shingle FROM c),
p AS (
  SELECT a.class AS a, b.class AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.class < b.class
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT class AS node, class AS seen FROM c UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
m AS (SELECT node, min(seen) AS root FROM r GROUP BY node)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(m.root, k.doc_id) AS component_id, coalesce(m.root, k.doc_id) = k.doc_id AS kept
FROM k LEFT JOIN c ON k.sig = c.sig AND k.n = c.n LEFT JOIN m ON c.class = m.node
"""

"""Feature-store operators: latest row per entity, lookups, point-in-time
(as-of) joins, service assembly and latest-batch selection.

Design notes for scale:

* ``latest_per_entity`` is a ``max_by`` aggregate: partial aggregation on the
  map side, so a hot entity costs one row per task in the shuffle.
* ``point_in_time_join`` never puts a whole entity into one window
  partition. Feature and label rows collapse to distinct instants (partial
  aggregates), the instants are range-partitioned on (key, time), the as-of
  runs inside each (part, key), and the carry from earlier parts comes from
  a summary of at most one row per (key, part). Task size is bounded by the
  part size whatever the key or time distribution. No range join, no pairs.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from .. import session
from ..sources.sinks import path_exists


def _order_struct(ts: str, created: str | None, tie: Sequence[str]) -> Column:
    parts = [F.col(ts).alias("__o_ts")]
    if created:
        parts.append(F.col(created).alias("__o_created"))
    parts += [F.col(t).alias(f"__o_{i}") for i, t in enumerate(tie)]
    return F.struct(*parts)


def latest_per_entity(df: DataFrame, key: str, event_ts: str, created_ts: str | None = None,
                      start=None, end=None, tie: Sequence[str] = (),
                      features: Sequence[str] | None = None) -> DataFrame:
    """Newest row per entity with ``start < event_ts <= end``.

    Order: event time, then created time, then the tie-break columns.
    """
    # bounds take the column's own type, so the range filter reaches the Parquet scan
    ts_type = df.schema[event_ts].dataType
    if start is not None:
        df = df.filter(F.col(event_ts) > F.lit(start).cast(ts_type))
    if end is not None:
        df = df.filter(F.col(event_ts) <= F.lit(end).cast(ts_type))
    cols = [c for c in (features or df.columns) if c != key]
    payload = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(key).agg(F.max_by(payload, _order_struct(event_ts, created_ts, tie)).alias("__l"))
              .select(key, "__l.*"))


BUCKET = "store_bucket"


def read_materialized(spark: SparkSession, path: str) -> DataFrame:
    """The latest rows that :func:`materialize_increment` keeps under ``path``."""
    return spark.read.parquet(f"{path.rstrip('/')}/rows").drop(BUCKET)


def high_water_mark(spark: SparkSession, path: str):
    """The newest arrival time taken into the store, or None."""
    marks = f"{path.rstrip('/')}/marks"
    return spark.read.parquet(marks).agg(F.max("upto")).first()[0] if path_exists(spark, marks) else None


def materialize_increment(source: DataFrame, path: str, key: str, event_ts: str, arrived: str,
                          created_ts: str | None = None, upto=None, start=None, end=None,
                          tie: Sequence[str] = (), buckets: int = 64) -> list[int]:
    """J1, incremental: merge the rows that arrived since the last run into a
    table of the newest row per entity; returns the buckets it touched.

    A run takes the rows with ``mark < arrived <= upto`` (default: all that
    has arrived) and ``start < event_ts <= end``. Rows are judged by event
    time, not by arrival, so one that comes late never displaces a newer one.
    Rows without an arrival time are taken by every run: merging a row twice
    changes nothing, which also makes a run that died safe to repeat, as the
    mark moves last.

    The table has one partition per hash bucket of the key. Only the buckets
    of the new rows are read, and only they are overwritten. The new rows
    are first reduced to one per entity by a partial aggregate (a hot entity
    is one row per task), then both sides meet in one shuffle by bucket.
    ``buckets`` belongs to the table: all runs must give the same number, and
    it should leave a few hundred MB to a bucket. One run at a time.
    """
    spark, path = source.sparkSession, path.rstrip("/")
    rows, marks = f"{path}/rows", f"{path}/marks"
    mark, kind = high_water_mark(spark, path), source.schema[arrived].dataType
    if upto is None:
        upto = source.agg(F.max(arrived)).first()[0]
    at, fresh = F.col(arrived), F.lit(True)
    if mark is not None:
        fresh = at > F.lit(mark).cast(kind)
    new = source.filter(at.isNull() | (fresh & (at <= F.lit(upto).cast(kind)))).drop(arrived)
    order = dict(created_ts=created_ts, tie=tie)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    new = session.cut_lineage(latest_per_entity(new, key, event_ts, start=start, end=end, **order).withColumn(BUCKET, bucket))
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())   # at most ``buckets`` numbers
    if touched:
        both = new
        if path_exists(spark, rows):
            both = spark.read.schema(new.schema).parquet(rows).filter(F.col(BUCKET).isin(touched)).unionByName(new)
        # an aggregate by key after a shuffle by bucket needs none of its own
        both = both.repartition(BUCKET).withColumn("__key", F.struct(BUCKET, key))
        merged = latest_per_entity(both, "__key", event_ts, **order).drop("__key")
        merged.select(*new.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(rows)
    if upto is not None:
        one = spark.range(1).select(F.lit(upto).cast(kind).alias("upto"), F.lit(len(touched)).alias("buckets"),
                                    F.current_timestamp().alias("run_at"))
        one.write.mode("append").parquet(marks)
    return touched


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` as the table ``table`` under ``path``, bucketed and
    sorted by ``key``; returns the table.

    Rows are dealt by the key's hash before they are written, so a bucket is
    one file. Joins on the key then read the buckets as they lie: the table is
    shuffled once, when it is written. ``buckets`` should leave a few hundred
    MB to a file, and tables that are joined with each other take the same.
    Meant for tables of about one row per key (as :func:`latest_per_entity`
    gives): all rows of a key lie in one file.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
       .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def asked_rows(store: DataFrame, keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows of a bucketed ``store`` whose key is among ``keys``;
    the store is not shuffled.

    The keys come to the store: they are reduced to distinct ones by a partial
    aggregate (a hot key is one row per task), then dealt over as many
    partitions as the table has buckets. What is asked for is as small as the
    requests are; :func:`feature_lookup` and :func:`fill_from_store` join it
    back to them, and there AQE can split a hot key. Null keys match nothing.
    """
    asked = keys.select(F.col(key)).filter(F.col(key).isNotNull()).distinct().repartition(buckets, key)
    return store.join(asked, key, "left_semi")


def assemble_bucketed(entities: DataFrame, views: Mapping[str, tuple[DataFrame, Sequence[str]]],
                      key: str = S.ENTITY_KEY) -> DataFrame:
    """One row per row of ``entities`` with the features of every view
    (nulls where a view lacks the entity). All are bucketed by the key into
    equally many buckets, so no side of any join is shuffled: a left join
    keeps the buckets of its left side for the next one, which a full outer
    join would not."""
    out = entities.select(key)
    for src, feats in views.values():
        out = out.join(src.select(key, *feats), key, "left")
    return out


def feature_lookup(keys: DataFrame, latest: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Fetch features for entity keys; unknown keys get nulls.

    ``view:feature`` references are reduced to ``feature``. The join is left
    outer on the key; Spark/AQE broadcasts whichever side is small at run
    time and shuffles otherwise.
    """
    names = [f.split(":")[-1] for f in features]
    return keys.join(latest.select(key, *names), key, "left")


def point_in_time_join(labels: DataFrame, feats: DataFrame, key: str, label_ts: str, event_ts: str,
                       created_ts: str | None = None, ttl_days: int | None = S.FEATURE_TTL_DAYS,
                       tie: Sequence[str] = (), features: Sequence[str] | None = None,
                       partitions: int | None = None, feature_ts_name: str = "feature_timestamp") -> DataFrame:
    """For every label row, the newest feature row of the same key with
    ``event_ts <= label_ts`` (and within ``ttl_days``), else nulls.

    All label rows are kept (left semantics), duplicates included. Steps:

    1. one row per feature instant ``(key, event time)`` (the newest by
       created time / tie, a partial ``max_by``) and one per label instant;
    2. the instants are range-partitioned on ``(key, time, kind)`` into
       ``partitions`` parts (default: from the input size) and pinned with a
       reliable checkpoint, so a hot key spans many parts;
    3. inside each (part, key) a running max gives the newest feature instant
       at or before every label instant (features sort first at a tie);
    4. the carry from earlier parts comes from a (key, part) summary: at
       most ``partitions`` rows per key;
    5. the answer per label instant is joined back to the label rows.
    """
    if features is None:
        feat_cols = [c for c in feats.columns if c not in (key, event_ts, created_ts, *tie)]
    else:
        feat_cols = [c for c in features if c not in (key, event_ts, created_ts)]
    order_cols = [event_ts] + ([created_ts] if created_ts else []) + list(tie)
    order = F.struct(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(order_cols)])
    fstruct = F.struct(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(order_cols)],
                       *[F.col(c) for c in feat_cols])
    ts = lambda c: F.col(c).cast("timestamp")
    n = partitions or max(session.parts_for(labels), session.parts_for(feats))

    f_inst = (feats.filter(F.col(key).isNotNull())
                   .groupBy(F.col(key).alias("__key"), ts(event_ts).alias("__t"))
                   .agg(F.max_by(fstruct, order).alias("__f")))
    l_inst = (labels.filter(F.col(key).isNotNull())
                    .select(F.col(key).alias("__key"), ts(label_ts).alias("__t")).distinct())
    inst = (f_inst.select("__key", "__t", F.lit(0).alias("__kind"))
                  .unionByName(l_inst.withColumn("__kind", F.lit(1)))
                  .repartitionByRange(n, "__key", "__t", "__kind")
                  .withColumn("__p", F.spark_partition_id()))
    inst = session.cut_lineage(inst)   # both branches below must see the same part numbers

    feat_t = F.when(F.col("__kind") == 0, F.col("__t"))
    w_local = (Window.partitionBy("__p", "__key").orderBy("__t", "__kind")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (inst.withColumn("__lt", F.max(feat_t).over(w_local))
                 .filter(F.col("__kind") == 1)
                 .select("__key", "__p", "__t", "__lt"))
    w_carry = Window.partitionBy("__key").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    carry = (inst.groupBy("__key", "__p")
                 .agg(F.max(feat_t).alias("__pt"), F.max("__kind").alias("__has_label"))
                 .withColumn("__carry", F.max("__pt").over(w_carry))
                 .filter(F.col("__has_label") == 1)
                 .select("__key", "__p", "__carry"))
    answer = (local.join(carry, ["__key", "__p"], "left")
                   .select("__key", F.col("__t").alias("__lt_label"),
                           F.greatest("__lt", "__carry").alias("__ft"))
                   .join(f_inst.withColumnRenamed("__t", "__ft"), ["__key", "__ft"], "left")
                   .select("__key", "__lt_label", "__f"))

    lcols = labels.columns
    joined = (labels.withColumn("__key", F.col(key)).withColumn("__lt_label", ts(label_ts))
                    .join(answer, ["__key", "__lt_label"], "left"))
    best = F.col("__f")
    lt = ts(label_ts)
    fresh = best.getField("__k0") <= lt
    if ttl_days is not None:
        fresh = fresh & (best.getField("__k0") >= lt - F.expr(f"INTERVAL {int(ttl_days)} DAYS"))
    chosen = F.when(fresh, best)
    return joined.select(
        *[F.col(c) for c in lcols],
        chosen.getField("__k0").alias(feature_ts_name),
        *[chosen.getField(c).alias(c) for c in feat_cols])


def assemble_service(views: Mapping[str, tuple[DataFrame, Sequence[str]]], key: str = S.ENTITY_KEY) -> DataFrame:
    """Combine feature views into one row per entity.

    Views that share one source become a single ``select``; views over
    different sources are joined on the entity key (full outer, so an
    entity missing from one view keeps nulls for it).
    """
    by_source: dict[int, tuple[DataFrame, list[str]]] = {}
    for _, (src, feats) in views.items():
        entry = by_source.setdefault(id(src), (src, []))
        entry[1].extend(f for f in feats if f not in entry[1])
    frames = [src.select(key, *feats) for src, feats in by_source.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full_outer")
    return out


def fill_from_store(requests: DataFrame, store: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Use stored features only for requests that gave **no** feature.

    Only those requests join the store; the others pass by it (their columns
    widen to the common type in the union).
    """
    given_any = F.coalesce(*[F.col(f).cast("string") for f in features]).isNotNull()
    other = [c for c in requests.columns if c not in features]
    rest = requests.filter(given_any).select(*other, *features)
    st = store.select(key, *features)
    empty = requests.filter(~given_any).alias("r").join(st.alias("s"), F.col(f"r.{key}") == F.col(f"s.{key}"), "left")
    return rest.union(empty.select(*[F.col(f"r.{c}") for c in other], *[F.col(f"s.{f}").alias(f) for f in features]))


def latest_batch(df: DataFrame, ts: str = "ingested_at", by_run: str | None = None) -> DataFrame:
    """Rows of the newest batch.

    ``by_run=None``: rows whose ``ts`` equals ``max(ts)`` (scalar subquery).
    ``by_run="pipeline_run_id"``: rows of the run that wrote the newest row,
    which does not split or merge runs that share a timestamp.
    """
    if by_run is None:
        return df.filter(F.col(ts) == df.select(F.max(ts)).scalar())
    newest_run = df.select(F.max_by(F.col(by_run), F.struct(F.col(ts), F.col(by_run)))).scalar()
    return df.filter(F.col(by_run) == newest_run)

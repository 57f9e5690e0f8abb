"""Mixing sources to target weights by weighted fair queueing.

Each document, in shuffled order, gets a virtual finish time: the cumulative
tokens of its source divided by the source's target.  All sources served in
order of finish time get their shares at every point of the mix, and all reach
their targets at time 1.  The mix is the order of finish times, cut where the
total budget is reached.

Running sums never gather a source, the corpus or the list of sources in one
task: sums of hash buckets (within a source) and of time ranges (within the
mix) are added up first, along a range sort, and a window only runs inside one
bucket or range.  A bucket that an id on many rows makes large is cut further,
by size and by a hash of the row.  Finish times are spread evenly by
construction, so equal ranges of time hold equal shares.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofreq.llm.common import KEY, ROW, n_words, running, with_key, with_row
from cofreq.session import materialize

#: A source is given at most this many times.
MAX_REPEAT = 3
#: Rows that a bucket or a time range aims at.
RANGE_ROWS = 10_000
#: A bucket of more rows than this is cut.
HOT_ROWS = 50_000
#: Time ranges at least, so that a small mix also spreads over many tasks.
MIN_RANGES = 256


def source_targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets ``(source, rank, source_size, target)`` of sources, from
    ``(source, rank, source_size, weight)``.

    Sources share the total of all sizes by weight; a target stops at
    ``max_repeat`` times its source's size and the excess is shared by weight
    among the others until none is above.  In closed form: with sources by
    ascending cap over weight, the level at which the rest are served is the
    first ``(total - caps before) / weights from here`` that its own cap
    reaches.
    """
    capped = materialize(sizes.withColumn("cap", F.col("source_size") * max_repeat), "caps")
    total, weights = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights = F.lit(total or 0).cast("long"), F.lit(weights or 0).cast("long")
    by_cap = F.col("cap") / F.col("weight")
    leveled = running(capped.withColumn("ratio", by_cap), ["ratio", "rank"],
                      caps_before=F.col("cap"), weight_before=F.col("weight"))
    leveled = leveled.withColumn("level", (total - F.col("caps_before")) / (weights - F.col("weight_before")))
    level = leveled.where(F.col("level") <= F.col("ratio")).agg(
        F.min_by("level", F.struct("ratio", "rank"))).first()[0]
    cap = F.col("cap").cast("double")
    target = cap if level is None else F.least(cap, F.lit(level) * F.col("weight"))
    return capped.select("source", "rank", "source_size", target.alias("target"))


def cyclic_weights(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds ``rank`` (from 1, by code point, null last) and ``weight``, the
    cycle repeated along it.  One row per source."""
    weights = F.array(*map(F.lit, cycle))
    return (running(sizes, [F.col("source").asc_nulls_last()], before=F.lit(1))
            .withColumn("rank", (F.col("before") + 1).cast("int")).drop("before")
            .withColumn("weight", F.get(weights, (F.col("rank") - 1) % len(cycle))))


def mix(rows: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to ``rows``, which holds
    a unique ``rid``, ``doc_id``, ``source`` (null is a source of its own) and
    ``size``; ``copies`` says how often the mix takes the row.

    Documents of a source are shuffled by the MD5 of their id, which makes
    reruns agree; ties go to the smaller id and size, rows equal in both to the
    smaller hash of rid.  A source whose
    target is above its size goes through its documents again, up to
    ``max_repeat`` times.  Documents of size 0 are never taken.
    """
    n = rows.count()
    digits = max(2, math.ceil(math.log(max(n, 1) / RANGE_ROWS + 1, 16)))
    ranges = max(MIN_RANGES, n // RANGE_ROWS)
    rows = rows.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("bucket", F.substring("h", 1, digits))
    # rows of one id share a bucket: a large one is cut along the same order
    turn = F.pmod(F.xxhash64("rid"), F.lit(1 << 20))
    rows = rows.withColumn("turn", turn)
    place = ["bucket", "cut_h", "cut_size", "cut_turn"]
    hot = materialize(rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("rows"))
                      .where(F.col("rows") > HOT_ROWS)
                      .select(F.col("source").alias("hot_source"), F.col("bucket").alias("hot_bucket"),
                              F.ceil(F.col("rows") / RANGE_ROWS).alias("cuts")), "hot")
    cuts = F.lit(None).cast("long")
    if not hot.isEmpty():
        rows = rows.join(hot, F.col("source").eqNullSafe(F.col("hot_source"))
                         & (F.col("bucket") == F.col("hot_bucket")), "left").drop("hot_source", "hot_bucket")
        cuts = F.col("cuts")
    rows = (rows.withColumn("cut_h", F.when(cuts.isNotNull(), F.col("h")).otherwise(F.lit("")))
            .withColumn("cut_size", F.when(cuts.isNotNull(), F.col("size")).otherwise(F.lit(0)).cast("long"))
            .withColumn("cut_turn", F.coalesce(F.floor(F.col("turn") * cuts / (1 << 20)), F.lit(0)).cast("long"))
            .drop("cuts"))
    buckets = materialize(rows.groupBy("source", *place).agg(F.sum("size").alias("bucket_size")), "buckets")
    sizes = cyclic_weights(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    targets = materialize(source_targets(sizes, max_repeat), "targets")
    shares = running(targets, ["rank"], source_start=F.col("source_size")).withColumnRenamed("source", "t_source")
    starts = (running(buckets, [F.col("source").asc_nulls_last(), *place], start=F.col("bucket_size"))
              .join(shares, F.col("source").eqNullSafe(F.col("t_source")))
              .select(F.col("source").alias("b_source"), *[F.col(c).alias(f"b_{c}") for c in place],
                      "rank", "source_size", "target", (F.col("start") - F.col("source_start")).alias("before")))
    same = F.col("source").eqNullSafe(F.col("b_source"))
    for c in place:
        same = same & (F.col(c) == F.col(f"b_{c}"))
    inside = (Window.partitionBy("rank", *place).orderBy("h", "doc_id", "size", "turn", "rid")
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = materialize(rows.join(starts, same).withColumn("upto", F.col("before") + F.sum("size").over(inside))
                         .select("rid", "doc_id", "source", "size", "rank", "source_size", "target", "upto"),
                         "queue")
    # one entry per pass through the source, with its finish time
    queue = (placed.where("size > 0")
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
             .withColumn("finish", (F.col("pass") * F.col("source_size") + F.col("upto")) / F.col("target"))
             .withColumn("range", F.floor(F.col("finish") * ranges))
             .select("rid", "doc_id", "size", "rank", "pass", "finish", "range"))
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    totals = running(queue.groupBy("range").agg(F.sum("size").alias("range_size")), ["range"],
                     start=F.col("range_size"))
    # ranges that begin beyond the budget hold nothing that is taken
    totals = totals.where(F.col("start") <= F.lit(budget)).select("range", "start")
    order = (Window.partitionBy("range").orderBy("finish", "rank", "pass", "rid")
             .rowsBetween(Window.unboundedPreceding, 0))
    taken = (queue.join(totals, "range")
             .withColumn("end", F.col("start") + F.sum("size").over(order))
             .where(F.col("end") <= F.lit(budget))
             .groupBy("rid").agg(F.count("*").alias("copies")))
    return (placed.join(taken, "rid", "left")
            .select("rid", "doc_id", "source", "size", "source_size", "target",
                    F.coalesce("copies", F.lit(0)).cast("long").alias("copies")))


def _sized(docs: DataFrame, *extra: Column) -> DataFrame:
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "source",
        n_words(F.col("text")).alias("size"), *extra), "sizes")


def mix_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, a row per row of
    ``docs``; ``taken`` is the words that the mix takes, repeats counted.

    A null text has size 0; a null source is a source of its own, last in
    order; repeated rows are mixed one by one; an empty table gives an empty
    result; other columns are ignored.
    """
    return mix(_sized(docs)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, with
    their columns, whatever their names.  Rows equal in id, source and text
    share their copies evenly."""
    sized = _sized(with_key(docs.select("doc_id", "source", "text"), "source", "text"), *map(F.col, KEY))
    plan = mix(sized.drop(*KEY)).select("rid", "copies")
    per_key = (sized.select("rid", *KEY).join(plan, "rid").groupBy(*KEY)
               .agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
               .where("__copies > 0"))
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0)))
    share = (F.floor(F.col("__copies") / F.col("__rows"))
             + (nth <= F.col("__copies") % F.col("__rows")).cast("int")).cast("int")
    return (with_row(docs, "source", "text").join(per_key, list(KEY))
            .withColumn("__times", share).where("__times > 0")
            .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__times"))))
            .select(f"{ROW}.*"))


#: Rows of :func:`mix_documents` in DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (3 * sum(size))::BIGINT AS cap,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, (rank - 1) % 3 + 1 AS weight FROM s),
l AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, rank) AS place,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (
            ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY cap / weight, rank
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, rank, source_size,
         coalesce(least(cap::DOUBLE, (SELECT arg_min(level, place) FROM l WHERE level <= cap / weight) * weight),
                  cap::DOUBLE) AS target
  FROM l),
q AS (
  SELECT rid, doc_id, d.source, size, rank, source_size, target,
         (sum(size) OVER (PARTITION BY rank ORDER BY h, doc_id, size, rid
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (
  SELECT rid, size, rank, pass, (pass * source_size + upto)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1), (2)) AS p(pass) WHERE size > 0),
o AS (
  SELECT rid, sum(size) OVER (ORDER BY finish, rank, pass, rid
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM f),
c AS (SELECT rid, count(*) AS copies FROM o WHERE upto <= (SELECT sum(target) FROM t) GROUP BY rid)
SELECT doc_id, size, source_size, target, (size * coalesce(copies, 0))::BIGINT AS taken
FROM q LEFT JOIN c USING (rid)
"""

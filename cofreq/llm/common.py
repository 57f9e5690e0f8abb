"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cofreq.session import materialize, release

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Rows of one Arrow batch sent to Python: whole texts can be long, and two
#: workers share an executor's memory with the JVM.
ARROW_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python stages, and let workers
    on this machine find the package wherever the driver was started (on a
    cluster it is shipped with ``--py-files`` or installed)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def pack(a: np.ndarray) -> bytes:
    """Compressed integers below 2^40, byte by byte: small numbers leave whole planes of zeros."""
    planes = np.ascontiguousarray(a, "<i8").view(np.uint8).reshape(-1, 8)[:, :5].T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(5, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :5] = planes.T
    return out.view("<i8").ravel()


#: Columns that name a row by its content.
KEY = ("__k0", "__k1", "__k2")


def with_key(docs: DataFrame, *content: str) -> DataFrame:
    """Adds the columns of ``KEY``, never null: whether doc_id is null, doc_id,
    and a hash of the ``content`` columns.  They carry a decision on narrow
    rows back to whole ones; rows equal in all three are interchangeable."""
    return (docs.withColumn(KEY[0], F.col("doc_id").isNull())
            .withColumn(KEY[1], F.coalesce("doc_id", F.lit(0)))
            .withColumn(KEY[2], F.xxhash64(*content)))


#: Column that holds a row's own columns, where no name can clash.
ROW = "__row"


def with_row(docs: DataFrame, *content: str) -> DataFrame:
    """The columns of ``KEY``, and the rows' own columns in ``ROW``."""
    return (with_key(docs.select("doc_id", *content, F.struct("*").alias(ROW)), *content)
            .select(*KEY, ROW))


def smallest_hashes(ids: DataFrame, n: int, most: int) -> DataFrame:
    """Up to ``most`` of the ``n`` rows of ``ids``, those of the smallest
    hashes in its column ``h`` (then ``doc_id``).

    Hashes are even, so a limit on them that about twice ``most`` rows keep
    goes first, and no more than those meet in one task."""
    share = 2 * most / max(n, 1)
    if share < 1:
        ids = ids.where(F.col("h") < F.lit(-(1 << 63) + int((1 << 64) * share)))
    return ids.orderBy("h", "doc_id").limit(most)


def running(rows: DataFrame, order: list, **sums: Column) -> DataFrame:
    """Adds, for each of ``sums``, its sum over all rows that come earlier in
    ``order``, which must be total.

    The rows are range-sorted and written; sums inside a range start from
    those of the ranges before it, so only one row a range meets in one task.
    ``order`` may hold column names or sort expressions."""
    sorted_ = materialize(
        rows.select("*", *[c.alias(f"__{name}") for name, c in sums.items()]).orderBy(*order)
        .withColumn("__at", F.monotonically_increasing_id()), "running")
    # the upper bits of the id are the number of the range
    sorted_ = sorted_.withColumn("__part", F.shiftright("__at", 33))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sorted_.groupBy("__part").agg(*[F.sum(f"__{name}").alias(f"__{name}") for name in sums])
              .select(F.col("__part").alias("__of"),
                      *[F.coalesce(F.sum(f"__{name}").over(earlier), F.lit(0)).alias(f"__{name}_start") for name in sums]))
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    return (sorted_.join(F.broadcast(starts), F.col("__part") == F.col("__of"))
            .select(*rows.columns, *[(F.col(f"__{name}_start") + F.coalesce(F.sum(f"__{name}").over(inside), F.lit(0)))
                                     .alias(name) for name in sums]))


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph as ``(node, component)`` rows, where
    ``component`` is the smallest node reachable.

    ``edges`` has two columns of one orderable type; loops, repeats and either
    direction are fine, rows with a null end are ignored.  Only nodes with an
    edge to another node are returned.

    Alternates the large-star and small-star steps until the edges no longer
    change; every node then points at the smallest node of its component.  A
    step is a map-side combined minimum per node joined back to the edges, so
    no neighbourhood is ever gathered in one place, and a hub's rows may be
    split by AQE.  Each round is written to the checkpoint folder, so lineage
    stays one round deep.
    """
    a, b = edges.columns
    current = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(), "cc")

    def mark(df: DataFrame) -> tuple:
        h = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(h)).first())

    seen = mark(current)
    while seen[0]:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e"))
        following = materialize(small.select("e.*").where("u != v").distinct(), "cc")
        now = mark(following)
        release(current)
        current = following
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node")).distinct()
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(roots.select("node", F.col("node").alias("component"))))

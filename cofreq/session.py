"""Session helpers: building a session and cutting lineage.

Level-wise miners run a driver loop over DataFrames.  Each level's tables
are written as parquet under the cluster's checkpoint folder
(``spark.checkpoint.dir``) and read back, so a lost executor never has to
replay earlier levels, the next level's plan starts from a file scan with
real size statistics (which drive broadcast decisions), and the lineage
stays one level deep.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Bytes below which a helper table (item list, hot-group list, dictionary,
# level table) may be broadcast.  The size is measured or proven, never assumed.
BROADCAST_MAX_BYTES = 32 << 20


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "cofreq", driver_memory: str = "16g") -> SparkSession:
    """A session for tests, benchmarks and local runs (UI off, AQE on)."""
    master = master or os.environ.get("COFREQ_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for level tables.

    Uses the directory the session already has, else ``spark.checkpoint.dir``
    from the session's configuration.  Only when both are unset is one chosen
    here: a temporary folder for ``local`` masters (tests), and a folder under
    the warehouse directory otherwise, unless that is a local path, which the
    executors of a cluster would not share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cofreq-ckpt-"))
    else:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if urlparse(warehouse).scheme in ("", "file"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             f"executors share; the warehouse {warehouse} is a local path")
        sc.setCheckpointDir(warehouse.rstrip("/") + "/_cofreq_checkpoints")
    return sc.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """This application's folder of written tables; :func:`cleanup` removes it."""
    return f"{checkpoint_root(spark).rstrip('/')}/cofreq/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as parquet under the run folder and read it back.

    One pass over the input; the returned DataFrame is a plain file scan, so
    its lineage is cut and its size is known to the optimizer.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cofreq_path = path  # lets release() remove the table later
    return out


def _file(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    hpath, fs = _file(spark, path)
    fs.delete(hpath, True)


class Store:
    """The tables of one mining run, counted while they are written.

    Without a ``path`` they go to the run folder like :func:`materialize`'s.
    With one the run can be resumed: a table is written under its own name, and
    once it is complete a note beside it records its rows and schema.  A later
    run of the same parameters finds the note and reads the table, so nothing
    of a finished level runs again, whatever happened to the first driver.
    ``parameters`` name what the tables depend on; a folder that holds a run of
    other parameters is refused.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, parameters: dict | None = None):
        self.spark, self.path = spark, path.rstrip("/") if path else None
        said = {k: str(v) for k, v in (parameters or {}).items()}
        if self.value("parameters", lambda: said) != said:
            raise ValueError(f"{path} holds a run of other parameters")

    def _note(self, tag: str) -> dict | None:
        hpath, fs = _file(self.spark, f"{self.path}/{tag}.json")
        if not fs.exists(hpath):
            return None
        return json.loads(self.spark.read.text(hpath.toString(), wholetext=True).first()[0])

    def _record(self, tag: str, said: dict) -> None:
        # the note appears whole or not at all: written aside, then renamed
        hpath, fs = _file(self.spark, f"{self.path}/{tag}.json")
        aside, _ = _file(self.spark, f"{self.path}/.{tag}.{uuid.uuid4().hex}")
        out = fs.create(aside)
        out.write(json.dumps(said).encode())
        out.close()
        fs.rename(aside, hpath)

    def value(self, tag: str, compute):
        """What ``compute`` returns (JSON), from its note if there is one."""
        said = self._note(tag) if self.path else None
        if said is None:
            said = {"value": compute()}
            if self.path:
                self._record(tag, said)
        return said["value"]

    def write(self, df, tag: str, buckets: int | None = None,
              by: str | None = None) -> tuple[DataFrame, int]:
        """The written table and its number of rows, counted by the job that
        writes it.  With ``buckets`` the rows lie in that many files by the hash
        of ``by``, sorted by it, and the table says so: a join or an aggregate
        on ``by`` reads it without another shuffle.  ``df`` may be a function
        that makes the DataFrame, called only if the table is to be written."""
        path = f"{self.path}/{tag}" if self.path else f"{run_folder(self.spark)}/{tag}-{uuid.uuid4().hex}"
        said = self._note(tag) if self.path else None
        name = None
        if said is None:
            seen = Observation()
            df = df() if callable(df) else df
            if buckets:
                df = df.repartition(buckets, by)
            out = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(
                "overwrite" if self.path else "errorifexists")
            if buckets:
                name = f"cofreq_{uuid.uuid4().hex}"
                out.option("path", path).bucketBy(buckets, by).sortBy(by).format("parquet").saveAsTable(name)
            else:
                out.parquet(path)
            said = {"rows": seen.get["rows"], "schema": df.schema.json()}
            if self.path:
                self._record(tag, said)
        if name:
            out = self.spark.table(name)
            out._cofreq_table = name
        else:
            out = self.spark.read.schema(StructType.fromJson(json.loads(said["schema"]))).parquet(path)
        if not self.path:
            out._cofreq_path = path  # a run that can be resumed keeps its tables
        return out, said["rows"]


def release(*dfs: DataFrame | None) -> None:
    """Delete tables written by :func:`materialize` once nothing will read
    them again (intermediate rows and occurrence tables of finished levels).
    Results keep reading their level tables; :func:`cleanup` removes those."""
    for df in dfs:
        path = getattr(df, "_cofreq_path", None) if df is not None else None
        if path and getattr(df, "_cofreq_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._cofreq_table}")
        if path:
            _delete(df.sparkSession, path)
            df._cofreq_path = None


def cleanup(spark: SparkSession) -> None:
    """Delete every table this application has written.  Call it when no
    result is read any more: results read their level tables lazily."""
    _delete(spark, run_folder(spark))


def _row_bytes(schema: StructType) -> tuple[int, list[Column]]:
    """Bytes of a row's fixed part, and the sizes of its variable columns."""
    fixed, variable = 0, []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        fixed += 16
        if isinstance(f.dataType, (StringType, BinaryType)):
            variable.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, ArrayType):
            each = f.dataType.elementType
            width = (F.aggregate(c, F.lit(0), lambda n, x: n + 16 + F.coalesce(F.octet_length(x), F.lit(0)))
                     if isinstance(each, (StringType, BinaryType)) else F.size(c) * 16)
            variable.append(F.coalesce(width, F.lit(0)))
        elif isinstance(f.dataType, (StructType, MapType)):
            variable.append(F.octet_length(F.to_json(c)) * 2 + 16)
    return fixed, variable


def measured(df: DataFrame, limit: int | None = None, bound: int | None = None) -> tuple[bool, int]:
    """Whether ``df`` is within ``limit`` bytes, and its rows (at most).

    ``bound`` is a proven upper bound on the rows (e.g. a known count, or
    rows / min_support for frequent items); with columns of fixed width it
    decides without a job where it suffices.  Else rows and bytes are summed by
    a partial aggregate, one row per task reaching the last one.
    """
    limit = BROADCAST_MAX_BYTES if limit is None else limit
    fixed, variable = _row_bytes(df.schema)
    if bound is not None and not variable and bound * fixed <= limit:
        return True, bound
    size = F.lit(fixed).cast("bigint")
    for v in variable:
        size = size + v
    total, n = df.agg(F.sum(size), F.count(F.lit(1))).first()
    return (total or 0) <= limit, n


def broadcast_if_small(df: DataFrame, limit: int | None = None, bound: int | None = None) -> DataFrame:
    """Broadcast-hint ``df`` only when its size (see :func:`measured`) is within
    ``limit`` bytes, by default ``BROADCAST_MAX_BYTES``; otherwise leave the
    join strategy to Spark (shuffle join, AQE may still switch at run time)."""
    limit = BROADCAST_MAX_BYTES if limit is None else limit
    fixed, variable = _row_bytes(df.schema)
    if bound is not None and not variable:
        return F.broadcast(df) if bound * fixed <= limit else df
    return F.broadcast(df) if measured(df, limit)[0] else df

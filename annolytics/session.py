"""Spark session and shared-storage helpers.

The library never creates a session on its own inside an operator; callers
pass one in.  ``get_session`` is what tests, the bench and the driver entry
use locally.  On a cluster the cluster's own settings win: nothing here
overrides a value that is already set.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  AQE re-plans joins at
# runtime: a side whose *materialised* size is below the broadcast threshold
# is broadcast, anything larger stays a sort-merge join, and skewed
# partitions of a sort-merge join are split.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # text tables are CPU-heavy to scan: small splits spread them
    "spark.sql.files.maxPartitionBytes": "8m",
}


#: Deletes a query's shuffle files at its end (Spark 4.1; else ignored).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folder of the tables that ``materialize`` writes, if a job has set one.
SCRATCH: ContextVar[str | None] = ContextVar("annolytics_scratch", default=None)


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "annolytics",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench (``local[N]``)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    cores = int(master[master.index("[") + 1 : -1]) if master.startswith("local[") and master[6:-1].isdigit() else 8
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 2 * cores)
    # Rows here are whole texts and the per-row work (regexes) is CPU-heavy:
    # let AQE coalesce small shuffle outputs only down to ~256 KB partitions,
    # so a few MB of text still spread over the cores.  (At cluster scale the
    # advisory 64 MB size governs and this floor never binds.)
    conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "256k"
    # Results over ~1 MB are fetched from the advertised driver address;
    # in a container without a resolvable host name that must be loopback.
    conf["spark.driver.host"] = "127.0.0.1"
    conf["spark.driver.memory"] = os.environ.get("ANNOLYTICS_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or
    the one already set on the context), if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared scratch folder, the same on every call.

    A cluster must name it in ``spark.checkpoint.dir``.  Only a ``local``
    session, where driver and executors are one process, gets a fresh folder
    of its own; anything else is an error, because each executor would write
    to its own disk."""
    sc = spark.sparkContext
    d = checkpoint_dir(spark)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="annolytics-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What a write in this block exchanged is of no use once it has ended:
    its files go then instead of at some garbage collection of the driver."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df, name: str):
    """Write ``df`` once to a table in the shared folder and read it back.

    Cuts the lineage (a lost executor rereads files instead of replaying the
    plan), gives the optimiser the real size, and makes every later reader
    see the same rows."""
    spark = df.sparkSession
    folder = SCRATCH.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    with shuffles_deleted(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df, name: str, max_rows: int = 20_000):
    """``df`` written once, and hinted for broadcast if it has at most
    ``max_rows`` rows; a larger table is left to the join."""
    from pyspark.sql import functions as F

    table = materialize(df, name)
    return F.broadcast(table) if table.count() <= max_rows else table


def cut_lineage(df):
    """``materialize`` for expensive stages (duplicate resolution, text
    features) that several consumers (statistics, folds, fits) read."""
    return materialize(df, "stage")

"""Session set-up and the few settings every plan relies on."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", app: str = "sigmill", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local or cluster session: UTC, AQE with skew handling, ZSTD output."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    A cluster names it in ``spark.checkpoint.dir``, which Spark itself applies
    at start; only where no folder is set at all (tests on one machine) a
    temporary one is used.
    """
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="sigmill-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(named)
    return named


#: Bytes of the tables read per partition of a Python stage.
SPREAD_BYTES = 64 << 20


def cut(df):
    """Cut the lineage through the shared checkpoint folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    ship(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application; they needn't have it on their own path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="sigmill-ship-")
    copy = Path(folder) / "src"
    shutil.copytree(package, copy / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", copy))
    shutil.rmtree(copy)
    _shipped.add(sc.applicationId)


def spread(df, *columns):
    """Even partitions for a Python stage, which costs far more per byte than AQE's byte sizes assume.

    Their number grows with the size of the tables read and with the partitions
    of what was cut from its lineage, and is never below three per core or the
    session's shuffle partitions.
    """
    spark = df.sparkSession
    ship(spark)
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size, parts = 0, 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.nodeName().startswith("LogicalRelation"):
            size += int(leaf.stats().sizeInBytes())
        elif leaf.nodeName() == "LogicalRDD":  # cut from its lineage: its partitions were sized by the data
            parts = max(parts, leaf.rdd().getNumPartitions())
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism, size // SPREAD_BYTES, parts)
    return df.repartition(n, *columns)

"""Continuous ingest (an extension): windowed counts with a watermark, and exactly-once upserts of arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upserts import latest_by, unsynced


def tumbling_counts(df: DataFrame, time: str, key: str, size: str, late: str | None = None) -> DataFrame:
    """Counts per window and key; the same plan for a table and, with ``late``, for a stream with a watermark."""
    if late:
        df = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return df.groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def read_arriving(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream; the schema is given, never inferred."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


#: Buckets of keys; a batch rewrites only those it touches.
BUCKETS = 256


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _ledger(spark: SparkSession, target: str, batch: str) -> DataFrame:
    """(batch, bucket): what every applied batch wrote; empty only if there is no ledger yet, any other failure is raised."""
    if not _exists(spark, f"{target}/ledger"):
        return spark.createDataFrame([], f"{batch} long, bucket int")
    return spark.read.schema(f"{batch} long, bucket int").parquet(f"{target}/ledger")


def _current(spark: SparkSession, target: str, newest: dict[int, int], schema) -> DataFrame | None:
    """The rows of the given buckets, each from the batch that wrote it last."""
    paths = [f"{target}/states/n={n}/bucket={b}" for b, n in sorted(newest.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def read_state(spark: SparkSession, target: str, schema, batch: str = "batch_id") -> DataFrame:
    """The state that ``start_upserts`` keeps at ``target``."""
    newest = {r["bucket"]: r["n"] for r in _ledger(spark, target, batch).where("bucket >= 0").groupBy("bucket").agg(F.max(batch).alias("n")).collect()}  # one row per bucket
    state = _current(spark, target, newest, schema)
    return spark.createDataFrame([], schema) if state is None else state


def start_upserts(stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], batch: str = "batch_id"):
    """Keeps at ``target`` the latest row per key of all rows that arrived; ``read_state`` reads it.

    Keys are dealt to ``BUCKETS`` buckets; a batch merges and rewrites only the
    buckets it touches, beside their last state, and they become current when
    the ledger names them. Batches in the ledger are skipped, so a batch that
    is delivered again after a failure changes nothing. A ledger that is there
    but can't be read stops the stream.
    """

    def apply(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        ledger = _ledger(spark, target, batch)
        fresh = unsynced(df.withColumn(batch, F.lit(number).cast("long")), ledger.select(batch), [batch]).drop(batch)
        fresh = fresh.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
        touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS
        if touched:
            newest = {r["bucket"]: r["n"] for r in ledger.where(F.col("bucket").isin(touched)).groupBy("bucket").agg(F.max(batch).alias("n")).collect()}
            old = _current(spark, target, newest, df.schema)
            rows = fresh if old is None else fresh.unionByName(old.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")))
            latest_by(rows, keys, order).write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/states/n={number}")
        if not ledger.where(F.col(batch) == number).limit(1).count():
            spark.createDataFrame([(number, b) for b in touched or [-1]], f"{batch} long, bucket int").coalesce(1).write.mode("append").parquet(f"{target}/ledger")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

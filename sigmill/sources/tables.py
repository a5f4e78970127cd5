"""Reading the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Scan ``folder/name.parquet``; with ``columns``, only those are read."""
    ship(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after counting that it holds at most ``max_rows`` rows.

    Counting stops at ``max_rows + 1`` rows. A larger side comes back unchanged,
    so the join is planned as a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df

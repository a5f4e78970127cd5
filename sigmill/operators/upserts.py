"""Merge semantics over append-only tables: latest wins, first wins, replace, ledgers, id maps, SCD states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick(df: DataFrame, keys: list[str], order: list[Column], name: str = "_rn") -> DataFrame:
    """The first row per key in ``order`` (a total order makes it deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) == 1).drop(name)


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key by a partial aggregation; null keys form a group."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of both, one per key, the greatest ``order`` wins."""
    return latest_by(old.unionByName(new, allowMissingColumns=True), keys, order)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``old`` and of ``new`` the first row per key that ``old`` lacks."""
    return old.unionByName(pick(new.join(old.select(*keys).distinct(), keys, "left_anti"), keys, order))


def replace_all(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` and the rows of ``old`` whose keys it doesn't hold."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"))


def unsynced(rows: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of batches that the ledger doesn't name."""
    return rows.join(ledger.select(*keys).distinct(), keys, "left_anti")


def map_ids(provisional: DataFrame, known: DataFrame, column: str, mint: Column) -> DataFrame:
    """(provisional, canonical): known ids stay, only unmapped ones are minted from ``mint``."""
    new = provisional.select(column).where(F.col(column).isNotNull()).distinct().join(known.select(column), column, "left_anti")
    return known.unionByName(new.withColumn("canonical", mint))


def as_of(states: DataFrame, keys: list[str], t: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """The version of each key that is valid at ``t`` (half open, null end: current)."""
    return states.where((F.col(start) <= t) & (F.col(end).isNull() | (F.col(end) > t)))

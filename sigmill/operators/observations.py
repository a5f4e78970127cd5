"""The observation log: wide to long and back, validation against an ontology, conflict resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str = "signal_path", value: str = "value_num", keep_null: bool = False) -> DataFrame:
    """One observation per column; nulls are dropped unless asked for."""
    out = df.unpivot(ids, columns, name, value)
    return out if keep_null else out.where(F.col(value).isNotNull())


def typed(v: Column, kind: str) -> list[Column]:
    """The four value columns, exactly one of them filled."""
    none = lambda t: F.lit(None).cast(t)
    return [
        (v.try_cast("boolean") if kind == "bool" else none("boolean")).alias("value_bool"), (v.try_cast("double") if kind == "num" else none("double")).alias("value_num"),
        (v.cast("string") if kind == "str" else none("string")).alias("value_str"), (v.cast("string") if kind == "json" else none("string")).alias("value_json"),
    ]


def decoded(kind: str = "value_type") -> Column:
    """The value as text, by its type; booleans read true or false."""
    t = F.col(kind)
    return F.when(t == "bool", F.col("value_bool").cast("string")).when(t == "num", F.col("value_num").cast("string")).when(t == "str", F.col("value_str")).when(t == "json", F.col("value_json"))


def pivot_values(df: DataFrame, entity: str, name: str, value: str, names: list[str], agg=F.max) -> DataFrame:
    """One row per entity with a column for each of the known names."""
    return df.groupBy(entity).pivot(name, names).agg(agg(value))


def issues(df: DataFrame, ontology: DataFrame) -> DataFrame:
    """Adds ``issues``: what is wrong with each observation; an empty array is a valid one.

    ``ontology``: (signal_path, value_type, deprecated). Codes:
    invalid_path_format, unknown_signal (after which nothing else is judged),
    deprecated_signal, value_type_mismatch, no_value_populated,
    multiple_values_populated.
    """
    o = ontology.select(F.col("signal_path").alias("_p"), F.col("value_type").alias("_t"), F.col("deprecated").alias("_d"))
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("value_num", "value_str", "value_json")), F.col("value_bool").isNotNull().cast("int"))
    wrong = ~F.coalesce(F.col("signal_path"), F.lit("")).rlike(r"^[a-z][a-z0-9]*(?:\.[a-z][a-z0-9_]*)+$")
    out = df.join(o, F.col("signal_path") == F.col("_p"), "left")
    codes = F.array_compact(F.array(
        F.when(wrong, "invalid_path_format"), F.when(F.col("_p").isNull(), "unknown_signal"), F.when(F.col("_d"), "deprecated_signal"),
        F.when(F.col("_t") != F.col("value_type"), "value_type_mismatch"),
        F.when(F.col("_p").isNotNull() & (filled == 0), "no_value_populated"), F.when(F.col("_p").isNotNull() & (filled > 1), "multiple_values_populated"),
    ))
    return out.withColumn("issues", codes).drop("_p", "_t", "_d")


def last_writer(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds ``won``: true for the row that is first in ``order`` per key; the others are the conflict log."""
    return df.withColumn("won", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)


def conflicts(df: DataFrame, keys: list[str], arrival: list[Column], better: list[Column], told: list[str]) -> DataFrame:
    """The conflict log of last-writer-wins: per row but the first of a key, in order of ``arrival``, who won then and who lost.

    ``better`` orders rows from the greatest winner down; the row loses or beats the winner so far.
    """
    by_arrival = Window.partitionBy(*keys).orderBy(*arrival)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*better))
    here = F.struct(F.col("_rank"), *told)
    so_far = F.min(here).over(by_arrival.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("_rank", rank).withColumn("_so_far", so_far).withColumn("_here", here).where(F.col("_so_far").isNotNull())
    winner, loser = F.least("_so_far", "_here"), F.greatest("_so_far", "_here")
    return rows.select(*keys, *[winner[c].alias(f"winner_{c}") for c in told], *[loser[c].alias(f"loser_{c}") for c in told])

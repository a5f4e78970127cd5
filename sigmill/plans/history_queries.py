"""Queries on the history of assets (problem 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import fold_label, state_codes, version_history
from ..sources.tables import bounded_broadcast, table

#: Spellings of federal states that the zip-code table may give; 16 states exist.
MAX_STATE_SPELLINGS = 1000
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _history(spark: SparkSession, folder: str) -> DataFrame:
    states = table(spark, folder, "asset_states", "asset_id", "gewerk_group", "bundesland", "valid_from", "valid_to", "recorded_at")
    codes = bounded_broadcast(state_codes(table(spark, folder, "zipcodes", "state_code", "state")), MAX_STATE_SPELLINGS)
    keyed = states.withColumn("spelling", fold_label("bundesland")).join(codes, "spelling", "left")
    return version_history(
        keyed, "asset_id", "valid_from", "valid_to", "recorded_at",
        [fold_label("gewerk_group"), F.coalesce("code", "spelling")],
    )


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """One row per version of an asset, times as text."""
    return _history(spark, folder).select(
        F.col("entity").alias("asset_id"),
        F.date_format("start", ISO).alias("valid_from"),
        F.coalesce(F.date_format("end", ISO), F.lit("")).alias("valid_to"),
    )


_P4_SQL = r"""
WITH codes AS (
  SELECT DISTINCT regexp_replace(replace(replace(replace(replace(lower(s),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss'),'[^a-z0-9]','','g') AS spelling, state_code AS code
  FROM (SELECT state AS s, state_code FROM zipcodes UNION ALL SELECT state_code, state_code FROM zipcodes)
), t AS (
  SELECT *, row_number() OVER (PARTITION BY asset_id, valid_from ORDER BY recorded_at DESC NULLS LAST, valid_to DESC NULLS LAST) AS rn,
    regexp_replace(replace(replace(replace(replace(regexp_replace(lower(bundesland),'^\s*de\s*[-_]\s*',''),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss'),'[^a-z0-9]','','g') AS sp,
    regexp_replace(lower(gewerk_group),'[^a-z0-9]','','g') AS g
  FROM asset_states
), s AS (
  SELECT t.asset_id, t.valid_from, t.valid_to, coalesce(g,'<null>') AS g, coalesce(codes.code, sp, '<null>') AS b FROM t LEFT JOIN codes ON sp = spelling WHERE rn = 1
), c AS (
  SELECT *, lag(g) OVER w AS pg, lag(b) OVER w AS pb, last_value(valid_to) OVER (PARTITION BY asset_id ORDER BY valid_from ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fin
  FROM s WINDOW w AS (PARTITION BY asset_id ORDER BY valid_from)
), v AS (SELECT * FROM c WHERE pg IS NULL OR pg <> g OR pb <> b)
SELECT asset_id, strftime(valid_from, '%Y-%m-%dT%H:%M:%SZ') AS valid_from,
  coalesce(strftime(coalesce(lead(valid_from) OVER (PARTITION BY asset_id ORDER BY valid_from), fin), '%Y-%m-%dT%H:%M:%SZ'), '') AS valid_to
FROM v
"""

QUERIES = {"p4_found": p4_found}
ORACLE = {"p4_found": _P4_SQL}

"""Verification of signed observations: status of every row, and the counts of a vault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical_json import canonical_json, verified
from ..sources.tables import bounded_broadcast

#: Public keys of collectors are a hand-kept list; a longer one is joined by a shuffle.
MAX_KEYS = 100_000


def signed_digest(observation: Column) -> Column:
    """SHA-256 in hex over the canonical form of an observation's JSON; null where it can't be read."""
    return F.sha2(canonical_json(observation), 256)


def verification_status(rows: DataFrame, keys: DataFrame, observation: str = "obs_json", signature: str = "signature", key_id: str = "signing_key_id") -> DataFrame:
    """Adds ``status``: valid, invalid, parse_error (JSON that can't be read or is null) or unknown_key, which goes first.

    ``keys``: (key_id, public_key in hex). Ed25519 runs in plain Python, some
    hundreds a second and core, so each distinct (observation, signature, key)
    is verified once, whatever the number of its copies. A null signature is
    invalid, a null key id unknown.
    """
    known = keys.select(F.col("key_id").alias("_k"), F.col("public_key").alias("_pub")).dropDuplicates(["_k"])
    parts = [observation, signature, key_id]
    told = rows.select(*parts).distinct().join(bounded_broadcast(known, MAX_KEYS), F.col(key_id) == F.col("_k"), "left")
    readable = F.col(observation).isNotNull() & F.expr(f"try_parse_json(`{observation}`) is not null")
    digest = signed_digest(F.when(readable, F.col(observation)))
    status = F.when(F.col("_pub").isNull(), "unknown_key").when(~readable, "parse_error").when(F.coalesce(verified(digest, F.col(signature), F.col("_pub")), F.lit(False)), "valid").otherwise("invalid")
    told = told.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(parts)], status.alias("status"))
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(parts)]
    return rows.join(told, same[0] & same[1] & same[2]).drop("_0", "_1", "_2")


def verification_counts(rows: DataFrame) -> DataFrame:
    """(total, valid, invalid, parse_errors, unknown_key, rate): unreadable rows and unknown keys are invalid too."""
    n = lambda s: F.count_if(F.col("status") == s)
    total = F.count("*")
    return rows.agg(
        total.alias("total"), n("valid").alias("valid"), (total - n("valid")).alias("invalid"), n("parse_error").alias("parse_errors"), n("unknown_key").alias("unknown_key"),
        F.when(total > 0, F.floor(n("valid") / total * 10000 + 0.5) / 100).alias("rate"),
    )

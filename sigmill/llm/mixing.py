"""Mixing sources to target weights by thresholds on a hash, without sorting.

Every document has a fixed hash. Tokens are summed by source and leading hash
bits; the running sums show in which bucket a source's budget ends, and only
that bucket is split by its next bits, until the border falls between two
documents. A document is drawn if its hash lies below its source's threshold,
so a larger budget only adds documents.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import cut
from ..sources.tables import bounded_broadcast

#: Bits of the hash per histogram; the hash has 60.
BITS = 10
HASH_BITS = 60
#: Rows of a table with one row per source that may be broadcast; a longer one is joined by a shuffle.
MAX_BROADCAST = 100_000
#: Vocabulary file of the tokenizer unless another path is given.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pattern by which the public tokenizer splits text before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def token_counter(spark: SparkSession, path: str):
    """A pandas UDF that counts tokens of a public byte-level BPE; null texts have none.

    The vocabulary file is sent along with the job, so that workers needn't have its path.
    """
    if os.path.exists(path):
        spark.sparkContext.addFile(path)

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import base64

        import tiktoken
        from pyspark import SparkFiles

        here = path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))
        with open(here, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for s in batches:
            yield s.map(lambda t: 0 if t is None else len(enc.encode_ordinary(t))).astype("int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(count, LongType())


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, limit) such that the tokens of ``docs`` (source, h, n_tokens) with hashes below it come as near to the
    budget (source, left) as one document allows.

    Every level sums tokens by source and bucket (aggregated before the
    shuffle), finds the bucket in which the budget ends by a running sum over
    the buckets of a source, 1,024 at most, and looks into that bucket only.
    """
    state = cut(budgets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("left").cast("double").alias("left")))
    done = None
    for level in range(HASH_BITS // BITS):
        shift = HASH_BITS - BITS * (level + 1)
        inside = docs.join(bounded_broadcast(state, MAX_BROADCAST), "source").where(F.shiftright("h", shift + BITS) == F.col("prefix"))
        hist = inside.groupBy("source", F.pmod(F.shiftright("h", shift), F.lit(1 << BITS)).alias("b")).agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"))
        upto = F.sum("t").over(Window.partitionBy("source").orderBy("b"))
        ends = hist.withColumn("upto", upto).join(state, "source").where("upto > left").groupBy("source").agg(F.min_by(F.struct("b", "t", "k", (F.col("left") - F.col("upto") + F.col("t")).alias("rest")), "b").alias("at"))
        base = F.col("prefix") * (1 << BITS) + F.coalesce("at.b", F.lit(1 << BITS))
        found = cut(state.join(ends, "source", "left").select("source", base.alias("base"), "at"))
        last = F.col("at").isNull() | (F.col("at.k") == 1) | F.lit(shift == 0)
        take = F.when(F.coalesce(F.col("at.t") - F.col("at.rest") < F.col("at.rest"), F.lit(False)), 1).otherwise(0)
        ready = found.where(last).select("source", F.shiftleft(F.col("base") + take, shift).alias("limit"))
        done = ready if done is None else done.unionByName(ready)
        state = found.where(~last).select("source", F.col("base").alias("prefix"), F.col("at.rest").alias("left"))
        if not state.limit(1).count():
            break
    return done


def plan_budgets(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, full, left): full repeats of a source, and tokens of a further partial pass.

    ``sizes``: (source, t), ``targets``: (source, target_share, max_repeats).
    Shares are taken over the sources that have tokens. Without ``total`` the
    largest mix is drawn in which every source reaches its share within its
    repeats; a larger total is cut per source at its repeats.
    """
    there = targets.join(sizes, "source").where("t > 0 and target_share > 0 and max_repeats > 0").select("source", "t", F.col("target_share").alias("share"), F.col("max_repeats").cast("long").alias("cap"))
    most = F.lit(float(total)) if total is not None else F.min(F.col("cap") * F.col("t") / F.col("share")) * F.sum("share")
    whole = there.agg(F.sum("share").alias("weight"), most.alias("total"))  # one row
    need = F.least(F.col("total") * F.col("share") / F.col("weight"), (F.col("cap") * F.col("t")).cast("double"))
    out = there.join(F.broadcast(whole)).withColumn("need", need).withColumn("full", F.least("cap", F.floor(F.col("need") / F.col("t") + 1e-12)))
    return out.select("source", "full", F.when(F.col("full") < F.col("cap"), F.greatest(F.lit(0.0), F.col("need") - F.col("full") * F.col("t"))).otherwise(0.0).alias("left"))


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(plan, report): documents with their repeats, and the shares reached.

    ``docs``: (doc_id, source, text), ``targets``: (source, target_share,
    max_repeats). Sources without target or without text are drawn not at all
    and reported with what they have. Null targets count as zero. Any number of
    sources is taken; nothing but counts of rows comes to the driver.
    """
    spark = docs.sparkSession
    known = targets.where("source is not null").groupBy("source").agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("target_share"), F.coalesce(F.max("max_repeats"), F.lit(0)).alias("max_repeats"))
    counted = cut(docs.select("doc_id", "source", token_counter(spark, tokenizer)(F.col("text")).alias("n_tokens"), F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - HASH_BITS).alias("h")))
    held = cut(counted.groupBy("source").agg(F.sum("n_tokens").alias("t")))
    budgets = cut(plan_budgets(held, known, total))
    limits = thresholds(counted, budgets.where("left > 0").select("source", "left"))
    rule = cut(budgets.join(limits, "source", "left").select("source", F.col("full").alias("_full"), F.coalesce("limit", F.lit(0)).alias("_limit")))
    plan = counted.join(bounded_broadcast(rule, MAX_BROADCAST), "source").withColumn("repeats", (F.col("_full") + F.when(F.col("h") < F.col("_limit"), 1).otherwise(0)).cast("int"))
    plan = plan.where("repeats > 0").select("doc_id", "source", "n_tokens", "repeats")
    drawn = cut(plan.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens_drawn"), F.count("*").alias("docs_drawn"), F.max("repeats").alias("most_repeats")))
    report = known.join(held.withColumnRenamed("t", "tokens_held"), "source", "full").join(drawn, "source", "left").fillna(0, ["tokens_held", "tokens_drawn", "docs_drawn", "most_repeats"])
    every = drawn.agg(F.sum("tokens_drawn").alias("_all"))  # one row
    return plan, report.join(F.broadcast(every)).select(
        "source", "target_share", "max_repeats", "tokens_held", "tokens_drawn", "docs_drawn", "most_repeats", F.when(F.col("_all") > 0, F.col("tokens_drawn") / F.col("_all")).alias("actual_share"))

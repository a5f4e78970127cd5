import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from sigmill.operators.history import fold_label, version_history

T0 = datetime(2024, 1, 1)
SCHEMA = "e string, f timestamp_ntz, t timestamp_ntz, r timestamp_ntz, a string, b string"


def brute(rows):
    last = {}
    for e, f, t, r, a, b in rows:
        if e is None or f is None:
            continue
        k = (r is not None, r or T0, t is not None, t or T0, repr(a), repr(b))
        if (e, f) not in last or k > last[e, f][0]:
            last[e, f] = (k, t, (a, b))
    out, open_ = [], {}
    for (e, f), (_, t, p) in sorted(last.items()):
        if e not in open_ or open_[e][1] != p:
            if e in open_:
                out.append((e, open_[e][0], f))
            open_[e] = (f, p, t)
        else:
            open_[e] = (open_[e][0], p, t)
    return sorted(out + [(e, f, t) for e, (f, _, t) in open_.items()], key=repr)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(3000):
        e = "hot" if rnd.random() < 0.4 else rnd.choice(["x", "y", "z", None, "w"])
        f = T0 + timedelta(days=rnd.randrange(400)) if rnd.random() < 0.98 else None
        rows.append((e, f, f + timedelta(days=30) if f and rnd.random() < 0.7 else None, T0 + timedelta(minutes=rnd.randrange(10**6)), rnd.choice(["a", "A", None, "b"]), rnd.choice(["p", None])))
    rows += rows[:200]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=list("eftrab")).astype({"f": "datetime64[us]", "t": "datetime64[us]", "r": "datetime64[us]"}), SCHEMA)
    df = df.withColumns({"payload": F.lit(1), "entity": F.lit(2), "start": F.lit(3)}).repartition(7)
    got = version_history(df, "e", "f", "t", "r", [F.col("a"), F.col("b")]).select("entity", "start", "end").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows)


def test_empty(spark):
    assert version_history(spark.createDataFrame([], SCHEMA), "e", "f", "t", "r", [F.col("a")]).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("DE-NW",), (" nw ",), ("bau_ausbau",), ("Baden-Württemberg",), (None,)], "v string")
    assert [r[0] for r in df.select(fold_label("v")).collect()] == ["nw", "nw", "bauausbau", "badenwuerttemberg", None]


def test_hot_entity_with_many_versions(spark):
    """200,000 states of one entity that change every time: no task may look at a history more than once."""
    n = 200_000
    df = spark.range(n).select(
        F.lit("hot").alias("e"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("f"), F.expr("timestamp_ntz'9999-12-31'").alias("t"),
        F.lit(None).cast("timestamp_ntz").alias("r"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("a"),
    ).repartition(6)
    got = version_history(df, "e", "f", "t", "r", [F.col("a")])
    row = got.agg(F.count("*").alias("n"), F.count_if("is_last").alias("last"), F.count_if(F.col("end") == F.col("start") + F.expr("interval 1 second")).alias("steps"), F.max("end").alias("end")).first()
    assert (row["n"], row["last"], row["steps"], row["end"]) == (n, 1, n - 1, datetime(9999, 12, 31))


def test_versions_across_ranges(spark):
    """One version over all ranges, and one that ends in the middle."""
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") < n - 3, "x").otherwise("y").alias("e"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("f"), F.lit(None).cast("timestamp_ntz").alias("t"),
        F.lit(None).cast("timestamp_ntz").alias("r"), F.when(F.col("id") < n - 9, "a").otherwise("b").alias("a"),
    ).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = version_history(df, "e", "f", "t", "r", [F.col("a")]).orderBy("entity", "start").select("entity", "payload", "is_last").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [tuple(r) for r in got] == [("x", "a", False), ("x", "b", True), ("y", "b", True)]

import math
import random

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from sigmill.llm.mixing import mix, plan_budgets, thresholds
from sigmill.llm.quantiles import compress, exact, merge, merged, percentiles, summaries, value_at


def ranks_hold(s, data):
    d = np.sort(data)
    for v, lo, hi in zip(*s):
        first, last = np.searchsorted(d, v, "left") + 1, np.searchsorted(d, v, "right")
        assert lo <= last and hi >= first


def test_merge_and_bound():
    rnd = np.random.default_rng(0)
    parts = [rnd.integers(0, 50, 700).astype(float), rnd.normal(size=900), np.full(300, 7.0), np.array([]), np.array([1.0])]
    s, n = (np.array([]),) * 3, 0
    s = exact(np.array([]))
    for p in parts:
        n += len(p)
        s = compress(merge(s, compress(exact(p), len(p), 0.01)), n, 0.01)
    data = np.concatenate(parts)
    ranks_hold(s, data)
    d = np.sort(data)
    for p in (0.0, 0.01, 0.25, 0.5, 0.9, 1.0):
        v, err = value_at(s, n, p)
        r = max(1, math.ceil(p * n))
        lo, hi = np.searchsorted(d, v, "left") + 1, np.searchsorted(d, v, "right")
        assert max(0, lo - r, r - hi) <= err <= 0.06 * n
    assert len(s[0]) < 400


def test_grouped(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.5 else rnd.choice("abc"), str(rnd.randrange(90)), rnd.choice([None, float("nan"), rnd.gauss(0, 1), 5.0])) for _ in range(6000)] + [(None, "1", 1.0)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["group", "part", "value"]), "group string, part string, value double").repartition(9)
    for eps in (1e-4, 0.02):
        got = percentiles(merged(summaries(df, eps), eps), [0.1, 0.5, 0.9]).collect()
        assert {r.group for r in got} == {"hot", "a", "b", "c"}
        for r in got:
            d = sorted(v for g, _, v in rows if g == r.group and v is not None and v == v)
            want = max(1, math.ceil(r.p * len(d) - 1e-9))
            lo, hi = np.searchsorted(d, r.value, "left") + 1, np.searchsorted(d, r.value, "right")
            assert r.n == len(d) and max(0, lo - want, want - hi) <= r.rank_error <= 4 * eps * len(d) + 1
    assert merged(summaries(df.limit(0))).count() == 0


def test_budgets(spark):
    def plan(sizes, targets, total=None):
        got = plan_budgets(spark.createDataFrame(sizes, "source string, t long"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), total).collect()
        return {r.source: (r.full, r.left) for r in got}

    assert plan([("a", 100), ("b", 50)], [("a", 0.5, 1), ("b", 0.5, 3), ("c", 0.2, 2)]) == {"a": (1, 0.0), "b": (2, 0.0)}
    assert plan([], [("a", 1.0, 1)]) == {} and plan([("a", 10)], [("a", 0.0, 1)]) == {}
    assert plan([("a", 100), ("b", 50)], [("a", 0.5, 1), ("b", 0.5, 1)], 500.0) == {"a": (1, 0.0), "b": (1, 0.0)}


def test_thresholds_for_many_sources(spark):
    """More sources than any list on the driver should hold; every one comes as near to its budget as one document allows."""
    docs = spark.range(60_000).selectExpr("concat('s', id % 6000) AS source", "shiftrightunsigned(xxhash64(id), 4) AS h", "id % 7 + 1 AS n_tokens")
    budgets = docs.groupBy("source").agg((F.sum("n_tokens") * 0.4).alias("left"))
    got = docs.join(thresholds(docs, budgets), "source").groupBy("source").agg(F.sum(F.when(F.col("h") < F.col("limit"), F.col("n_tokens")).otherwise(0)).alias("t"))
    off = got.join(budgets, "source").agg(F.count("*").alias("k"), F.max(F.abs(F.col("t") - F.col("left"))).alias("d")).first()
    assert off["k"] == 6000 and off["d"] <= 3.5


def test_mix(spark):
    docs = [(i, "abc"[i % 3] if i % 7 else "big", "wort " * (i % 40 + 1)) for i in range(900)] + [(900, None, "x"), (901, "a", None), (902, "a", ""), (903, "zz", "ohne ziel")]
    targets = [("a", 0.5, 2), ("b", 0.2, 1), ("big", 0.2, 4), ("none", 0.1, 3), (None, 0.3, 1)]
    plan, report = mix(spark.createDataFrame(docs, "doc_id long, source string, text string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"))
    r = {x.source: x for x in report.collect()}
    cap = {s: c for s, _, c in targets}
    assert all(x.repeats <= cap[x.source] for x in plan.collect()) and r["none"].tokens_drawn == 0 and r["zz"].tokens_drawn == 0
    for s, share in (("a", 5 / 9), ("b", 2 / 9), ("big", 2 / 9)):
        assert abs(r[s].actual_share - share) < 0.01
    small, _ = mix(spark.createDataFrame(docs, "doc_id long, source string, text string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), 3000)
    more, _ = mix(spark.createDataFrame(docs, "doc_id long, source string, text string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), 5000)
    assert {x.doc_id for x in small.collect()} <= {x.doc_id for x in more.collect()}
    empty, rep = mix(spark.createDataFrame([], "doc_id long, source string, text string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"))
    assert empty.count() == 0 and rep.count() == 4


def test_large_groups_by_days_are_compressed_and_stay_within_their_error(spark):
    n, eps = 120_000, 1e-3
    df = spark.range(n).selectExpr("if(id % 3 = 0, 'small', 'hot') AS group", "cast(id % 400 AS string) AS part", "cast(pmod(id * 7919, 100003) AS double) AS value").repartition(6)
    parts = summaries(df, eps)
    got = percentiles(merged(parts, eps), [0.01, 0.25, 0.5, 0.9]).collect()
    data = {"small": [], "hot": []}
    for i in range(n):
        data["small" if i % 3 == 0 else "hot"].append(float(i * 7919 % 100003))
    assert len(got) == 8 and any(r.rank_error > 0 for r in got)
    for r in got:
        d = sorted(data[r.group])
        want = max(1, math.ceil(r.p * len(d) - 1e-9))
        lo, hi = np.searchsorted(d, r.value, "left") + 1, np.searchsorted(d, r.value, "right")
        assert r.n == len(d) and max(0, lo - want, want - hi) <= r.rank_error <= 4 * eps * len(d) + 1

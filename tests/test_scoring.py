import pytest
from pyspark.sql import functions as F

from sigmill.functions.num import js_round
from sigmill.functions.rules import RULES, missing_policy
from sigmill.operators.codebook import check_codebook, dimensions, same_major, scores, traces

BOOL, ZERO, SKIP = {"type": "bool"}, {"kind": "zero"}, {"kind": "skip"}
BOOK = {"id": "t", "version": "1.0.0", "dimensions": [
    {"id": "compliance", "weight": 0.4, "indicators": [
        {"id": "a", "inputKey": "imp", "weight": 0.6, "rule": BOOL, "missing": ZERO}, {"id": "b", "inputKey": "dat", "weight": 0.4, "rule": BOOL, "missing": ZERO}]},
    {"id": "contactability", "weight": 0.4, "indicators": [
        {"id": "p", "inputKey": "phones", "weight": 0.5, "rule": {"type": "countClamp", "min": 0, "max": 3}, "missing": ZERO},
        {"id": "m", "inputKey": "mails", "weight": 0.3, "rule": {"type": "countClamp", "min": 0, "max": 2}, "missing": ZERO},
        {"id": "o", "inputKey": "hours", "weight": 0.2, "rule": {"type": "presence"}}]},
    {"id": "digital", "weight": 0.2, "indicators": [
        {"id": "c", "inputKey": "cookie", "weight": 0.4, "rule": BOOL, "missing": SKIP},
        {"id": "d", "inputKey": "meta", "weight": 0.6, "rule": {"type": "bool", "trueScore": 100, "falseScore": 50}, "missing": {"kind": "impute", "imputedScore": 50}}]},
    {"id": "self_report", "weight": 0.2, "indicators": [{"id": "x", "inputKey": "absent", "weight": 1.0, "rule": BOOL, "missing": SKIP}]},
]}
SCHEMA = "site long, imp boolean, dat boolean, phones long, mails long, hours string, meta boolean, cookie boolean"


def test_three_sites(spark):
    rows = [(1, True, True, 3, 2, "Mo-Fr", True, True), (2, True, False, 1, 0, None, False, False), (3, False, False, 0, 0, None, None, None)]
    w = scores(spark.createDataFrame(rows, SCHEMA), BOOK, "site")
    got = {(r.site, r.dimension): (r.score, r.effective_weight, r.confidence) for r in dimensions(w, BOOK, "site").collect()}
    assert [got[1, d][0] for d in ("compliance", "contactability", "digital")] == [100, 100, 100]
    assert [got[2, d][0] for d in ("compliance", "contactability", "digital")] == [60, 16.67, 30]
    assert [got[3, d][0] for d in ("compliance", "contactability", "digital")] == [0, 0, 50]
    assert got[3, "digital"][1:] == (0.12, 0.5) and got[1, "self_report"][0] is None
    over = {r.site: (r.overall, r.confidence) for r in w.collect()}
    assert over[1] == (100, 1)
    t = {(r.site, r.indicator): (r.score, r.confidence, r.note) for r in traces(spark.createDataFrame(rows, SCHEMA), BOOK, "site").collect()}
    assert t[3, "c"] == (None, 0.0, "missing: skip")


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", overall double, _j0 int, score double")
    assert scores(df, BOOK, "site").count() == 0


@pytest.mark.parametrize("rule,spec,value,want,err", [
    ("bool", {}, "true", 100, False), ("bool", {}, "1", 100, False), ("bool", {}, "0", 0, False), ("bool", {}, "maybe", None, True),
    ("presence", {}, "Mo-Fr 08-18", 100, False), ("presence", {}, "   ", 0, False), ("presence", {}, None, 0, False),
    ("countClamp", {"min": 0, "max": 3}, "5", 100, False), ("countClamp", {"min": 0, "max": 3}, "-1", 0, False), ("countClamp", {"min": 0, "max": 3}, "1.5", 50, False),
    ("countClamp", {"min": 0, "max": 3}, "NaN", None, True), ("countClamp", {"min": 0, "max": 3}, "oops", None, True),
    ("countClamp", {"min": 0, "max": 10, "scoreAtMin": 40, "scoreAtMax": 80}, "5", 60, False),
    ("countClampInverse", {"min": 0, "max": 5}, "2.5", 50, False), ("countClampInverse", {"min": 0, "max": 5}, "8", 0, False), ("countClampInverse", {"min": 0, "max": 10, "scoreAtMin": 90, "scoreAtMax": 30}, "5", 60, False),
    ("enum", {"cases": {"A": 100, "B": 60}, "defaultScore": 0}, "B", 60, False), ("enum", {"cases": {"A": 100}, "defaultScore": 0}, "Z", 0, False), ("enum", {"cases": {"A": 100}, "defaultScore": 0}, None, 0, False),
])
def test_rules(spark, rule, spec, value, want, err):
    s, e = RULES[rule](F.col("v"), spec)
    r = spark.createDataFrame([(value,)], "v string").select(s.alias("s"), F.coalesce(e, F.lit(False)).alias("e")).first()
    assert (r.s, r.e) == (want, err)


def test_conditional_policy(spark):
    p = {"kind": "conditional", "states": {"absent": "zero", "unreachable": "exclude", "not_applicable": "skip"}, "default": "zero"}
    s, c, w = missing_policy(p, F.col("st"))
    rows = spark.createDataFrame([(x,) for x in (None, "absent", "unreachable", "not_applicable", "other")], "st string").select(s.alias("s"), c.alias("c"), w.alias("w")).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1), (0, 1, 1), (None, 0, 0), (None, 0, 0), (0, 1, 1)]


def test_rounding_and_checks(spark):
    assert spark.range(1).select(js_round(F.lit(1.005))).first()[0] == 1.0
    assert check_codebook(BOOK) == []
    bad = {"version": "1", "dimensions": [{"id": "a", "weight": 1, "indicators": [{"id": "i", "weight": 0, "inputKey": "k", "rule": {"type": "countClamp", "min": 3, "max": 3}}]}] * 2}
    assert len(check_codebook(bad)) == 6 and same_major("1.2.3", "1.0.0") and not same_major("1.2.3", "2.0.0")

from sigmill.llm.linkage import MISSING, START, firm_level, firm_words, fit_levels, posterior, score_pairs
from pyspark.sql import functions as F

from sigmill.llm.survivor import align, closest_value, code_form, consensus, establishments, name_form

RECORD = "group string, value string, rank int, time long, whole boolean"


def scored(spark, rows, form=name_form):
    df = spark.createDataFrame(rows, RECORD).repartition(4)
    return consensus(df.select("group", "value", form(F.col("value")).alias("form"), (1 / (F.lit(1.0) + F.col("rank"))).alias("w"), F.struct("rank", -F.col("time")).alias("trust"), "whole"))


def test_alignment_and_consensus(spark):
    assert align(["a", "b", "c"], ["a", "c"]) == [(0, 0), (1, -1), (2, 1)]
    assert align([], ["x"]) == [(-1, 0)] and align([], []) == []
    rows = [("g", v, 1, 0, True) for v in ("Holzbau Müller GmbH", "Holzbau Müller GmbH", "Holzbau Mueler GmbH", "Holzbau Mül", "Firma Holzbau Müller", "", None)] + [("h", "Solo", 2, 0, True), ("h", "Solo", 3, 0, True)]
    s = scored(spark, rows)
    best = {r.group: r.value for r in closest_value(s).collect()}
    assert best == {"g": "Holzbau Müller GmbH", "h": "Solo"}
    marks = {r.value: r.cut_short for r in s.collect()}
    assert marks["Holzbau Mül"] and not marks["Holzbau Müller GmbH"] and not marks["Firma Holzbau Müller"]
    assert consensus(spark.createDataFrame([], "group string, value string, form string, w double, trust struct<a:int>, whole boolean")).count() == 0


def test_trust_outweighs_numbers_but_not_damage(spark):
    many = [("g", "Bau Schmidt GmbH", 5, t, True) for t in range(300)]
    rows = many + [("g", "Bau Schmitt", 2, 1, True), ("g", "Bau Schmitt OHG", 2, 7, True), ("g", "Bau Schm", 1, 0, True), ("g", "Bau Sch?midt", 0, 9, False)]
    rows += [("all damaged", "Ma?er", 1, 1, False), ("all damaged", "M?ller", 2, 1, False)]
    rows += [("spellings", "MALER KURZ", 3, 1, True), ("spellings", "Maler  Kurz", 1, 1, True), ("spellings", "maler-kurz", 1, 2, True)]
    s = scored(spark, rows)
    assert {r.group: r.value for r in closest_value(s, "trusted").collect()} == {"g": "Bau Schmitt OHG", "spellings": "maler-kurz"}
    assert {r.group: r.value for r in closest_value(s).collect()}["g"] == "Bau Schmidt GmbH"


def test_codes_and_long_insertions(spark):
    rows = [("p", "01234", 3, 1, True), ("p", "01234", 3, 2, True), ("p", "98765", 1, 1, True)]
    assert [r.value for r in closest_value(scored(spark, rows, code_form), "trusted").collect()] == ["98765"]
    # More than a hundred tokens inserted at one place keep columns of their own.
    tail = " ".join(f"wort{i}" for i in range(150))
    rows = [("g", "Bau Kurz", 1, 1, True)] * 3 + [("g", f"Bau {tail} Kurz", 1, 1, True)] * 2
    s = {r.value: r.closeness for r in scored(spark, rows).collect()}
    assert s["Bau Kurz"] == 1.0 and s[f"Bau {tail} Kurz"] < 0.1


def test_tokens_without_letters(spark):
    assert scored(spark, [("g", "!!!", 1, 1, True), ("g", "###", 1, 1, True), ("g", "y" * 20_000, 1, 1, True)]).count() == 1


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_steps_shuffle_no_more_than_they_must(spark):
    # Every exchange is a job, a thread and a plan that the driver holds.
    rows = spark.createDataFrame([(1, 1, "p1", "b1", "t1")], "id long, site_id long, phone string, building string, town string")
    assert exchanges(establishments(rows)) <= 8
    assert exchanges(scored(spark, [("g", "Bau Kurz", 1, 1, True), ("g", "Bau Kunz", 2, 1, True)])) <= 12


def test_establishments(spark):
    rows = [(1, 1, "p1", "b1", "t1"), (2, 1, None, "b1", None), (3, 1, None, None, "t2"), (4, 1, "p2", "b2", "t2"), (5, 2, None, None, None), (6, 2, "p3", None, None), (7, 3, None, "b7", "t7"), (8, 3, None, None, "t7"), (9, 1, None, None, None)]
    got = {r.id: r.group for r in establishments(spark.createDataFrame(rows, "id long, site_id long, phone string, building string, town string")).collect()}
    assert got[1] == got[2] and got[3] == got[4] and got[5] == got[6] and got[7] == got[8] and got[9] not in (got[1], got[3])
    assert len(got) == len(rows)


def test_em_separates(spark):
    order = list(START)
    match, other = (2, 2, 3, 1), (0, 0, 1, 0)
    patterns = [(match, 500), ((2, MISSING, 3, MISSING), 100), (other, 3000), ((0, 2, 0, MISSING), 60), ((MISSING,) * 4, 5)]
    share, prob = fit_levels(patterns, [START[n] for n in order])
    assert posterior(match, share, prob) > 0.99 and posterior(other, share, prob) < 0.01 and posterior((0, 2, 0, MISSING), share, prob) < 0.9
    df = spark.createDataFrame([(*p, i) for i, (p, _) in enumerate(patterns)], ", ".join(f"{n} int" for n in order) + ", id int")
    assert score_pairs(df).count() == len(patterns) and score_pairs(df.limit(0)).count() == 0


def test_firm_levels(spark):
    rows = [("Müller Holzbau GmbH", "Holzbau Mueller Inh. A. Müller", 3), ("Müller Holzbau", "Bäckerei Schmidt", 0), (None, "x y", MISSING), ("Firma", "abc", MISSING), ("Holzbau Schmidt", "Holzbau Müller", 1)]
    df = spark.createDataFrame(rows, "a string, b string, want int").select(firm_words("a").alias("x"), firm_words("b").alias("y"), "want")
    assert all(r.got == r.want for r in df.select(firm_level("x", "y").alias("got"), "want").collect())

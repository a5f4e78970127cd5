import pytest
from pyspark.sql import functions as F

from sigmill.functions import strings as S
from sigmill.operators import cohorts as C
from sigmill.operators import observations as O
from sigmill.operators import upserts as U


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(col).first()[0]


@pytest.mark.parametrize("url,host", [
    ("https://www.Beispiel.de/x?y#z", "beispiel.de"), ("beispiel.de", "beispiel.de"), ("http://a.b.example:8080/", "a.b.example"), ("192.168.1.1", None), ("localhost", None), ("", None), ("kein wort", None), (None, None),
])
def test_domains(spark, url, host):
    assert one(spark, S.normalise_domain("v"), url) == host


def test_text_functions(spark):
    assert one(spark, S.trim_all("v"), "\t a b \n") == "a b"
    assert one(spark, S.registrable_domain("v"), "https://shop.firma.co.uk/") == "firma.co.uk"
    assert one(spark, S.slug("v"), "Müller & Söhne GmbH") == "mueller-soehne-gmbh"
    assert one(spark, S.first_keyword("v", ["agb", "impressum"]), "/Im-pressum/AGB") == "agb"
    assert one(spark, S.is_stop_domain("v", ["x.test"]), "a.x.test") is True
    assert one(spark, S.previous_period("v"), "2025-q1") == "2024-q4" and one(spark, S.previous_period("v"), "2025q1") is None
    assert one(spark, S.strip_json_fence("v"), "so: ```json\n{\"a\":1}\n```") == '{"a":1}'
    assert one(spark, S.normalise_page_url("v"), "HTTPS://Ex.de#top") == "https://ex.de/"


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), (None, 1, "n")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 2, "z"), ("c", 1, "w"), ("c", 3, "u")], "k string, t int, v string")
    assert {tuple(r) for r in U.upsert(old, new, ["k"], ["t"]).collect()} == {("a", 2, "z"), ("b", 1, "y"), (None, 1, "n"), ("c", 3, "u")}
    assert {r.v for r in U.insert_ignore(old, new, ["k"], [F.col("t")]).collect()} == {"x", "y", "n", "w"}
    assert {r.v for r in U.replace_all(old, new, ["k"]).collect()} == {"z", "w", "u", "y", "n"}
    assert U.upsert(old.limit(0), new.limit(0), ["k"], ["t"]).count() == 0


def test_validation_codes(spark):
    onto = spark.createDataFrame([("a.b", "num", False), ("a.old", "num", True)], "signal_path string, value_type string, deprecated boolean")
    rows = [(1, "a.b", "num", None, 0.0, None, None), (2, "a.c", "num", None, 1.0, None, None), (3, "a.old", "num", None, 1.0, None, None), (4, "a.b", "str", None, None, "x", None), (5, "a.b", "num", True, 1.0, None, None), (6, "a.b", "num", None, None, None, None), (7, "A B", "num", None, 1.0, None, None), (8, None, "num", None, 1.0, None, None)]
    df = spark.createDataFrame(rows, "id int, signal_path string, value_type string, value_bool boolean, value_num double, value_str string, value_json string")
    got = {r.id: r.issues for r in O.issues(df, onto).collect()}
    assert got == {1: [], 2: ["unknown_signal"], 3: ["deprecated_signal"], 4: ["value_type_mismatch"], 5: ["multiple_values_populated"], 6: ["no_value_populated"], 7: ["invalid_path_format", "unknown_signal"], 8: ["invalid_path_format", "unknown_signal"]}


def test_bands_and_privacy(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 20.0), ("a", 100.0), (None, 59.9), (None, None), ("b", 80.0)], "g string, x double")
    assert {r.band: r.n for r in C.bands(df, "x").collect()} == {"0-20": 1, "20-40": 1, "40-60": 1, "60-80": 0, "80-100": 2}
    assert sorted(r.x for r in C.k_filter(df, ["g"], 3).collect()) == [0.0, 20.0, 100.0]
    assert {r.n for r in C.bands(df.limit(0), "x").collect()} == {0}
    assert {(r.g, r.suppressed) for r in C.k_report(df, ["g"], 3).collect()} == {("a", False), ("b", True), (None, True)}


def test_period_series(spark):
    df = spark.createDataFrame([("g", "2024-q1", 10.0)] * 6 + [("g", "2024-q2", 20.0)] * 6 + [("h", "2024-q2", 5.0)] * 2, "k string, p string, v double")
    got = {(r.k, r.p): (r.delta, r.reasons, r.reliability) for r in C.period_series(df, "k", "p", "v").collect()}
    assert got["g", "2024-q1"] == (None, "no_previous_period", "suppressed")
    assert got["g", "2024-q2"] == (10.0, "", "caution")
    assert got["h", "2024-q2"][1] == "no_previous_period"

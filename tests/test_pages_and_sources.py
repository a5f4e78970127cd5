import sqlite3

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sigmill.functions.page_signals import page_signals, signals
from sigmill.sources import bundles as B
from sigmill.streaming.ingest import read_arriving, read_state, start_upserts, tumbling_counts

PAGE = """<html lang="de"><head><title>Bau</title><meta name="description" content="Gut"><script type="application/ld+json">{"@graph":[{"@type":"Store"},{"@type":["FAQPage"]}],"openingHours":["Mo 8-17"]}</script></head>
<body><div id="cookie-banner"><button>Ablehnen</button><button>OK</button></div><a href="/impressum">Impressum</a><a href="/Team">Unser Team</a><a href="https://www.facebook.com/x">f</a>
<form action="/kontakt"></form><iframe src="https://www.google.com/maps/embed"></iframe><h1>Hallo</h1>Preisliste. Dienstleistungen. Meisterbetrieb Tel 0711 1234567 a@b.de<footer>© 2019 - 2023</footer></body></html>"""


def test_page():
    got = {s[0]: s[1:] for s in signals(PAGE, "https://bau.example/", 2024)}
    assert len(got) == 49
    assert got["legal.impressum.present"] == (True, "https://bau.example/impressum", 90, None) and got["legal.agb.present"][0] is False
    assert got["structured_data.schema_org.local_business.present"][0] and got["structured_data.schema_org.faq.present"][0] and not got["structured_data.schema_org.product.present"][0]
    assert got["content.opening_hours.present"] == (True, None, 90, "Mo 8-17") and got["content.map.present"][2] == 95 and got["contact.form.present"][2] == 85
    assert got["privacy.consent.banner.present"][3] == "reject_equal_prominence" and got["content.copyright.year"][3] == "2023"
    assert not got["trust.awards.present"][0] and not got["trust.certifications.present"][0] and got["trust.certification.meister.present"][0]
    assert got["social.facebook.present"][1] == "https://www.facebook.com/x" and got["contact.emails"][3] == "a@b.de" and got["contact.phones"][3] == "+497111234567"
    assert not any(s[1] for s in signals(None, None, 2024)) and signals("<a <<< b", None, 2024)


def test_pages(spark):
    df = spark.createDataFrame([(1, PAGE, "https://x.example/", "clash"), (2, None, None, None), (3, "", None, None), (4, "<p>" + "w " * 50_000, None, None)], "id long, html string, url string, value string")
    out = page_signals(df, "id", "html", "url", 2024)
    assert out.where("present").select("id").distinct().count() == 1 and out.groupBy("id").count().select("count").distinct().count() == 1
    assert page_signals(df.limit(0), "id", "html", "url", 2024).count() == 0


def test_bundle(spark, tmp_path):
    df = spark.createDataFrame([("b", 2.0), ("a", None)], "id string, v double")
    m = B.write_bundle(df, str(tmp_path / "b"), ["id"], {"run_id": "r"})
    assert m["observation_count"] == 2 and [r.id for r in B.read_bundle(spark, str(tmp_path / "b"), "id string, v double").collect()] == ["a", "b"]
    f = tmp_path / "b" / "observations.ndjson"
    f.write_text(f.read_text() + "{}\n")
    with pytest.raises(ValueError):
        B.read_bundle(spark, str(tmp_path / "b"), "id string, v double")


def test_vault_csv_sqlite_blobs(spark, tmp_path):
    df = spark.createDataFrame([("r1", 2024, "x"), ("r2", 2025, "y"), ("r2", 2025, "x")], "run string, y int, v string")
    v = str(tmp_path / "v")
    assert B.write_vault(df, v, "y", "run", "r1") and B.write_vault(df, v, "y", "run", "r2") and not B.write_vault(df, v, "y", "run", "r2")
    assert spark.read.parquet(v).where("year = 2025").count() == 2
    assert B.new_blobs(df, "v", None).count() == 2 and B.new_blobs(df, "v", B.new_blobs(df.limit(1), "v", None)).count() == 1
    B.write_csv(df.select("v"), str(tmp_path / "c"), {"v": "Wert"})
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["Wert"]
    p = tmp_path / "in.csv"
    p.write_text("Name, Stra�e ,Web\n a , x 1 ,\n,,\n", encoding="utf-8")
    assert [tuple(r) for r in B.read_catalog_csv(spark, str(p), ["Name", "Straße", "Fehlt"]).collect()][0] == ("a", "x 1", None)
    con = sqlite3.connect(tmp_path / "d.db")
    con.execute("CREATE TABLE t (a INTEGER, b TEXT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, f"w{i}") for i in range(50)])
    con.commit()
    con.close()
    assert B.read_sqlite(spark, str(tmp_path / "d.db"), "SELECT a, b FROM t", "a long, b string", ["a < 20", "a >= 20"]).agg(F.sum("a")).first()[0] == sum(range(50))


def test_charset(spark):
    raw = [("<meta charset=iso-8859-1>é€".encode("cp1252"),), ("ä".encode(),)]
    assert [r[0][-2:] for r in spark.createDataFrame(raw, "c binary").select(B.decode_html(F.col("c"))).collect()] == ["é€", "ä"]


def test_stream(spark, tmp_path):
    src, schema = str(tmp_path / "s"), "k string, t long, v string"
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema).write.parquet(src)
    run = lambda: start_upserts(read_arriving(spark, src, schema), str(tmp_path / "o"), str(tmp_path / "c"), ["k"], ["t"]).awaitTermination()
    run()
    spark.createDataFrame([("a", 2, "z"), ("a", 0, "old")], schema).write.mode("append").parquet(src)
    run()
    assert {tuple(r) for r in read_state(spark, str(tmp_path / "o"), schema).collect()} == {("a", 2, "z"), ("b", 1, "y")}
    # A ledger that can't be read stops the stream and loses nothing.
    ledger = next((tmp_path / "o" / "ledger").glob("*.parquet"))
    whole = ledger.read_bytes()
    for f in (tmp_path / "o" / "ledger").glob(".*.crc"):
        f.unlink()
    ledger.write_bytes(b"broken")
    spark.createDataFrame([("c", 1, "n")], schema).write.mode("append").parquet(src)
    with pytest.raises(StreamingQueryException):
        run()
    ledger.write_bytes(whole)
    run()
    assert {tuple(r) for r in read_state(spark, str(tmp_path / "o"), schema).collect()} == {("a", 2, "z"), ("b", 1, "y"), ("c", 1, "n")}
    ev = spark.createDataFrame([("2024-01-01 00:10:00", "e"), ("2024-01-01 00:50:00", "e"), ("2024-01-01 01:00:00", "e")], "ts string, k string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted(r.n for r in tumbling_counts(ev, "ts", "k", "1 hour", "10 minutes").collect()) == [1, 2]

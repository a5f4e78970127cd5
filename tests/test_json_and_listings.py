import hashlib

import pytest
from pyspark.sql import functions as F

from sigmill.functions.canonical_json import canonical, canonical_json, js_number, pruned, pruned_json, public_key, sign, uuid7, verified, verify
from sigmill.sources.listings import parse_listing, parse_pages


@pytest.mark.parametrize("x,text", [(0.0, "0"), (-0.0, "0"), (1.0, "1"), (0.1, "0.1"), (1e21, "1e+21"), (1e20, "100000000000000000000"), (1.5e-7, "1.5e-7"), (0.000001, "0.000001"), (-123.45, "-123.45"), (5e-324, "5e-324"), (333333333.33333329, "333333333.3333333"), (2**60, "1152921504606847000"), (100, "100")])
def test_numbers(x, text):
    assert js_number(x) == text


def test_canonical_and_pruned(spark):
    assert canonical({"b": [1.0, None, True], "a": "é\n", "ä": {}}) == '{"a":"é\\n","b":[1,null,true],"ä":{}}'
    with pytest.raises(ValueError):
        js_number(float("nan"))
    assert pruned({"a": 0, "b": [None, {"c": ""}], "d": [1, False]}) == {"d": [1]} and pruned([]) is None
    df = spark.createDataFrame([('{"b":1.0,"a":null}',), ("no json",), (None,)], "j string")
    assert [tuple(r) for r in df.select(canonical_json("j"), pruned_json("j")).collect()] == [('{"a":null,"b":1}', '{"b":1}'), (None, None), (None, None)]


def test_uuid7():
    u = uuid7(0x0123456789AB, bytes(10))
    assert u == "01234567-89ab-7000-8000-000000000000"


def test_ed25519_rfc_vector(spark):
    key = bytes.fromhex("9d61b19deffd5a60ba844af492ec2cc44449c5697b326919703bac031cae7f60")
    pub = bytes.fromhex("d75a980182b10ab7d54bfed3c964073a0ee172f3daa62325af021a68f707511a")
    sig = "e5564300c360ac729086e2cc806e828a84877f1eb8e5d974d873e065224901555fb8821590a33bacc61e39701cf9b46bd25bf5f0595bbe24655141438e7a100b"
    assert public_key(key) == pub and sign(key, b"").hex() == sig and verify(pub, b"", bytes.fromhex(sig)) and not verify(pub, b"x", bytes.fromhex(sig))
    d = hashlib.sha256(b"row").hexdigest()
    good = sign(key, bytes.fromhex(d)).hex()
    rows = [(d, good, pub.hex()), (d, good[:-2] + "00", pub.hex()), (d, "zz", pub.hex()), (None, good, pub.hex())]
    got = spark.createDataFrame(rows, "d string, s string, k string").select(verified(F.col("d"), F.col("s"), F.col("k"))).collect()
    assert [r[0] for r in got] == [True, False, False, None]


def test_listings(spark):
    html = """<script type="application/ld+json">{"@graph":[{"@type":"LocalBusiness","name":"A","address":{"streetAddress":"Weg 1","postalCode":"01234","addressLocality":"Ort"}}]}</script>
    <div itemscope itemtype="http://schema.org/LocalBusiness"><h2 itemprop="name">B &amp; Co</h2><span itemprop="telephone">0711</span><a itemprop="url" href="https://b.example">x</a></div><div class="vcard"><b class="fn">C</b></div><p class="fn">no</p>"""
    assert [r["business_name"] for r in parse_listing(html)] == ["A", "B & Co", "C"]
    df = spark.createDataFrame([("cat/a.html", html), ("other/b.html", None), ("x/c.html", "<<<"), ("own/d.html", "k;v")], "p string, h string")
    out = parse_pages(df, "p", "h", {"own": lambda h: [{"business_name": h}]}).collect()
    assert {(r.source_item_key, r.business_name, r.website_url) for r in out} == {("cat/a.html#1", "A", None), ("cat/a.html#2", "B & Co", "https://b.example"), ("cat/a.html#3", "C", None), ("own/d.html#1", "k;v", None)}

import itertools

from pyspark.sql import functions as F

from sigmill.llm.address import address_classes, locate, pairs_within, parse_address, postcode

SCHEMA = "id long, site_id long, street_address string, postal_code string, city string"


def zips(spark):
    return spark.createDataFrame([("01234", "Ammerburg"), ("54321", "Bad Weidenthal")], "zipcode string, place string")


def filler():
    kinds = ["weg", "platz", "ring", "allee", "ufer"]
    return [(1000 + i, 500 + i, f"{s}{k} {100 + i}", "01234", "Ammerburg") for i, (s, k) in enumerate(itertools.product(["Lindenbach", "Lindenfeld", "Müllerwald", "Färber"], kinds))]


SAME = [
    ("Lindenbachweg 7", "01234", "Ammerburg"), ("LINDENBACHWEG 7", "D-01234", None), ("Lindenbach-Weg Nr. 7", None, "ammerburg"), ("7 Lindenbachweg", "1234", None), ("Lindenbahcweg, 7", "01234", "Ammerburg OT Nord"),
    ("Rückgebäude, Lindenbachweg 7", "01234", None), ("Lindenbachweg Hausnr. 7, Halle 3", "01234", None), ("01234 Ammerburg, Lindenbachweg 7", None, None), ("Lindenbachweg 7, 01234 Ammerburg", None, None), ("Lindenbachweg 7 (2. OG)", None, "Amerburg"), ("c/o Werk, Lindenbachweg  07", "01234", None),
]
OTHER = [("Lindenbachweg 7a", "01234", None), ("Lindenbachweg 17", "01234", None), ("Lindenfeldweg 7", "01234", None), ("Lindenbachweg 7", "54321", None), ("Lindenbachplatz 7", "01234", None)]
NONE = [(None, "01234", None), ("", "01234", None), ("-", "01234", None), ("auf Anfrage", None, None), ("Lindenbachweg", "01234", None), ("x" * 40_000, None, None)]


def test_one_building(spark):
    rows = filler() + [(i, i, *a) for i, a in enumerate(SAME + OTHER + NONE, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"building": F.lit("?"), "_street": F.lit("clash"), "n": F.lit(1), "value": F.lit("v")}).repartition(3)
    got = {r.id: r.building for r in address_classes(df, "id", "site_id", zips(spark), "street_address", "postal_code", "city").collect()}
    n = len(SAME)
    assert len({got[i] for i in range(1, n + 1)}) == 1
    assert len({got[1]} | {got[i] for i in range(n + 1, n + len(OTHER) + 1)}) == len(OTHER) + 1
    assert not set(range(n + len(OTHER) + 1, n + len(OTHER) + len(NONE) + 1)) & set(got)


def test_pairs_against_brute_force(spark):
    c = [(i, "abc"[i % 3]) for i in range(20)] + [(99, None)]
    got = {tuple(r) for r in pairs_within(spark.createDataFrame(c, "id long, k string"), "id", "k", "a", "b").collect()}
    assert got == {(a, b) for (a, x), (b, y) in itertools.combinations(c, 2) if x == y}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert locate(df, "id", "site_id", zips(spark), "street_address", "postal_code", "city").count() == 0
    df = spark.createDataFrame([(1, 1, "Lindenbachweg 7", "01234", None)], SCHEMA)
    assert address_classes(df, "id", "site_id", zips(spark).limit(0), "street_address", "postal_code", "city").count() == 1


def test_codes(spark):
    vals = ["01234", "D-01234", "DE 1234", "1234", " 54321 ", "A-6806", "00000", "k.A.", None, "123456"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "v string").select(postcode(F.col("v"))).collect()]
    assert got == ["01234", "01234", "01234", "01234", "54321", None, None, None, None, None]


def test_parts(spark):
    lines = ["Weberhofg.72", "Gärtner Straße 43 b", "33 a Müllerpl.", "Straße des 17. Juni 135", "Hauptstr. 7-9", "Hauptstr. 9/7", "Hauptstraße 007", "Alte Gasse 123456", "Am Ring 5, 3. OG", "Ring 4 4"]
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    got = [(r._street, r._number) for r in parse_address(df, "s", None, None).collect()]
    assert got == [
        ("weberhofgasse", "72"), ("gartnerstrasse", "43b"), ("mullerplatz", "33a"), ("strassedesjuni", "135|17"), ("hauptstrasse", "7|9"), ("hauptstrasse", "7|9"), ("hauptstrasse", "7"),
        ("altegasse", "123456"), ("amring", "5"), ("ring", "4"),
    ]
    # A postal code that stands in the line too is no number of a house.
    df = spark.createDataFrame([("Hauptstr. 5, 01234", "D-01234")], "s string, z string")
    assert parse_address(df, "s", "z", None).first()["_number"] == "5"


def test_names_of_a_block_are_compared_whatever_their_frequency(spark):
    pairs = [
        ("Hloundergasse 1", "Holundergassse 1"), ("Rosenfeldplatz 2", "Rsoenfeldpaltz 2"), ("Tannenhofstraße 3", "Tonnenhofstra�e 3"), ("Kirschwaldstraße 4", "Kirschweldstra?e 4"),
    ]
    rows = filler() + [(10 * i + j, 10 * i + j, a, "54321", None) for i, p in enumerate(pairs) for j, a in enumerate(p)]
    # One site's copies of a misspelling don't make it a usual name; a row without a town meets its site's names.
    rows += [(200 + i, 77, "Rsoenfeldpaltz 9", "54321", None) for i in range(9)] + [(300, 78, "Rosenfeldplatz 9", "54321", None)]
    rows += [(400, 79, "Eschenthalring 5", "01234", None), (401, 79, "Eschnethalrnig 5", None, None)]
    other = ["Birkenallee 6", "Birkenweg 6", "Lindenbachplatz 6", "Lindenfeldplatz 6", "Rosenfeldplatz 6", "Birkenbergplatz 6"]
    rows += [(500 + i, 500 + i, a, "54321", None) for i, a in enumerate(other)]
    # A usual name elsewhere is clearly nearer than the block's one.
    rows += [(600 + i, 600 + i, f"Holunderwaldplatz {20 + i}", "01234", None) for i in range(5)] + [(700, 700, "Holunderhofplatz 80", "54321", None), (701, 701, "Holunderaldplatz 80", "54321", None)]
    got = {r.id: r.building for r in address_classes(spark.createDataFrame(rows, SCHEMA), "id", "site_id", zips(spark), "street_address", "postal_code", "city").collect()}
    assert all(got[10 * i] == got[10 * i + 1] for i in range(len(pairs)))
    assert got[200] == got[300] and got[400] == got[401]
    assert got[700] != got[701]
    assert len({got[500 + i] for i in range(len(other))}) == len(other)


def test_rows_without_a_site_stand_for_themselves(spark):
    rows = [(1, None, "Müllerwaldplatz 13", "01234", None), (2, None, "Müllewaldplatz 13", "01234", None), (3, None, "Müllerwaldplatz 13", None, None), (4, None, "Müllerwaldplatz 13", None, None), (5, 4, "Müllerwaldplatz 13", None, None)]
    got = {r.id: r.building for r in address_classes(spark.createDataFrame(filler() + rows, SCHEMA), "id", "site_id", zips(spark), "street_address", "postal_code", "city").collect()}
    assert got[1] == got[2] and len({got[i] for i in (1, 3, 4, 5)}) == 4


def test_the_plan_of_an_address_stays_small(spark):
    # Each short form that is written out may not repeat the expression before it: plans are held by the driver.
    df = spark.createDataFrame([("Hauptstr. 5", "01234", None)], "s string, z string, c string")
    assert len(parse_address(df, "s", "z", "c")._jdf.queryExecution().analyzed().toString()) < 20_000
    lines = ["Hauptstra?e 5", "Hauptstra�e 5", "Hauptstr 5", "Hauptstr. 5", "HAUPTSTRASSE 5", "Müllerpl 5", "Müllerpl. 5", "Kastanienal. 5", "Kastanienal 5", "Weberhofg. 5", "Weberhofg 5", None]
    got = [r._street for r in parse_address(spark.createDataFrame([(x,) for x in lines], "s string"), "s", None, None).collect()]
    assert got == ["hauptstrasse"] * 5 + ["mullerplatz"] * 2 + ["kastanienallee"] * 2 + ["weberhofgasse", "weberhofg", None]

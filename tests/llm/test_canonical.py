import random

from pyspark.sql import functions as F

from sigmill.llm.canonical import best_entries, rank_entries, town_map, town_words, trade_map
from sigmill.llm.matcher import Matcher, levenshtein
from sigmill.llm.text import phone_key, repair_words, web_host

PLACES = ["Groß Ammerburg", "Alt-Tannenrode (Hügelland)", "Klosterthal an der Lohne", "Bad Weidenthal", "Mühlbrück", "Neu Königsleben"]
MORE = [f"{a} {b}" for a in ("Hirschrode", "Ottersand", "Vogelstadt", "Kranichau") for b in ("an der Lohne", "(Hügelland)")] + ["Groß Dornfeld", "Alt-Fährtal", "Bad Quellau", "Neu Eschen"]


def zips(spark, places=PLACES):
    return spark.createDataFrame([(f"{i:05d}", p) for i, p in enumerate(places + MORE)], "zipcode string, place string")


def test_towns(spark):
    cases = {
        "Gross Ammerburg": 0, "GROSS AMMERBURG": 0, "Gr. Amerburg": 0, "Groß Ammerubrg-Nord": 0, "D-Groß Ammerburg": 0, "Alt Tannenrode": 1, "Alt-Tannenrode (HÃ¼gelland) OT Altdorf": 1,
        "Klosterthal a. d. Lohne": 2, "Klosterthal": 2, "Stadt Bad Weidenthal / Umland": 3, "Muehlbrueck": 4, "M?hlbr?ck": 4, "Neu Koenigsleben, Stadt": 5,
        "Zwirblingen am Inn": None, "online": None, "-": None, "": None, "an der Lohne": None, "x" * 30_000: None,
    }
    df = spark.createDataFrame([(v,) for v in cases], "value string")
    got = {r.value: r.entry for r in town_map(df, zips(spark)).collect()}
    assert {v: got.get(v) for v in cases} == {v: None if k is None else PLACES[k] for v, k in cases.items()}
    assert town_map(df.limit(0), zips(spark)).count() == 0 and town_map(df, zips(spark).limit(0)).count() == 0


def test_both_ways_agree(spark):
    rnd = random.Random(3)
    vals = set()
    for p in PLACES * 8:
        t = list(p)
        for _ in range(rnd.randrange(3)):
            i = rnd.randrange(len(t))
            t[i] = rnd.choice("aeinrst")
        vals.add("".join(t))
    df = spark.createDataFrame([(v,) for v in vals], "value string").select("value", town_words("value").alias("words"))
    e = zips(spark).select(F.col("place").alias("entry"), town_words("place").alias("words"))
    a = {tuple(r) for r in best_entries(df, e, 0.5, 0.0).collect()}
    b = {(r.value, r.entry) for r in rank_entries(df, e, 0.5, 0.0).collect()}
    assert a == b and a


def test_repair_finds_every_near_word(spark):
    rnd = random.Random(1)
    vocab = ["".join(rnd.choice("abcde") for _ in range(rnd.randrange(4, 11))) for _ in range(60)]
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randrange(4, 11))) for _ in range(60)]
    got = {(r.word, r.term) for r in repair_words(spark.createDataFrame([(w,) for w in set(words)], "word string"), spark.createDataFrame([(v,) for v in set(vocab)], "term string")).collect()}
    for w in set(words):
        near = {v: levenshtein(w, v) for v in set(vocab)}
        least = min(near.values())
        if least <= (2 if len(w) >= 7 else 1):
            assert {(w, v) for v, d in near.items() if d == least} <= got


def test_trades_are_learnt_from_their_groups(spark):
    trades = spark.createDataFrame([("1", "Tischlerhandwerk"), ("2", "Malerhandwerk")], "hwo_uid string, gewerk_name string")
    rows = [(g, v) for g in range(5) for v in ("Tischlerhandwerk", "Schreiner", "Tauchsport")] + [(g, v) for g in range(5, 10) for v in ("Maler-Handwerk", "painter", "Tauchsport")]
    rows += [(11, "Tischlrehandwerk"), (12, "Handwerk > Schreiner"), (13, None), (14, ""), (15, "SCHREINER (Innungsbetrieb)")]
    got = {r.value: r.entry for r in trade_map(spark.createDataFrame(rows, "group int, value string"), trades).collect()}
    assert got["Schreiner"] == got["Tischlrehandwerk"] == got["Handwerk > Schreiner"] == got["SCHREINER (Innungsbetrieb)"] == "Tischlerhandwerk"
    assert got["painter"] == got["Maler-Handwerk"] == "Malerhandwerk" and "Tauchsport" not in got and "" not in got


def test_matcher_with_one_entry():
    m = Matcher([("A", ("haus", "boot"))])
    assert m.rank(["haus", "boot"], 0.5, 0) == "A" and m.rank([], 0.5, 0) is None and m.rank(["haus"], 0.6, 0) is None


def test_phones_and_hosts(spark):
    df = spark.createDataFrame([("+49 (0)11044 / 98 36 01 43", "https://www.A-b.example/x"), ("00491104498360143", "a-b.example"), ("011044 98360-143", "HTTP://WWW.A-B.EXAMPLE"), (None, None), ("12", "-")], "p string, w string")
    assert [tuple(r) for r in df.select(phone_key("p"), web_host("w")).collect()] == [("1104498360143", "a-b.example")] * 3 + [(None, None)] * 2


def test_long_words_are_repaired_on_both_ways(spark):
    from sigmill.llm.matcher import Matcher
    from sigmill.llm.text import repair_words

    long = "donaudampfschifffahrtselektrizitaetenhauptbetriebswerk"
    terms = [long, long[:39], "kurz", "x" * 30_000]
    words = [long[:5] + "q" + long[5:], long[:-7] + long[-6:], long[1:20] + long[21:], long[:41], long[:40] + "z", "y" * 30_000, "kurzz", long[:20] + "qqq" + long[20:]]
    df = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    got = {r.word: r.term for r in repair_words(df(words, "word"), df(terms, "term")).collect()}
    m = Matcher([(t, (t,)) for t in terms])
    assert got == {w: m.repair(w)[0][0] for w in words if m.repair(w)}
    assert got[words[0]] == got[words[1]] == got[words[2]] == long and got[words[3]] == got[words[4]] == long[:39]

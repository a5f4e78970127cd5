import random

from sigmill.llm.leakage import contained, leaked_items
from sigmill.llm.truncation import prefix_counts, truncated_documents

WORDS = [a + b for a in ("haus", "berg", "wald", "stein", "korn", "licht", "wasser") for b in ("bau", "weg", "markt", "werk", "hof", "tal", "see")]


def text(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def test_leaks(spark):
    rnd = random.Random(2)
    items = [(i, text(rnd, 80)) for i in range(6)] + [(6, None), (7, ""), (8, "kurz")]
    w = items[0][1].split()
    changed = [x if i % 9 else "anders" for i, x in enumerate(w)]
    docs = [
        (1, text(rnd, 50) + " " + items[0][1] + " " + text(rnd, 50)), (2, text(rnd, 30) + " " + " ".join(w[:48])), (3, " ".join(w[:24]) + " " + text(rnd, 60)),
        (4, "<p>" + " ".join(changed).upper() + "</p>"), (5, text(rnd, 400)), (6, None), (7, ""), (8, " ".join(w[:30]) + " " + text(rnd, 300) + " " + " ".join(w[30:50])),
        (9, " ".join(x[:3] + "-\n" + x[3:] if i % 7 == 3 else x for i, x in enumerate(w))), (10, text(rnd, 20_000) + " " + items[1][1]), (10, text(rnd, 20)),
    ]
    got = {(r.doc, r.item) for r in leaked_items(spark.createDataFrame(docs, "doc long, text string"), spark.createDataFrame(items, "item long, text string")).collect()}
    assert got == {(1, 0), (2, 0), (4, 0), (9, 0), (10, 1)}
    assert leaked_items(spark.createDataFrame([], "doc long, text string"), spark.createDataFrame(items, "item long, text string")).count() == 0
    assert leaked_items(spark.createDataFrame(docs, "doc long, text string"), spark.createDataFrame([], "item long, text string")).count() == 0


def test_alignment():
    a = "eins zwei drei vier fuenf sechs sieben acht neun zehn".split()
    assert contained(a, a) == 1 and contained(a, a[:5] + ["x"] * 9) == 0.5 and contained([], a) == 0 and contained(a, []) == 0
    assert contained(a, ["eins", "zwei", "drei", "anders", "fuenf", "sechs", "siebne", "acht", "neun", "zehn"]) == 1


def test_truncation(spark):
    rnd = random.Random(4)
    base = ["Kleinere Arbeiten rechnen wir nach Aufwand ab, ca. {} Stunden sind üblich.", "Die Prüfung dauert meist {} Tage und beginnt am Folgetag.", "Unser Betrieb besteht seit {} und hat viele Mitarbeitende.", "Wir verwenden Material, z. B. mit {} Jahren Garantie."]
    s = lambda: " ".join(rnd.choice(base).format(rnd.randrange(9, 99)) for _ in range(4))
    docs = [(i, "a", s()) for i in range(60)] + [(100 + i, "b", s() + "\n" + t) for i, t in enumerate(["Tel. 0123 456", "© 2020 Firma Bau", "Start | Team | Impressum", "- Bau und Wartung", "info@firma.example", "Mit freundlichen Grüßen\nA. Muster"] * 2)]
    cut = ["Die Prüfung dauert mei", "Kleinere Arbeiten rechnen wir nach", "Unser Betrieb besteht seit 19…", "Wir verwenden Material, z. B.", "Die Prüfung dauert meist 3 Tage und [...]"]
    docs += [(200 + i, "c", s() + " " + t) for i, t in enumerate(cut)] + [(300, "c", s() + " Die Prüfung dauert mei</p></div>"), (400, "d", None), (401, "d", ""), (402, "d", "© 2020"), (403, None, s()), (404, "d", s() * 300)]
    got = {r.doc: r.cut for r in truncated_documents(spark.createDataFrame(docs, "doc long, source string, text string").repartition(3)).collect()}
    assert {d for d, c in got.items() if c} == {*range(200, 205), 300} and 400 not in got and got[401] is False
    assert truncated_documents(spark.createDataFrame([], "doc long, source string, text string")).count() == 0


def test_open_endings_without_longer_copies_are_not_cut(spark):
    full = "Die Prüfung dauert meist sechs Tage und beginnt am Folgetag. Unsere Leistungen:\n- Wartung von Geräten\n- Beratung und Montage"
    docs = [(i, "a", full + f" {i}") for i in range(20)]
    docs += [(100 + i, "b", f"Nummer {i} ist fertig.\n" + t) for i, t in enumerate(["Dächer fürs Leben", "Seit 1890 für Sie da", "zuletzt geändert im Mai"])]
    docs += [(200, "c", "Alles fertig. Die Prüfung dauert mei" + "<span style='" + "x" * 400 + "'>"), (201, "c", "Alles fertig.\n- Wartung von Ger"), (202, "c", "Alles fertig. Die Prüfung dauert meist sechs T&aum")]
    got = {r.doc for r in truncated_documents(spark.createDataFrame(docs, "doc long, source string, text string").repartition(5)).where("cut").collect()}
    assert got == {200, 201, 202}


def test_prefix_counts_against_brute_force(spark):
    rnd = random.Random(5)
    vals = {"".join(rnd.choice("ab ") for _ in range(rnd.randrange(1, 9))): rnd.randrange(1, 5) for _ in range(300)}
    vals |= {"hot" + "x" * k: 7 for k in range(200)}
    ask = [("hot",), ("a",), ("ab",), ("zzz",), (None,), *((v,) for v in list(vals)[:80])]
    got = {r.v: (r.same, r.longer) for r in prefix_counts(spark.createDataFrame(list(vals.items()), "v string, n long").repartition(7), spark.createDataFrame(ask, "v string")).collect()}
    assert got == {q: (vals.get(q, 0), sum(n for v, n in vals.items() if v != q and v.startswith(q))) for (q,) in ask if q is not None}

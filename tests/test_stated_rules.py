"""Cases with expectations written out by hand, independent of any SQL."""

import hashlib

from pyspark.sql import functions as F

from sigmill.functions import strings as S
from sigmill.functions.page_signals import signals
from sigmill.functions.rules import is_missing
from sigmill.operators import cohorts as C
from sigmill.operators import observations as O
from sigmill.operators.codebook import check_codebook, scores
from sigmill.operators.resolution import contained_term, resolve_state
from sigmill.plans.published_book import PUBLISHED
from sigmill.sources.bundles import is_noise


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", f(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(rows)]


def test_texts_and_ids(spark):
    phones = ["0049 711-123 / 45.6", "0711 123", "+49 711", "(0711) 1", "0049", "711 5", None]
    assert column(spark, phones, S.normalise_phone) == ["+49711123456", "+49711123", "+49711", "(0711)1", "+49", "7115", None]
    places = ["Groß Dorf OT Nord", "Alt-Dorf", "Bad Ems (Lahn)", "St. Ort, Süd", "Otto", " Ulm / Donau", None]
    assert column(spark, places, S.place_key) == ["groß dorf", "alt", "bad ems", "st ort süd", "otto", "ulm", None]
    want = "pub_" + hashlib.sha256(b"public:2026-05-27:da-0123").hexdigest()[:16]
    assert column(spark, ["da-0123", None], lambda c: S.public_id(c, "2026-05-27")) == [want, None]


def test_failed_requests(spark):
    rows = [
        ("getaddrinfo ENOTFOUND x", None, None, "ENOTFOUND"), ("dns lookup failed", None, None, "ENOTFOUND"), ("x", None, "EAI_AGAIN", "ENOTFOUND"), ("connect ECONNREFUSED", None, None, "ECONNREFUSED"),
        ("connect timed out", None, None, "ETIMEDOUT"), ("x", None, "ESOCKETTIMEDOUT", "ETIMEDOUT"), ("The operation was aborted", None, None, "TIMEOUT"), ("x", None, "ERR_OPERATION_ABORTED", "TIMEOUT"),
        ("certificate has expired", None, None, "SSL_ERROR"), ("TLS alert", None, None, "SSL_ERROR"), ("too many redirects", None, None, "REDIRECT_LOOP"), ("socket hang up", None, None, "UNKNOWN"), (None, None, None, "UNKNOWN"),
        (None, 503, None, "HTTP_5XX"), (None, 404, None, None), (None, 200, None, None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, m string, s int, c string, want string")
    got = df.select("i", S.error_class("m", "s", "c").alias("got"), S.is_live("s").alias("live"), "s", "want").collect()
    assert all(r.got == r.want and r.live == (r.s is not None and r.s < 500) for r in got)


def test_noise_and_blanks(spark):
    paths = ["a/favicon.ico.html", "a/Robots.txt.html", "x/logo.png.html", "x/site.css.html", "x/app.js.html", "a\\SUCHE\\b.html", "a/tags/b", "x/assets/page.html", "sitemap.html", "a/static/b.html", "logo.png"]
    assert column(spark, paths, is_noise) == [True] * 7 + [False] * 4
    assert column(spark, [None, "", " ", "\t\n", " ", "x"], lambda v: is_missing(v, "bool")) == [True] * 5 + [False]


def test_observations(spark):
    onto = spark.createDataFrame([("legal.impressum.present", "bool", False), ("privacy.consent.banner.present", "bool", True), ("content.copyright.year", "num", False)], "signal_path string, value_type string, deprecated boolean")
    rows = [
        ("legal.impressum.present", "bool", True, None, []), ("Legal.Impressum", "bool", True, None, ["invalid_path_format", "unknown_signal"]), ("legal.other.present", "num", None, None, ["unknown_signal"]),
        ("privacy.consent.banner.present", "bool", True, None, ["deprecated_signal"]), ("content.copyright.year", "bool", True, None, ["value_type_mismatch"]),
        ("legal.impressum.present", "bool", None, None, ["no_value_populated"]), ("legal.impressum.present", "bool", True, 1.0, ["multiple_values_populated"]), ("legal_x.impressum", "bool", True, None, ["invalid_path_format", "unknown_signal"]),
    ]
    df = spark.createDataFrame([(i, *r[:4], None, None, r[4]) for i, r in enumerate(rows)], "i int, signal_path string, value_type string, value_bool boolean, value_num double, value_str string, value_json string, want array<string>")
    assert all(r["issues"] == r["want"] for r in O.issues(df, onto).collect())


def test_conflicts_name_the_winner_of_the_time(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 9, "y"), ("a", 3, 7, "z"), ("a", 4, 9, "w"), ("b", 1, 1, "q")], "k string, seq int, at int, dev string")
    got = O.conflicts(df, ["k"], [F.col("seq")], [F.desc("at"), F.desc("dev")], ["at", "dev"]).collect()
    assert sorted((r.winner_dev, r.loser_dev) for r in got) == [("y", "w"), ("y", "x"), ("y", "z")]


def test_reasons_and_reliability(spark):
    # (slice, period, rows, score): p75 equals the score
    plan = [
        ("small now", "2025-q1", 40, 50.0), ("small now", "2025-q2", 4, 60.0), ("small before", "2025-q1", 4, 50.0), ("small before", "2025-q2", 40, 60.0), ("flat", "2025-q1", 40, 50.0), ("flat", "2025-q2", 40, 52.0),
        ("tiny share", "2025-q1", 40, 99.0), ("tiny share", "2025-q2", 40, 97.0), ("new", "2025-q2", 40, 50.0), ("gone", "2025-q1", 40, 50.0), ("good", "2025-q1", 40, 50.0), ("good", "2025-q2", 40, 54.0), ("few", "2025-q1", 20, 50.0), ("few", "2025-q2", 40, 60.0),
    ]
    df = spark.createDataFrame([(g, p, x) for g, p, n, x in plan for _ in range(n)], "g string, p string, x double")
    got = {(r.g, r.p): (r.reasons, r.reliability) for r in C.period_series(df, "g", "p", "x").collect()}
    assert got["small now", "2025-q2"] == ("current_sample_below_k", "suppressed") and got["small before", "2025-q2"] == ("previous_sample_below_k", "suppressed")
    assert got["flat", "2025-q2"][0] == "delta_below_absolute_threshold" and got["tiny share", "2025-q2"][0] == "delta_below_absolute_threshold;delta_below_relative_threshold"
    assert got["new", "2025-q2"][0] == "no_previous_period" and got["gone", "2025-q2"][0] == "category_absent_current" and got["good", "2025-q1"][0] == "no_previous_period"
    assert got["good", "2025-q2"] == ("", "reliable") and got["few", "2025-q2"] == ("", "caution")
    assert not any("category_absent_previous" in r for r, _ in got.values())


def test_states_and_trades(spark):
    z = spark.createDataFrame([("10000", "Adorf", "Berlin"), ("20000", "Bedorf", "Hessen"), ("20001", "Cedorf", "Hessen"), ("30000", "Cedorf", "Bayern")], "zipcode string, place string, state string")
    seeds = [
        (1, 1, "10000", "Adorf"), (2, 2, None, "Bedorf OT Nord"), (3, 3, "10000", None), (4, 3, "20000", None), (5, 3, "20001", None), (6, 4, "10000", None), (7, 4, "20000", None), (8, 5, None, "Cedorf"), (9, 6, None, "Adorf"), (10, 6, None, "Bedorf"),
        (11, 7, "20000", None), (12, 7, None, "Adorf"), (13, 7, None, "Adorf"), (14, None, None, None),
    ]
    got = {r.site_id: (r.state, r.method, r.confidence) for r in resolve_state(spark.createDataFrame(seeds, "id long, site_id long, postal_code string, city string"), z).collect()}
    assert got == {
        1: ("Berlin", "postal-consensus", "high"), 2: ("Hessen", "city-unique", "medium"), 3: ("Hessen", "postal-majority", "medium"), 4: ("Berlin", "postal-tie-breaker", "low"),
        6: ("Berlin", "city-tie-breaker", "low"), 7: ("Hessen", "postal-tie-breaker", "low"),
    }
    terms = spark.createDataFrame([("t2", "bau"), ("t1", "bau"), ("t3", "holzbau"), ("t4", None)], "hwo_uid string, term string")
    texts = spark.createDataFrame([("zimmerei holzbau",), ("hochbau",), ("friseur",), ("",), (None,)], "t string")
    assert {r.t: r.hwo_uid for r in contained_term(texts, "t", terms).collect()} == {"zimmerei holzbau": "t3", "hochbau": "t1"}


def test_published_codebook(spark):
    assert check_codebook(PUBLISHED) == [] and sum(len(d["indicators"]) for d in PUBLISHED["dimensions"]) == 36
    assert all(abs(sum(i["weight"] for i in d["indicators"]) - 1) < 1e-9 for d in PUBLISHED["dimensions"]) and abs(sum(d["weight"] for d in PUBLISHED["dimensions"]) - 1) < 1e-9
    keys = [i["inputKey"] for d in PUBLISHED["dimensions"] for i in d["indicators"]]
    good = {k: "granular_with_revoke" if k.endswith("quality") else "0" if k.endswith("count") else "true" for k in keys}
    rows = [[1, *[good[k] for k in keys]], [2, *[None] * len(keys)]]
    df = spark.createDataFrame(rows, ", ".join(["id int", *[f"`{k}` string" for k in keys]]))
    got = {r.id: r for r in scores(df, PUBLISHED, "id").collect()}
    assert got[1].overall == 100 and got[1].confidence == 1
    # Nothing collected and no status: what has a policy for absence scores 0, audits and voluntary signals don't count.
    assert got[2].overall == 0 and got[2].accessibility_audit.score is None and got[2].legal_compliance.effective_weight == 0.28 and got[2].social_presence.effective_weight == 0.016


def test_page_patterns():
    page = "<html><body>Tel 0711/123 45-67 oder +49 (0)711 123, 12345 a.b@c.de x@y z+1@sub.example.org <!-- -->" + " " * 300_000 + "</body></html>"
    got = {s[0]: s[1:] for s in signals(page, "https://x.example/", 2024)}
    assert got["contact.emails"][3] == "a.b@c.de, z+1@sub.example.org" or "a.b@c.de" in got["contact.emails"][3] and got["contact.phones"][3].startswith("+497111234567")
    late = "<div>vor dem Körper</div>" + " " * 250_000 + "<body>0711 1234567</body>"
    assert {s[0]: s[1:] for s in signals(late, "https://x.example/", 2024)}["contact.phones"][3] == "+497111234567"


def test_signatures(spark):
    from sigmill.functions.canonical_json import public_key, sign
    from sigmill.operators.verification import signed_digest, verification_counts, verification_status

    key = bytes(range(1, 33))
    good = ['{"b":1,"a":"x"}', '{"a":"y"}']
    digest = {r.o: r.d for r in spark.createDataFrame([(o,) for o in good], "o string").select("o", signed_digest(F.col("o")).alias("d")).collect()}
    sig = {o: sign(key, bytes.fromhex(d)).hex() for o, d in digest.items()}
    rows = [(good[0], sig[good[0]], "k"), ('{"a": "x", "b": 1}', sig[good[0]], "k"), (good[1], sig[good[1]], "k"), (good[1], sig[good[1]], "k"), (good[1], sig[good[0]], "k"), (good[1], "zz", "k"), (good[1], None, "k"), ("{", sig[good[0]], "k"), (None, sig[good[0]], "k"), (good[0], sig[good[0]], "q"), (good[0], sig[good[0]], None)]
    df = spark.createDataFrame(rows, "obs_json string, signature string, signing_key_id string")
    keys = spark.createDataFrame([("k", public_key(key).hex())], "key_id string, public_key string")
    assert tuple(verification_counts(verification_status(df, keys)).first()) == (11, 4, 7, 2, 2, 36.36)
    assert tuple(verification_counts(verification_status(df.limit(0), keys)).first()) == (0, 0, 0, 0, 0, None)

"""Postal addresses of the same building, written differently.

Numbers first: an address is the sorted digit tokens of its line, the words of
its street (stem and kind) and its town; towns are repaired against the list of
places. Distinct addresses meet in blocks of their digits, their town (or site)
and one rare word: the stem of the street, by forms that a misspelling leaves
alone, or the usual name it misspells. In a block the words of two streets are
intersected; they are one street if the rarity-weighted overlap is high and
what is left unmatched is near by Levenshtein distance.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..session import cut
from ..sources.tables import bounded_broadcast
from .canonical import town_map
from .encoding import restore_udf
from .text import deletions, repair_words, skeleton

#: What stands beside a street and doesn't change the building.
BESIDE = (
    r"\([^)]*\)|\bc/o\b[^,]*(?:,|$)|\b(?:ruckgebaude|hinterhaus|vorderhaus|seitenflugel|gewerbehof|gewerbepark(?:\s+(?:nord|ost|sud|west|mitte))?|werkgemeinschaft)\b"
    r"|\b(?:halle|eingang|aufgang|etage|haus)\s+\w+\b|\b\d+\.?\s*(?:og|stock|etage)\b|\berdgeschoss\b"
)
NUMBER_WORD = r"\b(?:haus)?nr\b\.?|\bhausnummer\b|\bno\b\.?"
#: Short forms of street kinds at the end of the street's name, folded.
KINDS = ((r"stra[?\x{FFFD}]+e$", "strasse"), (r"str\.?$", "strasse"), (r"pl\.?$", "platz"), (r"al\.?$", "allee"), (r"g\.$", "gasse"))
#: Kinds of streets, folded.
STREET_KIND = r"(strasse|gasse|platz|allee|chausse|promenade|ring|damm|pfad|steig|ufer|weg|wall|graben|zeile|winkel|kamp|markt)$"
#: What is typed for a town but names none.
NO_TOWN = r"^(?:deutschland|online|bundesweit|uberregional|weltweit)$"
PLACEHOLDER = r"^(?:-+|k\.?\s*a\.?|n/?a|auf anfrage|siehe website|keine angabe|unbekannt|\?+|\.+)$"
#: A name this much rarer than a near one is its misspelling.
SHARE = 0.15
#: Sites below which a name proves nothing, however small the table.
EVIDENCE = 4
#: Least likeness (1 - edits / length) of the words that two names of a block don't share, and least rarity-weighted overlap of all words.
LIKE, OVERLAP = 0.7, 0.75


def postcode(c) -> Column:
    """The usual five digits of a German postal code (a lost leading zero restored), else null."""
    d = F.regexp_extract(F.upper(F.trim(c)), r"^(?:D(?:E)?[\s-]*)?(\d{4,5})$", 1)
    return F.when((d != "") & (d != "00000"), F.lpad(d, 5, "0"))


def parse_address(df: DataFrame, street: str, postal: str | None, city: str | None) -> DataFrame:
    """Adds _street, _number, _zip, _zip2, _town_text, _town_text2.

    ``_street`` is the folded street name without blanks, kind written out;
    ``_number`` the sorted numbers of the line with their letters, joined by
    ``|`` ("7-9" is 7|9, "Straße des 17. Juni 135" 135|17), without those that
    tell a place inside the plot; ``_zip2``/``_town_text2`` what stands of code
    and town inside the street field. All null where the field is null, a
    placeholder or names no street with a number.
    """
    raw = F.trim(restore_udf(street))
    folded = F.regexp_replace(skeleton(raw), r"\s+", " ")
    inner = r"(?:^|[,|·]|\s-)\s*(?:d[- ])?(\d{5})\s+([^,|·]*[^,|·\s])"
    df = df.withColumn("_raw", raw).withColumn("_f", F.when(~folded.rlike(PLACEHOLDER), folded))
    df = df.withColumn("_zip2", F.nullif(F.regexp_extract("_f", inner, 1), F.lit("")))
    df = df.withColumn("_town_text2", F.nullif(F.regexp_extract("_raw", r"(?:^|[,|·]|\s-)\s*(?:[Dd][- ])?\d{5}\s+([^,|·]*[^,|·\s])", 1), F.lit("")))
    line = F.regexp_replace(F.regexp_replace(F.regexp_replace("_f", inner, " "), BESIDE, " "), NUMBER_WORD, " ")
    line = F.trim(F.regexp_replace(line, r"[,;|·]|\s-\s|-\s*$|^\s*-", " "))
    df = df.withColumn("_line", line)
    # "Hofstr.5": a number may follow its street without a blank.
    df = df.withColumn("_line", F.regexp_replace("_line", r"(\p{L}{2,}\.?)(?=\d)", "$1 "))
    num = r"(?<![\p{L}\d])(\d+)(?:\s?([a-z])(?![\p{L}\d]))?(?!\p{L}|\d)"
    code = postcode(F.col(postal)) if postal else F.lit(None).cast("string")
    found = F.transform(F.regexp_extract_all("_line", F.lit(num), F.lit(0)), lambda x: F.regexp_replace(x, r"^0+(?=\d)|\s", ""))
    found = F.array_sort(F.array_distinct(F.filter(found, lambda x: ~F.coalesce((F.length(x) >= 4) & (F.lpad(x, 5, "0") == code), F.lit(False)))))
    number = F.when(F.size(found) > 0, F.array_join(found, "|"))
    name = F.regexp_replace(F.regexp_replace("_line", num, " "), r"\d+\s?[a-z]?(?!\p{L})", " ")
    name = F.regexp_replace(F.regexp_replace(name, r"[^\p{L}.?\x{FFFD}]", ""), r"\.(?=.)", "")
    for a, b in KINDS:  # each stands once: an expression that repeats the one before grows as a power of the list
        name = F.regexp_replace(name, a, b)
    df = df.withColumn("_name", F.regexp_replace(name, r"\.", "")).withColumn("_found", number)
    ok = F.col("_found").isNotNull() & (F.length("_name") >= 3)
    df = df.withColumn("_street", F.when(ok, F.col("_name"))).withColumn("_number", F.when(ok, F.col("_found"))).withColumn("_zip", code)
    return df.withColumn("_town_text", F.col(city) if city else F.lit(None).cast("string")).drop("_raw", "_f", "_line", "_name", "_found")


def add_town(df: DataFrame, zipcodes: DataFrame) -> DataFrame:
    """Adds _town: the listed place by postal code, else by the typed name; the folded typed name if unlisted."""
    z = zipcodes.select(F.col("zipcode").alias("_z"), F.col("place").alias("_p")).dropDuplicates(["_z"])
    named = df.select(F.explode(F.array("_town_text", "_town_text2")).alias("value")).where("value is not null").distinct()
    names = bounded_broadcast(town_map(named, zipcodes), MAX_SMALL)
    for key, out in (("_zip", "_p1"), ("_zip2", "_p2")):
        df = df.join(z.select(F.col("_z").alias(key), F.col("_p").alias(out)), key, "left")
    for key, out in (("_town_text", "_p3"), ("_town_text2", "_p4")):
        df = df.join(names.select(F.col("value").alias(key), F.col("entry").alias(out)), key, "left")
    typed = F.trim(skeleton(F.coalesce("_town_text", "_town_text2")))
    typed = F.when(~typed.rlike(PLACEHOLDER) & ~typed.rlike(NO_TOWN), typed)
    return df.withColumn("_town", F.coalesce("_p1", "_p2", "_p3", "_p4", typed)).drop("_p1", "_p2", "_p3", "_p4")


def street_names(df: DataFrame) -> DataFrame:
    """(_street, n, kind, stem, sn, kn, total, usual): the distinct street names; usual ones are taken for rightly spelt.

    ``n`` counts the distinct sites of a name, so copies within a site have no
    weight, ``sn`` and ``kn`` those of its stem and of its kind of street,
    ``total`` all of them. A stem is usual if it has a share ``SHARE`` of the
    sites that a stem has on the average of all rows (and ``EVIDENCE`` sites at
    all, which only matters in small tables), and no near stem is 1/``SHARE``
    times as frequent.
    A final g without a dot means "gasse" where the rest is a usual stem.
    """
    def stems(names: DataFrame) -> DataFrame:
        names = names.withColumn("kind", F.regexp_extract("_street", STREET_KIND, 1))
        return names.withColumn("stem", F.when(F.col("kind") != "", F.regexp_replace("_street", STREET_KIND, "")).otherwise(F.col("_street")))

    counts = cut(stems(df.where("_street is not null").groupBy("_street").agg(F.countDistinct("_site").alias("n"))))
    sums = counts.groupBy("stem").agg(F.sum("n").alias("sn"), F.max(F.col("kind") != "").alias("kinded"))
    typical = sums.agg((F.sum(F.col("sn") * F.col("sn")) / F.sum("sn")).alias("typical"), F.sum("sn").alias("total"), F.max(F.lit(True)).alias("_one")).where("total is not null")
    sums = cut(sums.join(F.broadcast(typical), F.col("sn") > 0))  # one row of sums beside every stem
    frequent = sums.where((F.col("sn") >= SHARE * F.col("typical")) & (F.col("sn") >= EVIDENCE))
    keyed = frequent.where(F.length("stem") >= 4).select("stem", "sn", F.explode(deletions(F.col("stem"), F.lit(1))).alias("_k"))
    a, b = keyed.alias("a"), keyed.alias("b")
    beaten = (
        a.join(b, (F.col("a._k") == F.col("b._k")) & (F.col("a.sn") < SHARE * F.col("b.sn")) & (F.col("a.stem") != F.col("b.stem")))
        .select(F.col("a.stem").alias("stem")).distinct()
    )
    good = frequent.join(beaten, "stem", "left_anti").select("stem", "kinded", F.lit(True).alias("_good"))
    long = good.where("kinded").select(F.concat("stem", F.lit("g")).alias("_street"), F.concat("stem", F.lit("gasse")).alias("_long"))
    short = counts.where("kind = ''").select("_street").join(long, "_street")
    kinds = counts.groupBy("kind").agg(F.sum("n").alias("kn"))
    out = counts.join(sums.select("stem", "sn", "total"), "stem").join(good.select("stem", "_good"), "stem", "left").join(kinds, "kind").join(short, "_street", "left")
    return cut(out.select("_street", F.coalesce("_long", "_street").alias("_name"), "n", "kind", "stem", "sn", "kn", "total", F.coalesce("_good", F.lit(False)).alias("usual")))


def edits(a: str, b: str) -> int:
    """Edit distance in which a swap of neighbours is one edit."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        before, last = last, row
    return last[-1]


@F.pandas_udf(IntegerType())
def swaps_once(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edits(x, y) for x, y in zip(a, b)], dtype="int32")


def near_usual(streets: DataFrame) -> DataFrame:
    """(word, terms, best): per unusual name the usual ones near it with their distances, and the nearest, then most frequent."""
    odd = streets.where("not usual").select(F.col("_street").alias("word"))
    usual = streets.where("usual").select(F.col("_street").alias("term"), "n")
    near = repair_words(odd, usual.select("term"), slack=1, disjoint=True).join(usual, "term")
    return near.groupBy("word").agg(F.collect_list(F.struct("term", "distance")).alias("terms"), F.min(F.struct("distance", -F.col("n"), "term"))["term"].alias("best"))


#: Rows of a lookup table that may be broadcast (some megabytes); a longer one is joined by a shuffle.
MAX_SMALL = 60_000
#: Letters of the head and of the tail of a stem that are compared with one letter missing.
EDGE = 6


def rare_words(worse: bool) -> Column:
    """Forms by which the rare word of a street meets its misspellings: its head and its tail with at most one letter
    missing, and the usual name it is or misspells. Up to three errors spread over a stem leave one of them alone.
    A misspelt kind stays at the stem, so a name without a kind, as the ``worse`` one, also meets by the end of names."""
    tail = lambda c: F.reverse(F.substring(F.reverse(c), 1, EDGE))
    forms = lambda mark, c: F.transform(deletions(c, F.lit(1)), lambda x: F.concat(F.lit(mark), x))
    empty = F.array().cast("array<string>")
    ends = forms("~", tail("_street"))
    return F.array_distinct(F.concat(
        forms("<", F.substring("stem", 1, EDGE)), forms(">", tail("stem")), F.when(F.col("kind") == "", ends).otherwise(empty) if worse else ends,
        F.when(F.col("usual"), F.array(F.concat(F.lit("="), "_street"))).otherwise(empty),
        F.transform(F.coalesce("terms", F.array().cast("array<struct<term:string,distance:int>>")), lambda t: F.concat(F.lit("="), t["term"])),
    ))


def same_streets(pairs: DataFrame, streets: DataFrame) -> DataFrame:
    """(a, b, likeness) of the pairs of names (a, b, ids of ``streets.name``) that are one street, 1 being equal.

    Words shared by both (stem, kind) count in full by their rarity, the
    others by their likeness, which must be at least ``LIKE``: Levenshtein
    distance over their joined letters, a swap of neighbours counting as one.
    Two usual names are two streets unless one is so rare beside the other
    that it is a frequent misspelling; and they are two if another usual name
    is two edits nearer to one of them. A name also is the usual one that is
    nearest to it, and so are two names with the same nearest one.
    """
    side = lambda x: streets.select(F.col("name").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("_street", "kind", "stem", "sn", "kn", "usual", "terms", "best", "total")])
    p = pairs.join(side("a"), "a").join(side("b"), "b")
    words = lambda x: F.filter(F.array(f"stem_{x}", f"kind_{x}"), lambda w: w != "")
    p = p.withColumn("shared", F.array_intersect(words("a"), words("b")))
    p = p.withColumn("rest_a", F.array_join(F.array_except(words("a"), F.col("shared")), "")).withColumn("rest_b", F.array_join(F.array_except(words("b"), F.col("shared")), ""))
    p = p.withColumn("long", F.greatest(F.length("rest_a"), F.length("rest_b"), F.lit(1))).withColumn("most", F.floor((1 - LIKE) * F.col("long") + 1e-9))
    p = cut(p.withColumn("apart", F.levenshtein("rest_a", "rest_b")).where(F.col("apart") <= 2 * F.greatest("most", F.lit(1))))
    # Levenshtein counts a swap as two; only pairs of doubt are measured once more.
    sure = F.col("apart") < 2
    p = p.where(sure).unionByName(p.where(~sure).withColumn("apart", swaps_once("rest_a", "rest_b")))
    rarity = lambda word, n: F.when(F.col(word) == "", 0.0).otherwise(F.log1p(F.col("total_a") / F.col(n)))
    weight = {x: (rarity(f"stem_{x}", f"sn_{x}"), rarity(f"kind_{x}", f"kn_{x}")) for x in "ab"}
    inside = lambda word: F.array_contains("shared", F.col(word))
    common = F.when(inside("stem_a"), weight["a"][0]).otherwise(0.0) + F.when(inside("kind_a"), weight["a"][1]).otherwise(0.0)
    other = sum(F.when(inside(f"{w}_{x}"), 0.0).otherwise(weight[x][i]) for x in "ab" for i, w in enumerate(("stem", "kind"))) / 2
    like = 1 - F.col("apart") / F.col("long")
    p = p.withColumn("overlap", (common + like * other) / (common + other))
    two = F.col("usual_a") & F.col("usual_b") & (F.least("sn_a", "sn_b") >= SHARE * F.greatest("sn_a", "sn_b"))
    nearer = lambda x, y: F.coalesce(F.exists(f"terms_{x}", lambda t: (t["term"] != F.col(f"_street_{y}")) & (t["distance"] <= F.col("apart") - 2)), F.lit(False))
    direct = (F.col("apart") <= F.col("most")) & (F.col("overlap") >= OVERLAP) & ~nearer("a", "b") & ~nearer("b", "a")
    repaired = F.col("usual_a") & F.coalesce(F.exists("terms_b", lambda t: t["term"] == F.col("_street_a")), F.lit(False)) & ~nearer("b", "a") | F.coalesce(F.col("best_a") == F.col("best_b"), F.lit(False))
    likeness = F.when(direct, F.col("overlap")).when(repaired, F.least(F.lit(OVERLAP), F.greatest("overlap", F.lit(0.01))))
    return p.where(~two & (direct | repaired)).select("a", "b", likeness.alias("likeness"))


def same_in_block(rows: DataFrame, streets: DataFrame) -> DataFrame:
    """Gives every street name of a block (number and town) the name of the same street that is best established there.

    Names are established by being usual, then by their sites. A name takes
    the place of the most similar better established one that keeps its own,
    so nothing is chained. Rows without a town meet all rows of their site.
    """
    # Blocks and names travel as 64-bit hashes, the order of names as one number.
    block = lambda key: F.xxhash64(key, "_number").alias("block")
    name = F.xxhash64("_street").alias("name")
    lone = bounded_broadcast(rows.where("_town is null").select("_site").distinct(), MAX_SMALL)
    of_site = F.concat(F.lit("?"), "_site")
    of_town = F.concat(F.lit("="), "_town")
    blocks = cut(rows.where("_town is not null").select(block(of_town), name).unionByName(rows.join(lone, "_site", "left_semi").select(block(of_site), name)).distinct())
    rank = F.when(F.col("usual"), F.lit(1 << 62)).otherwise(F.lit(0)) + F.least("sn", F.lit((1 << 31) - 1)) * F.lit(1 << 31) + F.least("n", F.lit((1 << 31) - 1))
    streets = cut(streets.join(near_usual(streets), F.col("_street") == F.col("word"), "left").drop("word").withColumns({"name": name, "rank": rank}))
    forms = lambda worse: streets.select("name", "rank", F.explode(F.transform(rare_words(worse), lambda x: F.xxhash64(x))).alias("form"))
    better = blocks.join(forms(False), "name").select("block", "form", F.col("name").alias("a"), F.col("rank").alias("ra"))
    worse = blocks.join(forms(True), "name").select("block", "form", F.col("name").alias("b"), F.col("rank").alias("rb"))
    met = cut(better.join(worse, ["block", "form"]).where("ra > rb or ra = rb and a > b").select("block", "a", "b", "ra").distinct())
    links = cut(met.join(same_streets(met.select("a", "b").distinct(), streets), ["a", "b"]))
    taken = None
    for _ in range(2):  # names that met only such as gave up their own are compared among themselves once more
        heads = links.select("block", "a").join(links.select("block", F.col("b").alias("a")), ["block", "a"], "left_anti").distinct()
        step = cut(links.join(heads, ["block", "a"]).groupBy("block", "b").agg(F.max_by("a", F.struct("likeness", "ra", "a")).alias("a")))
        taken = step if taken is None else taken.unionByName(step)
        out = taken.select("block", "b").unionByName(heads.select("block", F.col("a").alias("b")))
        links = links.join(out, ["block", "b"], "left_anti").join(out.withColumnRenamed("b", "a"), ["block", "a"], "left_anti")
    same = bounded_broadcast(cut(taken.join(streets.select(F.col("name").alias("a"), F.col("_street").alias("_same")), "a").select("block", F.col("b").alias("name"), "_same")), MAX_SMALL)
    rows = rows.select("*", block(F.coalesce(of_town, of_site)), name).join(same, ["block", "name"], "left")
    return rows.withColumn("_street", F.coalesce("_same", "_street")).drop("_same", "block", "name")


def fill_town(df: DataFrame) -> DataFrame:
    """Rows without a town take town and street from rows of their site with the same number and street (as written or as
    resolved), if these agree on one."""
    lone = bounded_broadcast(df.where("_town is null").select("_site").distinct(), MAX_SMALL)
    told = df.where("_town is not null").join(lone, "_site", "left_semi").select("_site", "_number", F.explode(F.array_distinct(F.array("_raw", "_street"))).alias("_k"), F.struct("_town", "_street").alias("_s"))
    known = told.groupBy("_site", "_number", "_k").agg(F.min("_s").alias("_s"), F.max("_s").alias("_hi")).where("_s = _hi").drop("_hi")
    known = bounded_broadcast(cut(known), MAX_SMALL)
    df = df.withColumn("_k", F.when(F.col("_town").isNull(), F.col("_street"))).join(known, ["_site", "_number", "_k"], "left")
    return df.withColumn("_street", F.coalesce("_s._street", "_street")).withColumn("_town", F.coalesce("_town", "_s._town")).drop("_s", "_k", "_raw")


def locate(df: DataFrame, id: str, site: str | None, zipcodes: DataFrame, street: str, postal: str | None, city: str | None) -> DataFrame:
    """(id, building, town, _street, _number) of every row: the class of its building, and its town.

    Rows are collapsed to distinct (street, number, town), so copies never
    multiply. All numbers with their letters must agree, the town must be the
    same place, and the street's words the same or misspellings of each other
    (``same_streets``). Rows without any town take it from rows of the same
    ``site`` with the same street and number, else they form a class of their
    own within the site; a row without a site is a site of its own. Null or
    placeholder streets and streets without a number have no building.
    """
    alone = F.concat(F.lit("r"), F.col(id).cast("string"))
    df = df.withColumn("_site", F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), alone) if site else alone).withColumn("_id", F.col(id))
    parsed = cut(parse_address(df, street, postal, city).select("_id", "_site", "_street", "_number", "_zip", "_zip2", "_town_text", "_town_text2"))
    every = cut(add_town(parsed, zipcodes).select("_id", "_site", "_street", "_number", "_town"))
    rows = every.where("_street is not null")
    streets = street_names(rows)
    short = bounded_broadcast(streets.where("_street != _name").select("_street", "_name"), MAX_SMALL)
    rows = rows.join(short, "_street", "left").withColumn("_street", F.coalesce("_name", "_street")).drop("_name")
    # Short forms written out join the names they stand for.
    whole = streets.groupBy(F.col("_name").alias("_street")).agg(F.sum("n").alias("n"), *[F.max(F.struct(F.col("_street") == F.col("_name"), c))[c].alias(c) for c in ("kind", "stem", "sn", "kn", "total", "usual")])
    rows = fill_town(cut(same_in_block(rows.withColumn("_raw", F.col("_street")), whole)))
    building = F.sha2(F.concat_ws("|", F.coalesce("_town", F.concat(F.lit("?"), "_site")), "_street", "_number"), 256)
    rows = rows.select("_id", building.alias("building"), "_town", "_street", "_number")
    rest = every.where("_street is null").select("_id", F.lit(None).cast("string").alias("building"), "_town", "_street", "_number")
    return cut(rows.unionByName(rest).select(F.col("_id").alias(id), "building", F.col("_town").alias("town"), "_street", "_number"))


def address_classes(df: DataFrame, id: str, site: str | None, zipcodes: DataFrame, street: str, postal: str | None, city: str | None) -> DataFrame:
    """The rows of ``locate`` whose address names a building."""
    return locate(df, id, site, zipcodes, street, postal, city).where("building is not null")


def pairs_within(classes: DataFrame, id: str, key: str, a: str, b: str) -> DataFrame:
    """All pairs (a < b) of rows of one class, by a self-join on the class; AQE splits large classes."""
    left, right = classes.select(key, F.col(id).alias(a)), classes.select(key, F.col(id).alias(b))
    return left.join(right, key).where(F.col(a) < F.col(b)).select(a, b)

"""Mapping of freely typed values to the entries of a reference list.

Distinct values are split into tokens, each distinct token is repaired against
the list's vocabulary by edit distance, and the repaired tokens rank complete
entries by soft TF-IDF. What belongs to no entry stays unmatched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .encoding import restore_udf
from .matcher import TOP, collect_wordings, rank_small
from .text import repair_words, skeleton, tokens

#: Written short forms of town words, folded, and their long forms.
TOWN_SHORT = (
    (r"\bgr\.?(?=\s)", "gross"), (r"\bkl\.?(?=\s)", "klein"), (r"^\s*b\.", "bad "), (r"^\s*n\.", "neu "),
    (r"\ba\.\s*d\.?\s", "an der "), (r"\bi\.\s*d\.?\s", "in der "), (r"\ba\.\s", "am "),
)
#: Parts of a town's name that name no town of their own.
TOWN_PARTS = r"\bot\s+.*$|^d-|[,(]\s*(?:lkr\.?|landkreis|kreis|stadt|kreisstadt|gkst|m|deutschland|zentrum)\)?\s*$|^(?:markt|gemeinde|stadt)\s|/ umland$"


def town_words(c) -> Column:
    """Folded words of a town's name, short forms written out, town parts and districts removed."""
    t = skeleton(restore_udf(c))
    t = F.regexp_replace(F.trim(t), TOWN_PARTS, " ")
    for a, b in TOWN_SHORT:
        t = F.regexp_replace(t, a, b)
    return tokens(t)


#: Words of a trade's name that tell no trade.
TRADE_NOISE = ("und", "u", "a", "fur", "handwerk", "meisterbetrieb", "innungsbetrieb")


def trade_words(c) -> Column:
    """Folded words of a trade: last step of a path, first of several, without remarks in brackets."""
    t = F.element_at(F.split(skeleton(restore_udf(c)), ">"), -1)
    t = F.regexp_replace(F.element_at(F.split(t, ";"), 1), r"\([^)]*\)|\bu\. ?a\.", " ")
    return F.filter(tokens(t), lambda x: ~x.isin(*TRADE_NOISE))


def trade_wordings(trades: DataFrame) -> DataFrame:
    """(entry, words): the canonical names, and the same without the closing "handwerk"."""
    names = trades.where("gewerk_name is not null").select("gewerk_name").distinct().select(F.col("gewerk_name").alias("entry"), trade_words("gewerk_name").alias("words"))
    short = names.select("entry", F.transform("words", lambda w: F.regexp_replace(w, "handwerk$", "")).alias("words"))
    return names.unionByName(short.where(~F.array_contains("words", ""))).distinct()


def rank_entries(values: DataFrame, entries: DataFrame, coverage: float = 0.5, agreement: float = 0.0) -> DataFrame:
    """(value, entry, score): the best entry of each value by soft TF-IDF over repaired tokens.

    ``values``: distinct (value, words array); ``entries``: (entry, words
    array), an entry may appear in several wordings. A value maps only if the
    repaired tokens carry ``coverage`` of the entry's IDF mass, among them one
    about as rare as the entry's rarest, and a share ``agreement`` of the
    value's words. Ties go to the first entry in
    binary order. Values without words don't appear.
    """
    wording = entries.select("entry", "words", F.array_join("words", " ").alias("wording")).distinct()
    terms = wording.select("entry", "wording", F.explode(F.array_distinct("words")).alias("term"))
    n = float(wording.select("entry").distinct().count())
    idf = terms.groupBy("term").agg(F.countDistinct("entry").alias("df")).select("term", F.log1p(F.lit(n) / F.col("df")).alias("idf"))
    weighted = terms.join(idf, "term")
    mass = weighted.groupBy("entry", "wording").agg(F.sum(F.col("idf") * F.col("idf")).alias("mass"), F.max("idf").alias("top"))
    words = values.select("value", F.explode(F.array_distinct("words")).alias("word"), F.size(F.array_distinct("words")).alias("n_words"))
    words = cut(words)
    fixed = repair_words(words.select("word").distinct(), idf.select("term"))
    fixed = fixed.withColumn("sim", 1 - F.col("distance") / F.greatest(F.length("word"), F.length("term")))
    hit = words.join(fixed, "word").join(weighted, "term").groupBy("value", "entry", "wording", "term", "idf", "n_words").agg(F.max("sim").alias("sim"))
    scored = (
        hit.groupBy("value", "entry", "wording", "n_words").agg(F.sum(F.col("idf") * F.col("idf") * F.col("sim")).alias("got"), F.count("*").alias("n_hit"), F.max("idf").alias("top_hit"))
        .join(mass, ["entry", "wording"])
        .withColumn("cover", F.col("got") / F.col("mass"))
        .where((F.col("cover") >= coverage) & (F.col("n_hit") >= agreement * F.col("n_words")) & (F.col("top_hit") >= TOP * F.col("top")))
        .withColumn("score", F.col("got") / F.sqrt(F.col("mass")))
    )
    best = scored.groupBy("value").agg(F.min(F.struct(-F.col("score"), -F.col("cover"), "entry")).alias("b"))
    return best.select("value", F.col("b.entry").alias("entry"), (-F.col("b.col1")).alias("score"))


def best_entries(values: DataFrame, entries: DataFrame, coverage: float, agreement: float, in_workers: bool = True) -> DataFrame:
    """(value, entry) by ``rank_entries``; a list of proven small size is matched in the workers instead of joined, with the same rows."""
    known = collect_wordings(entries) if in_workers else None
    if known is None:
        return rank_entries(values, entries, coverage, agreement).select("value", "entry")
    return rank_small(values, known, coverage, agreement)


def town_map(values: DataFrame, zipcodes: DataFrame, in_workers: bool = True) -> DataFrame:
    """(value, entry) for the distinct non-null strings in ``values.value`` that name a listed town or a part of one."""
    entries = zipcodes.where("place is not null").select("place").distinct().select(F.col("place").alias("entry"), town_words("place").alias("words"))
    return cut(best_entries(values.select("value", town_words("value").alias("words")), entries, 0.5, 0.0, in_workers))


def trade_map(rows: DataFrame, trades: DataFrame, least: int = 2, purity: float = 0.6, in_workers: bool = True) -> DataFrame:
    """(value, entry) for the distinct trade names in ``rows`` (group, value).

    First the canonical names themselves are recognised (tokens repaired).
    Wordings that share no token with them ("Schreiner") are learnt: a wording
    becomes another wording of the trade that the other rows of the same group
    name, if ``least`` groups and a share ``purity`` of all of them agree.
    Then all values are ranked against canonical and learnt wordings alike.
    """
    entries = trade_wordings(trades)
    pairs = rows.where("value is not null").select("group", "value").distinct()
    values = cut(pairs.select("value").distinct().select("value", trade_words("value").alias("words")).where(F.size("words") > 0))
    direct = cut(best_entries(values, entries, 0.85, 1.0, in_workers))
    named = cut(pairs.join(values.join(direct, "value", "left").select("value", "entry", F.array_join("words", " ").alias("w")), "value").select("group", "entry", "w").distinct())
    single = named.groupBy("group").agg(F.min("entry").alias("entry"), F.max("entry").alias("_hi")).where("entry = _hi").select("group", "entry")
    votes = named.where("entry is null").select("group", "w").distinct().join(single, "group").groupBy("w", "entry").agg(F.count("*").alias("k"))
    learnt = (
        votes.groupBy("w").agg(F.max_by("entry", F.struct("k", "entry")).alias("entry"), F.max("k").alias("k"), F.sum("k").alias("n"))
        .where((F.col("k") >= least) & (F.col("k") >= purity * F.col("n"))).select("entry", F.split("w", " ").alias("words"))
    )
    seen = named.where("entry is not null and w != ''").groupBy("w", "entry").agg(F.countDistinct("group").alias("k")).where(F.col("k") >= least)
    learnt = learnt.unionByName(seen.select("entry", F.split("w", " ").alias("words")))
    ranked = best_entries(values, cut(entries.unionByName(learnt)), 0.75, 0.67, in_workers).withColumnRenamed("entry", "_ranked")
    both = values.select("value").join(ranked, "value", "left").join(direct, "value", "left")
    return cut(both.select("value", F.coalesce("_ranked", "entry").alias("entry")).where("entry is not null"))

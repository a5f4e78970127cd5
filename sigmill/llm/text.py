"""Column expressions that several operators share: folding, tokens, edit neighbourhoods, phones, web hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accented letter -> base letter, position by position.
ACCENTED = "äöüáàâãåąéèêëęíìîïóòôõøúùûñńçćłśšźżžýÿ"
BASE = "aouaaaaaaeeeeeiiiiooooouuunncclsszzzyy"


def skeleton(c) -> Column:
    """Lower case without accents; ae, oe, ue count as a, o, u, so transliterated and bare umlauts agree."""
    c = F.lower(F.col(c) if isinstance(c, str) else c)
    c = F.replace(F.translate(c, ACCENTED, BASE), F.lit("ß"), F.lit("ss"))
    for a, b in (("ae", "a"), ("oe", "o"), ("ue", "u")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def tokens(c) -> Column:
    """Non-empty runs of letters and digits of a folded text; signs lost in decoding count as letters."""
    return F.filter(F.split(c, r"[^\p{L}\p{N}?\x{FFFD}]+"), lambda t: t != "")


def deletions(word: Column, most: Column) -> Column:
    """The word and every form with up to ``most`` (0 to 2) letters deleted."""
    cut = lambda w, i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.lit(1000)))
    one = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: cut(word, i))
    two = F.flatten(F.transform(one, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: cut(w, i))))
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.array(word), F.when(most >= 1, one).otherwise(empty), F.when(most >= 2, two).otherwise(empty)))


def edits_allowed(length: Column) -> Column:
    """Letters that may be deleted on either side to meet: longer words bear more."""
    return F.when(length >= 7, 2).when(length >= 4, 1).otherwise(0)


#: Words up to this length meet by deletion forms, longer ones by pieces of ``PIECE`` letters; near the border by both.
LONG, PIECE = 40, 13


def near_keys(word: Column, most: Column, shifts: int) -> Column:
    """Keys by which words within ``most`` (0 to 2) deletions on either side meet.

    Two errors leave one of three pieces of a long word alone: its head, its
    tail, or the piece behind the head, which the head's errors may have moved
    by ``shifts`` at most on one of the two sides.
    """
    n = F.length(word)
    empty = F.array().cast("array<string>")
    middle = F.transform(F.sequence(F.lit(PIECE + 1 - shifts), F.lit(PIECE + 1 + shifts)), lambda i: F.concat(F.lit("="), F.substring(word, i, F.lit(PIECE))))
    pieces = F.concat(F.array(F.concat(F.lit("<"), F.substring(word, 1, PIECE)), F.concat(F.lit(">"), F.substring(word, n - (PIECE - 1), F.lit(PIECE)))), middle)
    return F.array_distinct(F.concat(F.when(n <= LONG + 2, deletions(word, most)).otherwise(empty), F.when(n >= LONG - 4, pieces).otherwise(empty)))


def repair_words(words: DataFrame, vocabulary: DataFrame, word: str = "word", term: str = "term", slack: int = 0, disjoint: bool = False) -> DataFrame:
    """(word, term, distance): the nearest vocabulary terms of each word, ties included.

    ``words`` and ``vocabulary`` hold distinct strings. Exact members map to
    themselves. Others meet over shared keys (``near_keys``, an equi-join, no
    cross join), so every term within one (short words) or two edits is found,
    however long, a swap of neighbours counting as one. ``slack``: terms up to that much
    farther than the nearest stay too. ``disjoint``: no word is known to be a term. Words without a near term don't appear.
    """
    v = vocabulary.select(term)
    rest = words if disjoint else words.join(v, F.col(word) == F.col(term), "left_anti")
    rest = rest.where((F.length(word) >= 4) & ~F.col(word).rlike(r"\d"))
    left = rest.select(word, F.explode(near_keys(F.col(word), edits_allowed(F.length(word)), 0)).alias("_k"))
    right = v.where(F.length(term) >= 3).select(term, F.explode(near_keys(F.col(term), edits_allowed(F.length(term) + 1), 2)).alias("_k"))
    near = (
        left.join(right, "_k").select(word, term).distinct()
        .withColumn("distance", F.levenshtein(word, term))
        .where(F.col("distance") <= F.when(F.length(word) >= 9, 4).otherwise(2))
    )
    best = near.groupBy(word).agg(F.min("distance").alias("_d"))
    near = near.join(best, word).where(F.col("distance") <= F.col("_d") + slack)
    near = near.select(word, term, "distance")
    return near if disjoint else words.join(v, F.col(word) == F.col(term)).select(word, term, F.lit(0).alias("distance")).unionByName(near)


def phone_key(c) -> Column:
    """Digits of a German number without country code and leading zeros; null where under six digits."""
    d = F.regexp_replace(F.regexp_replace(c, r"\(0\)", ""), r"[^0-9+]", "")
    d = F.regexp_replace(F.regexp_replace(d, r"^(?:\+|00)49", "0"), r"\D", "")
    d = F.regexp_replace(d, r"^0+", "")
    return F.when(F.length(d) >= 6, d)


def web_host(c) -> Column:
    """Host of a web address without scheme, www, path; null where there is none."""
    h = F.regexp_extract(F.lower(F.trim(c)), r"^(?:[a-z]+://)?(?:www\.)?([^/?#:\s]+\.[a-z]+)", 1)
    return F.when(h != "", h)

"""Resolution of an entity's state and trade from the texts of its listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import place_key, trim_all


def contained_term(df: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(text, hwo_uid): per distinct text the longest of ``terms`` (hwo_uid, term) that it contains; ties by uid.

    Texts meet terms by equality of their substrings of the lengths that occur,
    so any number of terms takes one equi-join. Empty terms are contained in
    every text; null terms and texts in none.
    """
    terms = terms.where("term is not null")
    sizes = terms.groupBy().agg(F.collect_set(F.length("term")).alias("sizes"))  # one row with the lengths that occur
    texts = df.select(text).where(F.col(text).isNotNull()).distinct().join(F.broadcast(sizes))
    t = F.col(text)
    parts = F.flatten(F.transform("sizes", lambda n: F.when((n > 0) & (F.length(t) >= n), F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - n + 1, F.lit(1))), lambda i: F.substring(t, i, n)))
                                  .when(n == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))))
    hits = texts.select(text, F.explode(F.array_distinct(parts)).alias("term")).join(terms, "term")
    return hits.groupBy(text).agg(F.min_by("hwo_uid", F.struct(-F.length("term"), "hwo_uid")).alias("hwo_uid"))


def resolve_state(seeds: DataFrame, zipcodes: DataFrame) -> DataFrame:
    """(site_id, state, method, confidence) of the sites that any listing votes for.

    Every listing votes by its postal code and by its town, if that lies in one
    state only. A state counts as told by a postal code if its first vote (by
    id, the code first) was one. One state is a consensus; of several, those
    told by codes go before those told by towns, then the number of votes
    counts, then the name. Nulls and unknown codes and towns don't vote.
    """
    code = zipcodes.where("zipcode is not null and state is not null").groupBy("zipcode").agg(F.min("state").alias("state"))
    town = zipcodes.where("place is not null and state is not null").groupBy(place_key("place").alias("p")).agg(F.min("state").alias("state"), F.max("state").alias("_hi")).where("state = _hi and p != ''").drop("_hi")
    by_code = seeds.join(code, trim_all("postal_code") == F.col("zipcode")).select("site_id", (F.col("id") * 2).alias("at"), F.lit(0).alias("k"), "state")
    by_town = seeds.join(town, place_key("city") == F.col("p")).select("site_id", (F.col("id") * 2 + 1).alias("at"), F.lit(1).alias("k"), "state")
    c = by_code.unionByName(by_town).groupBy("site_id", "state").agg(F.count("*").alias("n"), F.min_by("k", "at").alias("k"))
    # Codes before towns, then votes, then the name: the best candidate, and how many share its place.
    place = F.struct("k", (-F.col("n")).alias("n"))
    m = c.groupBy("site_id").agg(F.count("*").alias("nc"), F.max("n").alias("mx"), F.min(place).alias("top"))
    t = c.join(m, "site_id").where(place == F.col("top")).groupBy("site_id").agg(F.min("state").alias("state"), F.count("*").alias("ties"), F.first("nc").alias("nc"), F.first("mx").alias("mx"), F.first("top").alias("top"))
    postal, votes, alone = F.col("top.k") == 0, -F.col("top.n"), F.col("ties") == 1
    method = (
        F.when(F.col("nc") == 1, F.when(postal, "postal-consensus").otherwise("city-unique"))
        .when(postal, F.when(alone & (votes == F.col("mx")), "postal-majority").otherwise("postal-tie-breaker")).when(alone, "city-majority").otherwise("city-tie-breaker")
    )
    sure = F.when(F.col("nc") == 1, F.when(postal, "high").otherwise("medium")).when(postal & alone & (votes > 1), "medium").otherwise("low")
    return t.select("site_id", "state", method.alias("method"), sure.alias("confidence"))

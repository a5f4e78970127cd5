"""Query catalogue of the problem operators tagged llm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from ..sources.tables import bounded_broadcast, table
from .address import address_classes, locate, pairs_within, postcode
from .canonical import town_map, trade_map
from .encoding import damaged_values
from .leakage import leaked_items
from .linkage import firm_level, firm_words, score_pairs
from .survivor import NO_NAME, closest_value, code_form, consensus, establishments, name_form, single_blanks
from .text import phone_key, web_host

QUERIES: dict = {}
ORACLE: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _damaged_fields(spark: SparkSession, folder: str) -> DataFrame:
    seeds = table(spark, folder, "site_source_seeds", "id", "business_name", "city", "street_address")
    long = seeds.select(F.col("id").alias("seed_id"), F.expr("stack(3, 'business_name', business_name, 'city', city, 'street_address', street_address) AS (field_name, value)"))
    return long.join(damaged_values(long).where("bad"), "value")


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every field value with a character that a wrong decoding spoilt."""
    return _damaged_fields(spark, folder).select("seed_id", "field_name")


@query
def p3_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged values beside what could be restored of them."""
    return _damaged_fields(spark, folder).select("seed_id", "field_name", F.col("value").alias("damaged"), "restored")


def _mapped(spark: SparkSession, folder: str, in_workers: bool) -> DataFrame:
    seeds = table(spark, folder, "site_source_seeds", "id", "site_id", "city", "category")
    sites = table(spark, folder, "sites", "id", "gemeinde")
    zipcodes, trades = table(spark, folder, "zipcodes"), table(spark, folder, "gewerke")
    towns = seeds.select(F.lit("site_source_seeds.city").alias("field_name"), F.col("id").alias("row_id"), F.col("city").alias("value")).unionByName(
        sites.select(F.lit("sites.gemeinde").alias("field_name"), F.col("id").alias("row_id"), F.col("gemeinde").alias("value"))
    ).where("value is not null")
    named = towns.join(bounded_broadcast(zipcodes.select(F.col("place").alias("value")).distinct(), MAX_ZIPCODES), "value", "left_anti")
    kinds = seeds.select(F.lit("site_source_seeds.category").alias("field_name"), F.col("id").alias("row_id"), F.col("category").alias("value")).where("value is not null")
    kinds = kinds.join(bounded_broadcast(trades.select(F.col("gewerk_name").alias("value")).distinct(), MAX_ZIPCODES), "value", "left_anti")
    town_of = town_map(named.select("value").distinct(), zipcodes, in_workers)
    trade_of = trade_map(seeds.select(F.col("site_id").alias("group"), F.col("category").alias("value")), trades, in_workers=in_workers)
    out = named.join(town_of, "value", "left").unionByName(kinds.join(trade_of, "value", "left"))
    return out.select("field_name", "row_id", F.coalesce("entry", F.lit("unmatched")).alias("canonical_value"))


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every typed town or trade that isn't letter for letter an entry, with the entry meant or "unmatched"."""
    return _mapped(spark, folder, True)


@query
def p5_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows by joins of distinct tokens with the vocabulary, the way that lists too long for the workers take."""
    return _mapped(spark, folder, False)


def _buildings(spark: SparkSession, folder: str) -> DataFrame:
    seeds = table(spark, folder, "site_source_seeds", "id", "site_id", "street_address", "postal_code", "city")
    return address_classes(seeds, "id", "site_id", table(spark, folder, "zipcodes"), "street_address", "postal_code", "city")


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of seed rows whose address is the same building."""
    return pairs_within(_buildings(spark, folder), "id", "building", "seed_id_a", "seed_id_b")


@query
def p2_buildings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per seed row with its building's class; copies aren't expanded into pairs."""
    return _buildings(spark, folder).select(F.col("id").alias("seed_id"), "building", "town", F.col("_street").alias("street"), F.col("_number").alias("house_number"))


#: Catalogues of sources are a hand-kept list.
MAX_CATALOGS = 10_000
#: All postal codes of a country (Germany has about 8,200).
MAX_ZIPCODES = 100_000
#: Rank of a catalogue that the list doesn't name.
UNRANKED = 1_000_000


def seed_groups(spark: SparkSession, folder: str, places: DataFrame | None = None) -> DataFrame:
    """(id, site_id, phone, building, town, group): the establishment of every seed row; cut from its lineage."""
    seeds = table(spark, folder, "site_source_seeds", "id", "site_id", "street_address", "postal_code", "city")
    if places is None:
        places = locate(seeds, "id", "site_id", table(spark, folder, "zipcodes"), "street_address", "postal_code", "city")
    phones = table(spark, folder, "site_source_seeds", "id", "site_id", phone_key("phone").alias("phone"))
    return cut(establishments(phones.join(places.select("id", "building", "town"), "id", "left")))


def _survivors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(groups of two or more rows; scored distinct names and postal codes, their groups marked ``n|`` and ``p|``)."""
    groups = seed_groups(spark, folder).select("id", "site_id", "group")
    sizes = cut(groups.groupBy("group").agg(F.min("id").alias("first_seed_id"), F.min("site_id").alias("site_id"), F.count("*").alias("n")).where("n >= 2"))
    seeds = table(spark, folder, "site_source_seeds", "id", "source_path", "business_name", "postal_code", "created_at")
    ranks = bounded_broadcast(table(spark, folder, "source_catalogs", "catalog", "trust_rank").dropDuplicates(["catalog"]), MAX_CATALOGS)
    codes = bounded_broadcast(table(spark, folder, "zipcodes", F.col("zipcode").alias("code")).distinct().withColumn("listed", F.lit(True)), MAX_ZIPCODES)
    rows = seeds.join(groups.join(sizes.select("group"), "group", "left_semi").select("id", "group"), "id").withColumn("catalog", F.split("source_path", "/")[0]).join(ranks, "catalog", "left")
    rows = rows.withColumn("rank", F.coalesce("trust_rank", F.lit(UNRANKED))).withColumn("name", single_blanks("business_name")).withColumn("code", postcode(F.col("postal_code"))).join(codes, "code", "left")
    trust = F.struct(F.col("rank"), -F.unix_micros(F.col("created_at").cast("timestamp")), F.col("id"))
    rows = cut(rows.select("group", "rank", trust.alias("trust"), "business_name", "name", "code", "listed"))
    spoilt = damaged_values(rows.select("business_name"), "business_name").where("bad").select(F.col("value").alias("business_name"), F.lit(True).alias("spoilt"))
    named = rows.where(F.col("name").isNotNull() & ~F.lower("name").rlike(NO_NAME)).join(spoilt, "business_name", "left")
    weight = (1 / (F.lit(1.0) + F.col("rank"))).alias("w")
    whole = F.col("spoilt").isNull() & ~F.col("name").rlike(r"(?:\u2026|\.\.\.)$")
    names = named.select(F.concat(F.lit("n|"), "group").alias("group"), F.col("name").alias("value"), name_form(F.col("name")).alias("form"), weight, "trust", whole.alias("whole"))
    listed = rows.where("listed").select(F.concat(F.lit("p|"), "group").alias("group"), F.col("code").alias("value"), code_form(F.col("code")).alias("form"), weight, "trust", F.lit(True).alias("whole"))
    return sizes, cut(consensus(names.unionByName(listed)))


def _field(values: DataFrame, mark: str, name: str) -> DataFrame:
    return values.where(F.col("group").startswith(mark)).select(F.substring("group", 3, 1_000_000).alias("group"), F.col("value").alias(name))


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving record of every establishment that two or more seed rows describe.

    Both fields are the existing value closest to the group's consensus by
    trust, in which a row outweighs all rows of less trusted catalogues and
    all earlier ones of its own.
    """
    sizes, scored = _survivors(spark, folder)
    best = closest_value(scored, "trusted")
    out = sizes.join(_field(best, "p|", "postal_code"), "group", "left").join(_field(best, "n|", "business_name"), "group", "left")
    return out.select("first_seed_id", "site_id", "postal_code", "business_name")


@query
def p1_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """The existing name closest to each group's consensus by evidence."""
    sizes, scored = _survivors(spark, folder)
    return sizes.join(_field(closest_value(scored), "n|", "business_name"), "group").select("first_seed_id", F.col("n").alias("n_rows"), "business_name")


#: A web host that more firms than this name is a portal and tells nothing about one of them.
MAX_FIRMS_OF_HOST = 3
MATCH = 0.9
#: Digits of a number that name the line: area code and main number.
MAIN_LINE = 10


def _contact_address(contacts: DataFrame) -> DataFrame:
    """Splits the one-line address into street, code and town: parts stand in any order behind , | · or a dash."""
    t = F.regexp_replace("address_text", r"\s+", " ")
    code = r"(?:^|[,|·]|\s-)\s*(?:D[- ]\s?)?(\d{5})\s+([^,|·]*?)\s*(?:$|[,|·]|\s-\s)"
    zipcode = F.nullif(F.regexp_extract(t, code, 1), F.lit(""))
    halves = F.split(t, r"\s+[·|]\s+|\s+-\s+")
    with_number = F.filter(halves, lambda x: x.rlike(r"\d"))
    without = F.filter(halves, lambda x: ~x.rlike(r"\d") & ~x.rlike("(?i)gewerbe|hof$|haus$"))
    town = F.when(zipcode.isNotNull(), F.nullif(F.regexp_extract(t, code, 2), F.lit(""))).otherwise(F.get(without, F.lit(0)))
    street = F.when(zipcode.isNotNull(), t).otherwise(F.coalesce(F.get(with_number, F.lit(0)), t))
    return contacts.select(
        F.col("contact_id").alias("id"), F.lit(None).cast("long").alias("site_id"), street.alias("street_address"), zipcode.alias("postal_code"), town.alias("city"),
    )


def _matches(spark: SparkSession, folder: str) -> DataFrame:
    zipcodes = table(spark, folder, "zipcodes")
    seeds = table(spark, folder, "site_source_seeds", "id", "site_id", "business_name", "street_address", "postal_code", "city", "phone", "website_url")
    contacts = table(spark, folder, "imprint_contacts", "contact_id", "firm_text", "address_text", "phone_text", "web_text")
    both = seeds.select("id", "site_id", "street_address", "postal_code", "city").unionByName(_contact_address(contacts))
    places = locate(both, "id", "site_id", zipcodes, "street_address", "postal_code", "city").select("id", "building", "town")
    listed = zipcodes.select(F.col("place").alias("town")).distinct().withColumn("_listed", F.lit(True))
    places = places.join(bounded_broadcast(listed, MAX_ZIPCODES), "town", "left").withColumn("known", F.when(F.col("_listed"), F.col("town"))).drop("_listed")
    groups = seed_groups(spark, folder, places).join(places.select("id", "known"), "id").select("id", "group", F.col("building").alias("building_s"), F.col("known").alias("town_s"))

    s = (
        seeds.select("id", firm_words("business_name").alias("firm_s"), phone_key("phone").alias("phone_s"), web_host("website_url").alias("host"))
        .join(groups, "id").select(F.col("id").alias("seed_id"), "group", "firm_s", "phone_s", "host", "building_s", "town_s")
    )
    c = (
        contacts.select("contact_id", firm_words("firm_text").alias("firm_c"), phone_key("phone_text").alias("phone_c"), web_host("web_text").alias("host"))
        .join(places.withColumnRenamed("id", "contact_id"), "contact_id", "left")
        .select("contact_id", "firm_c", "phone_c", "host", F.col("building").alias("building_c"), F.col("known").alias("town_c"))
    )
    users = c.where("host is not null").groupBy("host").agg(F.countDistinct(F.array_join("firm_c", " ")).alias("fc"))
    portal = users.where(F.col("fc") > MAX_FIRMS_OF_HOST).select("host").join(s.select("host").where("host is not null").distinct(), "host", "left_anti").withColumn("portal", F.lit(True))
    s = cut(s.withColumnRenamed("host", "host_s"))
    c = cut(c.join(portal, "host", "left").withColumn("host_c", F.when(F.col("portal").isNull(), F.col("host"))).drop("portal", "host"))

    # Establishments stand for their rows: distinct profiles meet, copies don't multiply.
    e = cut(s.groupBy("group", "firm_s", "phone_s", "host_s", "building_s", "town_s").agg(F.min("seed_id").alias("rep")))
    # Numbers of unlike length with the same first ten digits are one line with another extension.
    main = lambda c: F.substring(c, 1, MAIN_LINE)
    single = e.where("host_s is not null").groupBy("host_s").agg(F.min("group").alias("g1"), F.max("group").alias("g2")).where("g1 = g2").select("host_s", F.lit(True).alias("only"))
    e = cut(e.join(single, "host_s", "left").withColumn("only", F.coalesce("only", F.lit(False))))

    def blocks(x: str, only: Column) -> Column:
        """The keys of all blocking passes; a key with a missing part is null and left out."""
        phone, host, town, building, firm = (F.col(f"{n}_{x}") for n in ("phone", "host", "town", "building", "firm"))
        long = F.when(F.length(phone) >= MAIN_LINE, main(phone))
        name = F.when(F.size(firm) > 0, F.array_join(firm, " "))
        line = F.when(long.isNotNull(), F.concat_ws("|", long, host))  # two sides without a host meet too
        passes = [phone, line, F.concat(long, F.lit("|"), town), building, F.concat(host, F.lit("|"), town), F.when(only, host), F.concat(name, F.lit("|"), town)]
        return F.array_compact(F.array(*[F.concat(F.lit(f"{i}|"), p) for i, p in enumerate(passes)]))

    cand = e.select("rep", F.explode(blocks("s", F.col("only"))).alias("k")).join(c.select("contact_id", F.explode(blocks("c", F.lit(True))).alias("k")), "k").select("rep", "contact_id").distinct()
    known = lambda x, y: F.col(x).isNotNull() & F.col(y).isNotNull()
    one_line = (F.length("phone_s") != F.length("phone_c")) & (F.length("phone_c") >= MAIN_LINE) & (main("phone_s") == main("phone_c"))
    levels = cand.join(e, "rep").join(c, "contact_id").select(
        "group", "contact_id", "only",
        F.when(~known("phone_s", "phone_c"), -1).when(F.col("phone_s") == F.col("phone_c"), 2)
        .when(one_line, 1).otherwise(0).alias("phone"),
        F.when(known("building_s", "building_c") & (F.col("building_s") == F.col("building_c")), 2)
        .when(~known("town_s", "town_c"), -1).when(F.col("town_s") != F.col("town_c"), 0).when(known("building_s", "building_c"), 1).otherwise(-1).alias("place"),
        firm_level("firm_s", "firm_c").alias("firm"),
        F.when(~known("host_s", "host_c"), -1).when(F.col("host_s") == F.col("host_c"), 1).otherwise(0).alias("web"),
    )
    scored = score_pairs(cut(levels))
    # What shares the name alone is a namesake, and what shares the web site of a chain is a branch: without a common
    # phone or building a pair needs the web site, and with it the town or that only one establishment has that site.
    shared_site = (F.col("web") == 1) & ((F.col("place") == 1) | F.col("only") & (F.col("firm") >= 2))
    scored = scored.where((F.col("phone") >= 1) | (F.col("place") == 2) | shared_site)
    best = scored.groupBy("group", "contact_id").agg(
        F.max("confidence").alias("confidence"), F.max("phone").alias("phone"), F.max("place").alias("place"), F.max("firm").alias("firm"), F.max("web").alias("web"),
    )
    return s.select("seed_id", "group").join(best.where(F.col("confidence") >= MATCH), "group")


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of seed and contact rows of one establishment."""
    return _matches(spark, folder).select("seed_id", "contact_id")


@query
def p7_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with the posterior and the levels behind it."""
    return _matches(spark, folder).select("seed_id", "contact_id", "confidence", "phone", "place", "firm", "web")


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", F.col("doc_id").alias("doc"), "text")
    items = table(spark, folder, "eval_items", F.col("item_id").alias("item"), "text")
    return leaked_items(docs, items).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "share")


@query
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with at least half of an item's words in their order in one place."""
    return _leaks(spark, folder).select("doc_id", "item_id")


@query
def p8_share(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with the share of the item that stands in the document."""
    return _leaks(spark, folder)


def _truncated(spark: SparkSession, folder: str) -> DataFrame:
    from .truncation import truncated_documents

    return truncated_documents(table(spark, folder, "documents", F.col("doc_id").alias("doc"), "source", "text"))


@query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose text stops before its last sentence is complete."""
    return _truncated(spark, folder).where("cut").select(F.col("doc").alias("doc_id"))


@query
def p10_tails(spark: SparkSession, folder: str) -> DataFrame:
    """The last body segment of every document and whether it was cut."""
    return _truncated(spark, folder).select(F.col("doc").alias("doc_id"), "source", "tail", "cut")


@query
def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    """How often each source truncates."""
    return _truncated(spark, folder).groupBy("source").agg(
        F.count("*").alias("n_docs"), F.count_if("cut").alias("n_cut"), (F.floor(F.count_if("cut") / F.count("*") * 10000 + 0.5) / 10000).alias("rate")
    )


PERCENTS = [0.1, 0.25, 0.5, 0.75, 0.9]
#: Rank error that compression may add to each summary; under 10,000 values the result is exact.
EPS = 1e-4


def _score_groups(spark: SparkSession, folder: str) -> DataFrame:
    """(group, part, value): scores by cohort and by the state of their asset, parts are single days.

    Of rows delivered twice for one (run, site) the latest counts, of these
    the greatest id. Null, NaN and negative scores are no scores.
    """
    from ..operators.history import fold_label, state_codes

    scores = table(spark, folder, "scores", "id", "scoring_run_id", "site_id", "cohort_id", "overall_score", "scored_at")
    last = scores.groupBy("scoring_run_id", "site_id").agg(F.max_by(F.struct("cohort_id", "overall_score", "scored_at"), F.struct("scored_at", "id")).alias("s"))
    valid = last.select("site_id", "s.*").where("overall_score is not null and not isnan(overall_score) and overall_score >= 0")
    codes = bounded_broadcast(state_codes(table(spark, folder, "zipcodes", "state_code", "state")), MAX_ZIPCODES)
    states = table(spark, folder, "asset_states", "domain", "bundesland", "valid_from", "recorded_at", "asset_id")
    newest = states.where("domain is not null").groupBy("domain").agg(F.max_by("bundesland", F.struct("valid_from", "recorded_at", "asset_id", "bundesland")).alias("bundesland"))
    newest = newest.withColumn("spelling", fold_label("bundesland")).join(codes, "spelling", "left").select("domain", "code")
    sites = table(spark, folder, "sites", F.col("id").alias("site_id"), "domain")
    by_site = valid.join(sites, "site_id", "left").join(newest, "domain", "left")
    day = F.date_format("scored_at", "yyyy-MM-dd")
    groups = F.array(F.concat(F.lit("cohort:"), "cohort_id"), F.concat(F.lit("bundesland:"), "code"))
    return by_site.select(F.explode(groups).alias("group"), day.alias("part"), F.col("overall_score").alias("value")).where("group is not null")


@query
def p6_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles per cohort and per federal state, merged from summaries of single days, with proven error bounds."""
    from .quantiles import merged, percentiles, summaries

    parts = cut(summaries(_score_groups(spark, folder), EPS))
    out = percentiles(merged(parts, EPS), PERCENTS)
    kind = F.split("group", ":", 2)
    return out.select(kind[0].alias("dimension"), kind[1].alias("key"), "n", "p", "value", "rank_error")


_P6_SQL = r"""
WITH codes AS (
  SELECT DISTINCT regexp_replace(replace(replace(replace(replace(lower(s),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss'),'[^a-z0-9]','','g') AS spelling, state_code AS code
  FROM (SELECT state AS s, state_code FROM zipcodes UNION ALL SELECT state_code, state_code FROM zipcodes)
), sc AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scoring_run_id, site_id ORDER BY scored_at DESC NULLS LAST, id DESC) AS rn FROM scores)
  WHERE rn = 1 AND overall_score IS NOT NULL AND NOT isnan(overall_score) AND overall_score >= 0
), st AS (
  SELECT domain, regexp_replace(replace(replace(replace(replace(regexp_replace(lower(bundesland),'^\s*de\s*[-_]\s*',''),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss'),'[^a-z0-9]','','g') AS spelling
  FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY valid_from DESC NULLS LAST, recorded_at DESC NULLS LAST, asset_id DESC NULLS LAST, bundesland DESC NULLS LAST) AS rn FROM asset_states WHERE domain IS NOT NULL) WHERE rn = 1
), v AS (
  SELECT 'cohort' AS dimension, cohort_id AS key, overall_score AS x FROM sc WHERE cohort_id IS NOT NULL
  UNION ALL
  SELECT 'bundesland', code, overall_score FROM sc JOIN sites ON sites.id = sc.site_id JOIN st ON st.domain = sites.domain JOIN codes ON codes.spelling = st.spelling
), r AS (SELECT *, row_number() OVER (PARTITION BY dimension, key ORDER BY x) AS i, count(*) OVER (PARTITION BY dimension, key) AS n FROM v)
SELECT dimension, key, n, p, x AS value, CAST(0 AS BIGINT) AS rank_error
FROM r, (VALUES (0.1::DOUBLE),(0.25::DOUBLE),(0.5::DOUBLE),(0.75::DOUBLE),(0.9::DOUBLE)) q(p) WHERE i = greatest(1, least(n, ceil(p * n - 1e-9)))
"""
ORACLE["p6_percentiles"] = _P6_SQL


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    from .mixing import TOKENIZER, mix

    path = spark.conf.get("spark.sigmill.tokenizer", TOKENIZER)
    return mix(table(spark, folder, "documents", "doc_id", "source", "text"), table(spark, folder, "mix_targets"), tokenizer=path)


@query
def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of every source in the largest mix that the repeats allow."""
    return _mix(spark, folder)[1]


@query
def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The drawn documents with their repeats."""
    return _mix(spark, folder)[0]

"""The published codebook over page texts, and the joins, resolutions and reports built around scores, states and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.num import js_round, summary
from ..operators.codebook import dimensions, scores, traces
from ..operators.resolution import contained_term, resolve_state
from ..sources.tables import bounded_broadcast, table
from .published_book import PUBLISHED
from .scoring_queries import _SIG, _SUM, BOOK, MAX_LIST, _r, site_signals

QUERIES: dict = {}
ORACLE: dict = {}


def q(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- the published codebook over page texts -----------------------------------
_KEYS = [i["inputKey"] for d in PUBLISHED["dimensions"] for i in d["indicators"]]
_FLAGS = [k for k in _KEYS if k.endswith(".present")]
_COUNTS = [k for k in _KEYS if k.endswith(".count")]


def _word(key: str) -> str:
    """The word of a signal's path that stands for it in a text: its last part but "present"."""
    return key.split(".")[-2].replace("_", " ")


def published_signals(spark, d) -> DataFrame:
    """One row per site: a flag is true if a page of its domain holds the signal's word, counts are pages by length, null without pages."""
    docs = table(spark, d, "documents", "domain", F.lower("text").alias("t"), "n_chars").where("domain is not null")
    flags = [F.max(F.coalesce(F.contains("t", F.lit(_word(k))), F.lit(False))).alias(k) for k in _FLAGS]
    counts = [F.count_if(F.col("n_chars") % 4 == i).alias(k) for i, k in enumerate(_COUNTS)]
    pages = docs.groupBy("domain").agg(*flags, *counts, F.count("*").alias("_n"))
    sites = table(spark, d, "sites", F.col("id").alias("site_id"), "domain", "hwo_uid", "hwo_provenance", "bundesland")
    trades = bounded_broadcast(table(spark, d, "gewerke", "hwo_uid", "gewerk_group"), MAX_LIST)
    out = sites.join(pages, "domain", "left").join(trades, "hwo_uid", "left")
    consent = F.when(F.col("_n") >= 3, "granular_with_revoke").when(F.col("_n") == 2, "accept_only").when(F.col("_n") == 1, "other")
    state = F.when(F.col("hwo_provenance") == "llm", "unreachable").when(F.col("hwo_provenance") == "name", "not_applicable").when(F.col("hwo_provenance") == "manual", "forbidden")
    return out.select(
        "site_id", *[F.col(f"`{k}`") for k in _FLAGS + _COUNTS], consent.alias("privacy.consent.quality"), F.create_map(*[x for k in _KEYS for x in (F.lit(k), state)]).alias("status"),
        F.coalesce("gewerk_group", F.lit("unclassified")).alias("gewerk_group"), F.coalesce("bundesland", F.lit("unknown")).alias("bundesland"),
    )


def _missing_sql(m: dict, what: tuple[str, str]) -> str:
    """SQL of one figure of the policy: ``what`` is its value for zero and for the others."""
    zero, other = what
    if m["kind"] != "conditional":
        return zero if m["kind"] == "zero" else other
    cases = " ".join(f"WHEN '{s}' THEN {zero if k == 'zero' else other}" for s, k in m["states"].items())
    return f"CASE coalesce(st,'absent') {cases} ELSE {zero if m['default'] == 'zero' else other} END"


def book_sql(book: dict) -> str:
    """CTEs tr, dims and ov over sig(site_id, st, one quoted column per signal)."""
    rows = []
    for d in book["dimensions"]:
        for i in d["indicators"]:
            c, r, w = f'"{i["inputKey"]}"', i["rule"], i["weight"]
            if r["type"] == "bool":
                score = f"CASE WHEN {c} THEN 100.0 ELSE 0.0 END"
            elif r["type"] == "enum":
                score = f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}.0" for k, v in r["cases"].items()) + f" ELSE {r['defaultScore']}.0 END"
            else:
                score = f"100.0::DOUBLE + (least(greatest({c}, {r['min']}), {r['max']}) - {r['min']})::DOUBLE / {r['max'] - r['min']} * -100.0"
            gone = f"{c} IS NULL"
            rows.append(
                f"SELECT site_id, '{d['id']}' AS dimension, '{i['id']}' AS indicator, {w}::DOUBLE AS declared, (CASE WHEN {gone} THEN {_missing_sql(i['missing'], ('0.0', 'NULL'))} ELSE {score} END)::DOUBLE AS score, "
                f"(CASE WHEN {gone} THEN {_missing_sql(i['missing'], (str(w), '0.0'))} ELSE {w} END)::DOUBLE AS weight, (CASE WHEN {gone} THEN {_missing_sql(i['missing'], ('1.0', '0.0'))} ELSE 1.0 END)::DOUBLE AS confidence FROM sig"
            )
    weight = "CASE dimension " + " ".join(f"WHEN '{d['id']}' THEN {d['weight']}" for d in book["dimensions"]) + " END::DOUBLE"
    return (
        "tr AS (" + " UNION ALL ".join(rows) + "), "
        "dims AS (SELECT site_id, dimension, CASE WHEN sum(weight)>0 THEN sum(coalesce(score,0)*weight)/sum(weight) END AS s, CASE WHEN sum(weight)>0 THEN floor(sum(confidence*weight)/sum(weight)*100+0.5)/100 ELSE 0 END AS c, "
        f"sum(weight)/sum(declared)*{weight} AS e FROM tr GROUP BY 1,2), "
        "ov AS (SELECT site_id, floor(round(sum(s*e)/sum(e), 9)*100+0.5)/100 AS overall, floor(round(sum(c*e)/sum(e), 9)*100+0.5)/100 AS confidence FROM dims WHERE s IS NOT NULL GROUP BY 1)"
    )


_PUB = (
    "pages AS (SELECT domain, " + ", ".join(f"bool_or(coalesce(contains(lower(text), '{_word(k)}'), false)) AS \"{k}\"" for k in _FLAGS) + ", "
    + ", ".join(f"count_if(n_chars % 4 = {i}) AS \"{k}\"" for i, k in enumerate(_COUNTS)) + ", count(*) AS np FROM documents WHERE domain IS NOT NULL GROUP BY 1), "
    "sig AS (SELECT s.id AS site_id, pages.* EXCLUDE (domain, np), CASE WHEN np >= 3 THEN 'granular_with_revoke' WHEN np = 2 THEN 'accept_only' WHEN np = 1 THEN 'other' END AS \"privacy.consent.quality\", "
    "CASE hwo_provenance WHEN 'llm' THEN 'unreachable' WHEN 'name' THEN 'not_applicable' WHEN 'manual' THEN 'forbidden' END AS st, "
    "coalesce(g.gewerk_group,'unclassified') AS gewerk_group, coalesce(s.bundesland,'unknown') AS bundesland FROM sites s LEFT JOIN pages ON pages.domain = s.domain LEFT JOIN gewerke g ON g.hwo_uid = s.hwo_uid), " + book_sql(PUBLISHED)
)


@q(f"WITH {_PUB} SELECT site_id, dimension, indicator, {_r('score')} AS score, weight, confidence FROM tr")
def published_traces(spark, d):
    """One row per site and indicator of the published codebook."""
    t = traces(published_signals(spark, d), PUBLISHED, "site_id", status="status")
    return t.select("site_id", "dimension", "indicator", js_round("score").alias("score"), "weight", "confidence")


def _published(spark, d):
    return scores(published_signals(spark, d), PUBLISHED, "site_id", ("gewerk_group", "bundesland"), "status")


@q(f"WITH {_PUB} SELECT sig.site_id, overall, confidence FROM sig LEFT JOIN ov USING (site_id)")
def published_overall(spark, d):
    return _published(spark, d).select("site_id", "overall", "confidence")


_AXES = "GROUPING SETS ((dimension), (dimension, gewerk_group), (dimension, bundesland))"


@q(f"""WITH {_PUB}, l AS (SELECT site_id, dimension, {_r('round(s, 9)')} AS score FROM dims WHERE s IS NOT NULL UNION ALL SELECT site_id, '', overall FROM ov),
j AS (SELECT l.*, gewerk_group, bundesland FROM l JOIN sig USING (site_id))
SELECT CASE WHEN grouping(gewerk_group)=0 THEN 'gewerk_group' WHEN grouping(bundesland)=0 THEN 'bundesland' ELSE 'overall' END AS axis, coalesce(gewerk_group, bundesland, 'all') AS value,
CASE WHEN dimension = '' THEN 'overall' ELSE 'dimension' END AS stat_type, nullif(dimension,'') AS dimension, {_SUM.format(c='score')} FROM j GROUP BY {_AXES}""")
def published_cohorts(spark, d):
    """Summaries overall and of every dimension, over all sites and along each axis by itself, in one pass."""
    wide = _published(spark, d)
    rows = [F.struct(F.lit(x["id"]).alias("dimension"), F.col(x["id"])["score"].alias("score")) for x in PUBLISHED["dimensions"]] + [F.struct(F.lit("").alias("dimension"), F.col("overall").alias("score"))]
    long = wide.select("gewerk_group", "bundesland", F.explode(F.array(*rows)).alias("x")).select("gewerk_group", "bundesland", "x.*").where("score is not null")
    g = long.groupingSets([["dimension"], ["dimension", "gewerk_group"], ["dimension", "bundesland"]], "dimension", "gewerk_group", "bundesland").agg(F.grouping("gewerk_group").alias("_g"), F.grouping("bundesland").alias("_b"), *summary("score"))
    axis = F.when(F.col("_g") == 0, "gewerk_group").when(F.col("_b") == 0, "bundesland").otherwise("overall")
    return g.select(
        axis.alias("axis"), F.coalesce("gewerk_group", "bundesland", F.lit("all")).alias("value"), F.when(F.col("dimension") == "", "overall").otherwise("dimension").alias("stat_type"),
        F.nullif("dimension", F.lit("")).alias("dimension"), "n", "mean", "p10", "p25", "p50", "p75", "p90", "min", "max",
    )


@q(f"WITH {_PUB} SELECT dimension, count(*) AS n, {_r('quantile_cont(round(s, 9), 0.75)')} AS p75, min(e) FILTER (e > 0) > 0 AS counted FROM dims WHERE s IS NOT NULL GROUP BY 1")
def dimension_export(spark, d):
    """Per dimension the sites that have it, its upper quartile, and whether it counts at all."""
    wide = _published(spark, d)
    long = dimensions(wide, PUBLISHED, "site_id").where("score is not null")
    return long.groupBy("dimension").agg(F.count("*").alias("n"), js_round(F.percentile("score", F.lit(0.75))).alias("p75"), (F.min(F.when(F.col("effective_weight") > 0, F.col("effective_weight"))) > 0).alias("counted"))


# ---- joins of pages, sites, scores and states ----------------------------------
@q("SELECT DISTINCT d.doc_id, s.id AS site_id, s.domain FROM documents d JOIN sites s ON s.domain = d.domain")
def observation_domains(spark, d):
    return table(spark, d, "documents", "doc_id", "domain").join(table(spark, d, "sites", F.col("id").alias("site_id"), "domain"), "domain").select("doc_id", "site_id", "domain").distinct()


@q("SELECT s.id AS site_id, d.doc_id, sha256(d.text) AS sha FROM documents d JOIN sites s ON s.domain = d.domain WHERE d.source = 'impressum'")
def homepage_contents(spark, d):
    docs = table(spark, d, "documents", "doc_id", "domain", "source", "text").where("source = 'impressum'").select("doc_id", "domain", F.sha2("text", 256).alias("sha"))
    return docs.join(table(spark, d, "sites", F.col("id").alias("site_id"), "domain"), "domain").select("site_id", "doc_id", "sha")


_DOMAIN_OF = "m AS (SELECT sha256(d.text) AS h, max(s.domain) AS domain FROM documents d JOIN sites s ON s.domain = d.domain GROUP BY 1) "


def _domain_of(spark, d):
    docs = table(spark, d, "documents", "doc_id", F.sha2("text", 256).alias("h"), "domain")
    return docs, docs.join(table(spark, d, "sites", "domain"), "domain", "left_semi").where("h is not null").groupBy("h").agg(F.max("domain").alias("of"))


@q(f"WITH {_DOMAIN_OF} SELECT d.doc_id, m.domain FROM documents d JOIN m ON m.h = sha256(d.text)")
def content_domain_lookup(spark, d):
    """The domain of every content: one per hash, the greatest."""
    docs, of = _domain_of(spark, d)
    return docs.join(of, "h").select("doc_id", F.col("of").alias("domain"))


@q(f"WITH {_DOMAIN_OF} SELECT count(*) AS unmatched FROM documents d WHERE d.text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m WHERE m.h = sha256(d.text))")
def content_unmatched(spark, d):
    docs, of = _domain_of(spark, d)
    return docs.where("h is not null").join(of, "h", "left_anti").agg(F.count("*").alias("unmatched"))


@q("WITH a AS (SELECT site_id, bool_or(confidence >= 0.6) AS ok FROM scores GROUP BY 1) SELECT d.doc_id, s.id AS site_id, ok FROM documents d JOIN sites s ON s.domain = d.domain LEFT JOIN a ON a.site_id = s.id WHERE ok IS NULL OR ok")
def audit_ok_guard(spark, d):
    """Pages of sites whose audit succeeded; a site without an audit passes."""
    audits = table(spark, d, "scores", "site_id", "confidence").groupBy("site_id").agg(F.max(F.col("confidence") >= 0.6).alias("ok"))
    pages = table(spark, d, "documents", "doc_id", "domain").join(table(spark, d, "sites", F.col("id").alias("site_id"), "domain"), "domain")
    return pages.join(audits, "site_id", "left").where("ok is null or ok").select("doc_id", "site_id", "ok")


_MART = "FROM scores sc JOIN sites s ON s.id = sc.site_id JOIN asset_states st ON st.domain = s.domain AND st.period = substr(sc.scoring_run_id, 7, 7)"


def _mart(spark, d, *columns):
    sc = table(spark, d, "scores", F.col("id").alias("score_id"), "site_id", "scoring_run_id", "overall_score").withColumn("period", F.substring("scoring_run_id", 7, 7))
    st = table(spark, d, "asset_states", "asset_id", "domain", "period", *columns)
    return sc.join(table(spark, d, "sites", F.col("id").alias("site_id"), "domain"), "site_id").join(st, ["domain", "period"])


@q(f"SELECT sc.id AS score_id, st.asset_id, st.run_id, coalesce(g.gewerk_name,'unknown') AS trade {_MART} LEFT JOIN gewerke g ON g.hwo_uid = st.hwo_uid AND g.gewerk_group = 'BauAusbau'")
def mart_scores(spark, d):
    """Scores with the state their run saw and the trade's name in one system of groups."""
    g = bounded_broadcast(table(spark, d, "gewerke", "hwo_uid", "gewerk_name", "gewerk_group").where("gewerk_group = 'BauAusbau'").select("hwo_uid", "gewerk_name"), MAX_LIST)
    return _mart(spark, d, "hwo_uid", "run_id").join(g, "hwo_uid", "left").select("score_id", "asset_id", "run_id", F.coalesce("gewerk_name", F.lit("unknown")).alias("trade"))


@q(f"WITH {_SIG}, w AS (SELECT site_id, dimension, indicator FROM tr WHERE score < 60) SELECT sc.id AS score_id, st.asset_id, w.dimension, w.indicator {_MART} JOIN w ON w.site_id = sc.site_id WHERE st.valid_to IS NULL AND sc.overall_score >= 0 AND sc.overall_score < 20")
def mart_traces(spark, d):
    """Weak indicators of weak scores, with their current state."""
    weak = traces(site_signals(spark, d), BOOK, "site_id").where("score < 60").select("site_id", "dimension", "indicator")
    return _mart(spark, d, "valid_to").where("valid_to is null and overall_score >= 0 and overall_score < 20").join(weak, "site_id").select("score_id", "asset_id", "dimension", "indicator")


@q(f"WITH {_SIG} SELECT sc.scoring_run_id, dimension, count(*) AS n, floor(sum(floor(s*100+0.5))::DOUBLE/count(*)+0.5)/100 AS mean FROM dims JOIN scores sc ON sc.site_id = dims.site_id WHERE s IS NOT NULL GROUP BY 1,2")
def run_dimensions(spark, d):
    """Mean score of every dimension over the sites that a run scored."""
    long = dimensions(scores(site_signals(spark, d), BOOK, "site_id"), BOOK, "site_id").where("score is not null").select("site_id", "dimension", F.floor(F.col("score") * 100 + 0.5).alias("h"))
    g = long.join(table(spark, d, "scores", "site_id", "scoring_run_id"), "site_id").groupBy("scoring_run_id", "dimension")
    return g.agg(F.count("*").alias("n"), (F.floor(F.sum("h") / F.count("*") + 0.5) / 100.0).alias("mean"))


@q("SELECT DISTINCT s.bundesland, d.source FROM sites s JOIN documents d ON d.domain = s.domain")
def profile_pairs(spark, d):
    return table(spark, d, "sites", "domain", "bundesland").join(table(spark, d, "documents", "domain", "source"), "domain").select("bundesland", "source").distinct()


_INDEX = [(x["id"], i["id"], k, i["rule"]["type"]) for x in BOOK["dimensions"] for k, i in enumerate(x["indicators"])]


@q(f"WITH {_SIG}, ix(dimension, indicator, pos, rule) AS (VALUES {', '.join(map(str, _INDEX))}) SELECT site_id, tr.dimension, tr.indicator, pos::BIGINT AS pos, rule FROM tr LEFT JOIN ix ON ix.dimension = tr.dimension AND ix.indicator = tr.indicator")
def trace_index(spark, d):
    """Traces beside the place and rule of their indicator."""
    ix = spark.createDataFrame(_INDEX, "dimension string, indicator string, pos long, kind string")
    t = traces(site_signals(spark, d), BOOK, "site_id").select("site_id", "dimension", "indicator")
    return t.join(F.broadcast(ix), ["dimension", "indicator"], "left").select("site_id", "dimension", "indicator", "pos", F.col("kind").alias("rule"))


# ---- resolution of states and trades ----------------------------------------
_PLACE = r"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '\s*[-/(].*$', ''), '(^|[^a-z0-9_])ot\s+.*$', '\1'), '[.,]', '', 'g'))"


@q(f"""WITH z AS (SELECT zipcode, min(state) AS state FROM zipcodes GROUP BY 1), pl AS (SELECT {_PLACE.format(c='place')} AS p, min(state) AS state FROM zipcodes GROUP BY 1 HAVING count(DISTINCT state) = 1),
v AS (SELECT site_id, s.id, 0 AS k, z.state FROM site_source_seeds s JOIN z ON z.zipcode = trim(s.postal_code) UNION ALL SELECT site_id, s.id, 1, pl.state FROM site_source_seeds s JOIN pl ON pl.p = {_PLACE.format(c='s.city')} WHERE pl.p <> ''),
c AS (SELECT site_id, state, count(*) AS n, arg_min(k, id*2+k) AS k FROM v GROUP BY 1,2),
m AS (SELECT site_id, count(*) AS nc, max(n) AS mx, max(n) FILTER (k = 0) AS mp, min(k) AS k1 FROM c GROUP BY 1),
t AS (SELECT c.site_id, min(state) AS state, count(*) AS ties FROM c JOIN m USING (site_id) WHERE CASE WHEN mp IS NOT NULL THEN k = 0 AND n = mp ELSE n = mx END GROUP BY 1)
SELECT s.id AS site_id, state, CASE WHEN nc IS NULL THEN 'unresolved' WHEN nc = 1 THEN CASE k1 WHEN 0 THEN 'postal-consensus' ELSE 'city-unique' END
  WHEN mp IS NOT NULL THEN CASE WHEN ties = 1 AND mp = mx THEN 'postal-majority' ELSE 'postal-tie-breaker' END WHEN ties = 1 THEN 'city-majority' ELSE 'city-tie-breaker' END AS method,
  CASE WHEN nc IS NULL THEN 'none' WHEN nc = 1 THEN CASE k1 WHEN 0 THEN 'high' ELSE 'medium' END WHEN mp IS NOT NULL AND ties = 1 AND mp > 1 THEN 'medium' ELSE 'low' END AS confidence
FROM sites s LEFT JOIN m ON m.site_id = s.id LEFT JOIN t ON t.site_id = s.id""")
def geo_vote(spark, d):
    """State of every site by the votes of its listings' postal codes and towns."""
    seeds = table(spark, d, "site_source_seeds", "id", "site_id", "postal_code", "city")
    z = table(spark, d, "zipcodes", "zipcode", "place", "state")
    found = resolve_state(seeds, z)
    return table(spark, d, "sites", F.col("id").alias("site_id")).join(found, "site_id", "left").select("site_id", "state", F.coalesce("method", F.lit("unresolved")).alias("method"), F.coalesce("confidence", F.lit("none")).alias("confidence"))


#: Words that tell a group of trades where no trade is named.
GROUP_WORDS = ("bau", "ausbau", "gewerblich", "kfz", "lebensmittel", "gesundheit", "privat")


@q(f"""WITH t AS (SELECT s.id, lower(concat_ws(' ', min(c.category), min(c.business_name))) AS t FROM sites s LEFT JOIN site_source_seeds c ON c.site_id = s.id GROUP BY 1),
e AS (SELECT hwo_uid, lower(gewerk_name) AS name, lower(replace(gewerk_name,'handwerk','')) AS alias FROM gewerke),
a AS (SELECT t.id, arg_min(hwo_uid, (-length(name), hwo_uid)) AS uid FROM t JOIN e ON contains(t.t, e.name) GROUP BY 1), b AS (SELECT t.id, arg_min(hwo_uid, (-length(alias), hwo_uid)) AS uid FROM t JOIN e ON contains(t.t, e.alias) GROUP BY 1)
SELECT t.id, coalesce(a.uid, b.uid) AS hwo_uid, CASE WHEN a.uid IS NOT NULL THEN 0.95 WHEN b.uid IS NOT NULL THEN 0.75 WHEN {' OR '.join(f"contains(t.t, '{w}')" for w in GROUP_WORDS)} THEN 0.5 END::DOUBLE AS confidence,
CASE WHEN a.uid IS NOT NULL THEN 'entry_keyword' WHEN b.uid IS NOT NULL THEN 'entry_alias' WHEN {' OR '.join(f"contains(t.t, '{w}')" for w in GROUP_WORDS)} THEN 'heuristic_group_only' ELSE 'unclassified' END AS provenance
FROM t LEFT JOIN a ON a.id = t.id LEFT JOIN b ON b.id = t.id""")
def classify_ladder(spark, d):
    """Trade of a site by its texts: a trade's name, else its alias, else a word of a group."""
    c = table(spark, d, "site_source_seeds", "site_id", "category", "business_name").groupBy("site_id").agg(F.min("category").alias("category"), F.min("business_name").alias("name"))
    t = table(spark, d, "sites", "id").join(c, F.col("id") == F.col("site_id"), "left").select("id", F.lower(F.concat_ws(" ", "category", "name")).alias("t"))
    e = table(spark, d, "gewerke", "hwo_uid", F.lower("gewerk_name").alias("name"), F.lower(F.replace("gewerk_name", F.lit("handwerk"), F.lit(""))).alias("alias"))
    a = contained_term(t, "t", e.select("hwo_uid", F.col("name").alias("term"))).withColumnRenamed("hwo_uid", "_a")
    b = contained_term(t, "t", e.select("hwo_uid", F.col("alias").alias("term"))).withColumnRenamed("hwo_uid", "_b")
    group = F.lit(False)
    for w in GROUP_WORDS:
        group = group | F.contains("t", F.lit(w))
    ladder = lambda *v: F.when(F.col("_a").isNotNull(), v[0]).when(F.col("_b").isNotNull(), v[1]).when(group, v[2]).otherwise(v[3])
    return t.join(a, "t", "left").join(b, "t", "left").select(
        "id", F.coalesce("_a", "_b").alias("hwo_uid"), ladder(0.95, 0.75, 0.5, F.lit(None).cast("double")).alias("confidence"), ladder("entry_keyword", "entry_alias", "heuristic_group_only", "unclassified").alias("provenance"))


# ---- versions, vault, counts ---------------------------------------------------
_STATE = "coalesce(gewerk_group,'~') || '|' || coalesce(bundesland,'~')"


@q(f"""WITH u AS (SELECT asset_id, valid_from, arg_max({_STATE}, (recorded_at, {_STATE})) AS s FROM asset_states GROUP BY 1,2), l AS (SELECT *, lag(s) OVER (PARTITION BY asset_id ORDER BY valid_from) AS p FROM u),
n AS (SELECT asset_id, valid_from, s FROM l WHERE p IS NULL OR p <> s), last AS (SELECT max(period) AS period FROM asset_states), gone AS (SELECT asset_id, max(period) AS seen, max(valid_from) AS at FROM asset_states GROUP BY 1)
SELECT n.asset_id, n.valid_from, s AS state, coalesce(lead(n.valid_from) OVER (PARTITION BY n.asset_id ORDER BY n.valid_from), CASE WHEN seen < last.period THEN gone.at END) AS closed_at FROM n JOIN gone ON gone.asset_id = n.asset_id, last""")
def scd2_close_open(spark, d):
    """Versions opened on change and closed by the next; those of assets that the last period no longer saw expire with their last row."""
    t = table(spark, d, "asset_states", "asset_id", "valid_from", "recorded_at", "gewerk_group", "bundesland", "period")
    state = F.concat_ws("|", F.coalesce("gewerk_group", F.lit("~")), F.coalesce("bundesland", F.lit("~")))
    u = t.groupBy("asset_id", "valid_from").agg(F.max_by(state, F.struct(F.col("recorded_at"), state)).alias("state"))
    w = Window.partitionBy("asset_id").orderBy("valid_from")
    new = u.withColumn("_p", F.lag("state").over(w)).where("_p is null or _p <> state").drop("_p")
    seen = t.groupBy("asset_id").agg(F.max("period").alias("_seen"), F.max("valid_from").alias("_at"))
    last = t.groupBy().agg(F.max("period").alias("_last"))  # one row
    out = new.withColumn("_next", F.lead("valid_from").over(w)).join(seen, "asset_id").join(F.broadcast(last))
    return out.select("asset_id", "valid_from", "state", F.coalesce("_next", F.when(F.col("_seen") < F.col("_last"), F.col("_at"))).alias("closed_at"))


@q("SELECT asset_id, period, run_id, recorded_at, row_number() OVER (PARTITION BY asset_id ORDER BY recorded_at, period, run_id, valid_from, coalesce(gewerk_group,''), coalesce(bundesland,'')) AS pos FROM asset_states")
def vault_by_asset(spark, d):
    """The rows of every asset in the order they were recorded."""
    t = table(spark, d, "asset_states", "asset_id", "period", "run_id", "recorded_at", "valid_from", "gewerk_group", "bundesland")
    w = Window.partitionBy("asset_id").orderBy("recorded_at", "period", "run_id", "valid_from", F.coalesce("gewerk_group", F.lit("")), F.coalesce("bundesland", F.lit("")))
    return t.select("asset_id", "period", "run_id", "recorded_at", F.row_number().over(w).alias("pos"))


@q("SELECT source, count(*) AS n, floor(avg(n_chars)*10+0.5)/10 AS mean_chars, CASE WHEN count_if(lang='de') > 0 THEN floor(avg(n_chars) FILTER (lang='de')*10+0.5)/10 END AS mean_chars_de FROM documents GROUP BY 1")
def audit_averages(spark, d):
    """Means with one decimal, also over the rows that succeeded (null if none did)."""
    good = F.when(F.col("lang") == "de", F.col("n_chars"))
    return table(spark, d, "documents", "source", "n_chars", "lang").groupBy("source").agg(F.count("*").alias("n"), js_round(F.avg("n_chars"), 1).alias("mean_chars"), js_round(F.avg(good), 1).alias("mean_chars_de"))


#: Groups of trades in their official order.
ROMAN = {"BauHaupt": "I", "BauAusbau": "II", "Gewerblich": "III", "Kfz": "IV", "Nahrung": "V", "Gesundheit": "VI", "Privat": "VII"}


@q("WITH o(g, r, pos) AS (VALUES " + ", ".join(f"('{g}','{r}',{k})" for k, (g, r) in enumerate(ROMAN.items(), 1)) + """), n AS (SELECT g.gewerk_group AS g, count(*) AS n FROM sites s LEFT JOIN gewerke g ON g.hwo_uid = s.hwo_uid GROUP BY 1)
SELECT o.g AS grp, r AS code, pos::BIGINT AS pos, coalesce(n, 0) AS n FROM o LEFT JOIN n ON n.g = o.g UNION ALL SELECT 'unclassified', '-', 99, coalesce(sum(n), 0)::BIGINT FROM n WHERE g IS NULL OR g NOT IN (SELECT g FROM o)""")
def roman_order_dist(spark, d):
    """Sites by group in the order of the Roman codes, groups without sites with 0, the rest last."""
    g = bounded_broadcast(table(spark, d, "gewerke", "hwo_uid", "gewerk_group"), MAX_LIST)
    known = F.when(F.col("gewerk_group").isin(*ROMAN), F.col("gewerk_group")).otherwise("unclassified")
    n = table(spark, d, "sites", "hwo_uid").join(g, "hwo_uid", "left").groupBy(known.alias("grp")).agg(F.count("*").alias("n"))
    order = spark.createDataFrame([(x, r, k) for k, (x, r) in enumerate(ROMAN.items(), 1)] + [("unclassified", "-", 99)], "grp string, code string, pos long")
    return F.broadcast(order).join(n, "grp", "left").select("grp", "code", "pos", F.coalesce("n", F.lit(0)).alias("n"))


@q(r"SELECT doc_id, max(y) AS year FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?:©|\([cC]\)|[cC]opyright)\s*(?:\d{4}\s*[-–]\s*)?(\d{4})', 1))::INTEGER AS y FROM documents) WHERE y BETWEEN 1990 AND 2027 GROUP BY 1")
def copyright_year(spark, d):
    """The latest year that a copyright notice names."""
    years = F.regexp_extract_all("text", F.lit(r"(?:©|\([cC]\)|[cC]opyright)\s*(?:\d{4}\s*[-–]\s*)?(\d{4})"), F.lit(1))
    y = F.array_max(F.filter(F.transform(years, lambda x: x.cast("int")), lambda x: x.between(1990, 2027)))
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", y.alias("year")).where("year is not null")


@q(r"SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}')))::BIGINT AS emails, len(regexp_extract_all(text, '(?:(?:\+49|0049)[\s\-/.]?\d[\s\-/.]?(?:\d[\s\-/.]?){6,13}|0\d[\s\-/.]?(?:\d[\s\-/.]?){5,12})'))::BIGINT AS phones FROM documents WHERE text IS NOT NULL")
def email_phone_counts(spark, d):
    """Distinct e-mail addresses and telephone numbers of every page."""
    mails = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}"), F.lit(0)))
    phones = F.regexp_extract_all("text", F.lit(r"(?:(?:\+49|0049)[\s\-/.]?\d[\s\-/.]?(?:\d[\s\-/.]?){6,13}|0\d[\s\-/.]?(?:\d[\s\-/.]?){5,12})"), F.lit(0))
    return table(spark, d, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.size(mails).cast("long").alias("emails"), F.size(phones).cast("long").alias("phones"))


@q("SELECT period, count(DISTINCT run_id) AS runs, count(DISTINCT run_id) = 1 AS is_unique, max(recorded_at) AS published FROM asset_states GROUP BY 1")
def unique_periods(spark, d):
    """Runs per period, whether there is only one, and when the last was recorded."""
    return table(spark, d, "asset_states", "period", "run_id", "recorded_at").groupBy("period").agg(F.countDistinct("run_id").alias("runs"), (F.countDistinct("run_id") == 1).alias("is_unique"), F.max("recorded_at").alias("published"))


@q(f"WITH c AS (SELECT s.bundesland, g.gewerk_group, {_r('avg(sc.overall_score)', 1)} AS m FROM scores sc JOIN sites s ON s.id = sc.site_id JOIN gewerke g ON g.hwo_uid = s.hwo_uid WHERE sc.overall_score >= 0 AND NOT isnan(sc.overall_score) AND s.bundesland IS NOT NULL GROUP BY 1,2) SELECT bundesland, {_r('sum(floor(m*10+0.5))/count(*)/10', 1)} AS row_mean, min(m) AS lo, max(m) AS hi FROM c GROUP BY 1")
def heatmap_rows(spark, d):
    """Per state the plain mean of its cells, and the ends of the colour scale."""
    sc = table(spark, d, "scores", "site_id", "overall_score").where("overall_score >= 0 and not isnan(overall_score)")
    s = table(spark, d, "sites", F.col("id").alias("site_id"), "hwo_uid", "bundesland").where("bundesland is not null")
    g = bounded_broadcast(table(spark, d, "gewerke", "hwo_uid", "gewerk_group"), MAX_LIST)
    cells = sc.join(s, "site_id").join(g, "hwo_uid").groupBy("bundesland", "gewerk_group").agg(js_round(F.avg("overall_score"), 1).alias("m"))
    return cells.groupBy("bundesland").agg(js_round(F.sum(F.floor(F.col("m") * 10 + 0.5)) / F.count("*") / 10, 1).alias("row_mean"), F.min("m").alias("lo"), F.max("m").alias("hi"))


#: Figures of a page audit and where its report holds them; scores are shares, shown in percent.
METRICS = {
    "performance": ("categories.performance.score", 100), "accessibility": ("categories.accessibility.score", 100), "best_practices": ("categories['best-practices'].score", 100), "seo": ("categories.seo.score", 100),
    "lcp_ms": ("audits['largest-contentful-paint'].numericValue", 1), "cls": ("audits['cumulative-layout-shift'].numericValue", 1), "tbt_ms": ("audits['total-blocking-time'].numericValue", 1),
}


def audit_metrics(report: str) -> list[Column]:
    """The seven figures of an audit report as JSON; null where the report lacks one."""
    out = []
    for name, (path, factor) in METRICS.items():
        x = F.get_json_object(report, "$." + path).try_cast("double")
        out.append((F.floor(x * factor + 0.5) if factor == 100 else x).alias(name))
    return out


@q("SELECT event_id, floor((value/100.0::DOUBLE)*100+0.5)::BIGINT AS performance, NULL::BIGINT AS accessibility, 90::BIGINT AS best_practices, floor(0.5::DOUBLE*100+0.5)::BIGINT AS seo, value AS lcp_ms, 0.1::DOUBLE AS cls, NULL::DOUBLE AS tbt_ms FROM events")
def lighthouse_metrics(spark, d):
    """Reports are built from the events' values, so that every figure and every gap occurs."""
    e = table(spark, d, "events", "event_id", "value").withColumn("report", F.to_json(F.struct(
        F.struct(F.struct((F.col("value") / 100).alias("score")).alias("performance"), F.struct(F.lit(0.9).alias("score")).alias("best-practices"), F.struct(F.lit(0.5).alias("score")).alias("seo")).alias("categories"),
        F.struct(F.struct(F.col("value").alias("numericValue")).alias("largest-contentful-paint"), F.struct(F.lit(0.1).alias("numericValue")).alias("cumulative-layout-shift")).alias("audits"),
    )))
    return e.select("event_id", *audit_metrics("report"))


#: Grades of accessibility violations.
IMPACTS = ("critical", "serious", "moderate", "minor")


@q("SELECT user_id, " + ", ".join(f"sum(CASE WHEN event_id % 4 = {i} THEN coalesce((props->>'$.k')::BIGINT, 1) ELSE 0 END)::BIGINT AS {n}" for i, n in enumerate(IMPACTS)) + " FROM events WHERE event_type = 'error' GROUP BY 1")
def violation_impacts(spark, d):
    """Violations by impact, weighted by their nodes; a missing number of nodes counts as one."""
    nodes = F.coalesce(F.get_json_object("props", "$.k").try_cast("long"), F.lit(1))
    e = table(spark, d, "events", "event_id", "user_id", "event_type", "props").where("event_type = 'error'")
    return e.groupBy("user_id").agg(*[F.sum(F.when(F.col("event_id") % 4 == i, nodes).otherwise(0)).alias(n) for i, n in enumerate(IMPACTS)])


@q("SELECT id, status FROM (SELECT id, hwo_uid, bundesland, CASE WHEN hwo_confidence IS NULL THEN 'new' WHEN hwo_confidence < 0.5 THEN 'retired' ELSE 'active' END AS status FROM sites) WHERE status = 'active' AND bundesland IN (SELECT DISTINCT bundesland FROM asset_states WHERE run_id = (SELECT max(run_id) FROM asset_states))")
def active_in_run(spark, d):
    """Active entries within the scope of the last run."""
    status = F.when(F.col("hwo_confidence").isNull(), "new").when(F.col("hwo_confidence") < 0.5, "retired").otherwise("active")
    sites = table(spark, d, "sites", "id", "hwo_confidence", "bundesland").select("id", "bundesland", status.alias("status")).where("status = 'active'")
    runs = table(spark, d, "asset_states", "run_id", "bundesland")
    last = runs.groupBy().agg(F.max("run_id").alias("run_id"))  # one row
    scope = runs.join(F.broadcast(last), "run_id").select("bundesland").distinct()
    return sites.join(scope, "bundesland", "left_semi").select("id", "status")


#: A key pair for the examples: the secret of the signer is no secret.
_SIGNER = bytes(range(32))


@q("""SELECT count(*) AS total, count_if(s = 0) AS valid, count_if(s <> 0) AS invalid, count_if(s = 2) AS parse_errors, count_if(s = 1) AS unknown_key, floor(count_if(s = 0)::DOUBLE / count(*) * 10000 + 0.5) / 100 AS rate
FROM (SELECT CASE WHEN run_id LIKE '%-b' THEN 1 WHEN period = '2024-q2' THEN 2 WHEN period = '2025-q1' THEN 3 ELSE 0 END AS s FROM asset_states)""")
def vault_verification(spark, d):
    """Rows carry their run's signature; some runs have an unknown key, unreadable JSON or were changed after signing."""
    from ..functions.canonical_json import public_key, sign
    from ..operators.verification import signed_digest, verification_counts, verification_status
    from ..session import ship

    ship(spark)
    rows = table(spark, d, "asset_states", "run_id", "period")
    told = F.to_json(F.struct("period", "run_id"))

    def signatures(batches):
        for pdf in batches:
            yield pdf.assign(signature=[sign(_SIGNER, bytes.fromhex(x)).hex() for x in pdf["digest"]])

    runs = rows.distinct().withColumn("digest", signed_digest(told)).mapInPandas(signatures, "run_id string, period string, digest string, signature string").drop("digest")
    obs = F.when(F.col("period") == "2024-q2", "{broken").when(F.col("period") == "2025-q1", F.replace(told, F.lit("run"), F.lit("changed"))).otherwise(told)
    signed = rows.join(runs, ["run_id", "period"]).select(obs.alias("obs_json"), "signature", F.when(F.col("run_id").endswith("-b"), "other").otherwise("k1").alias("signing_key_id"))
    keys = spark.createDataFrame([("k1", public_key(_SIGNER).hex())], "key_id string, public_key string")
    return verification_counts(verification_status(signed, keys))

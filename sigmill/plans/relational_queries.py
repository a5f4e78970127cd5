"""Queries on the site, asset and benchmark tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.num import js_round, percent, summary
from ..operators import cohorts as C
from ..operators import observations as O
from ..operators import upserts as U
from ..operators.codebook import traces
from ..operators.history import fold_label
from ..operators.resolution import contained_term
from ..sources.tables import bounded_broadcast, table
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


# ---- ids, texts, addresses ------------------------------------------------
@q("SELECT id, 'da-' || substr(sha256('observatory:asset:' || lower(trim(domain))), 1, 32) AS asset_id FROM sites")
def asset_id(spark, d):
    return table(spark, d, "sites", "id", "domain").select("id", S.asset_id("domain").alias("asset_id"))


@q("SELECT id, 'pub_' || substr(sha256('public:salt:da-' || substr(sha256('observatory:asset:' || lower(trim(domain))), 1, 32)), 1, 16) AS public_id FROM sites")
def public_asset_id(spark, d):
    return table(spark, d, "sites", "id", "domain").select("id", S.public_id(S.asset_id("domain"), "salt").alias("public_id"))


@q("SELECT run_id, min(substr(sha256(run_id), 1, 6)) AS sha6, count(*) AS n FROM asset_states GROUP BY 1")
def run_id_sha6(spark, d):
    return table(spark, d, "asset_states", "run_id").groupBy("run_id").agg(F.min(F.substring(F.sha2("run_id", 256), 1, 6)).alias("sha6"), F.count("*").alias("n"))


_HOST = r"nullif(regexp_replace(regexp_replace(regexp_extract(lower(trim(website_url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:\s]+)', 1), '\.+$', ''), '^www\.', ''), '')"


@q(f"WITH h AS (SELECT id, {_HOST} AS h FROM site_source_seeds WHERE website_url IS NOT NULL) SELECT id, CASE WHEN contains(h, '.') AND NOT regexp_matches(h, '^\\d+(\\.\\d+){{3}}$') THEN h END AS domain FROM h")
def domain_normalize(spark, d):
    return table(spark, d, "site_source_seeds", "id", "website_url").where("website_url is not null").select("id", S.normalise_domain("website_url").alias("domain"))


@q("SELECT id, regexp_extract(domain, '([^.]+\\.[^.]+)$', 1) AS registrable FROM sites")
def registrable_domain(spark, d):
    return table(spark, d, "sites", "id", "domain").select("id", S.registrable_domain("domain").alias("registrable"))


@q("""WITH u AS (SELECT id, regexp_replace(trim(website_url), '#.*$', '') AS u FROM site_source_seeds WHERE website_url LIKE '%://%'),
p AS (SELECT id, lower(regexp_extract(u, '^([A-Za-z]+://[^/?]+)', 1)) AS h, regexp_replace(u, '^[A-Za-z]+://[^/?]+', '') AS r FROM u)
SELECT id, CASE WHEN h <> '' THEN h || CASE WHEN r = '' THEN '/' WHEN r LIKE '?%' THEN '/' || r ELSE r END END AS url FROM p""")
def url_normalize(spark, d):
    return table(spark, d, "site_source_seeds", "id", "website_url").where(F.col("website_url").contains("://")).select("id", S.normalise_page_url("website_url").alias("url"))


@q("WITH p AS (SELECT id, translate(phone, ' -/.' || chr(9) || chr(10) || chr(13) || chr(160), '') AS p FROM site_source_seeds WHERE phone IS NOT NULL) SELECT id, CASE WHEN p LIKE '0049%' THEN '+49' || substr(p, 5) WHEN p LIKE '0%' THEN '+49' || substr(p, 2) ELSE p END AS phone FROM p")
def phone_normalize(spark, d):
    return table(spark, d, "site_source_seeds", "id", "phone").where("phone is not null").select("id", S.normalise_phone("phone").alias("phone"))


@q("SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(lower(gemeinde), '\\s*[-/(].*$', ''), '(^|[^a-z0-9_])ot\\s+.*$', '\\1'), '[.,]', '', 'g')) AS place FROM sites WHERE gemeinde IS NOT NULL")
def place_normalize(spark, d):
    return table(spark, d, "sites", "id", "gemeinde").where("gemeinde is not null").select("id", S.place_key("gemeinde").alias("place"))


@q("""SELECT id, regexp_replace(regexp_replace(replace(replace(replace(replace(lower(category),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM site_source_seeds WHERE category IS NOT NULL""")
def slugify(spark, d):
    return table(spark, d, "site_source_seeds", "id", "category").where("category is not null").select("id", S.slug("category").alias("slug"))


_KEYS = ["elektro", "maler", "friseur", "tischler", "bäcker", "dach", "kfz"]


@q("SELECT id, CASE " + " ".join(f"WHEN contains(regexp_replace(lower(category), '[\\s\\-_/]', '', 'g'), '{k}') THEN '{k}'" for k in _KEYS) + " END AS keyword FROM site_source_seeds")
def keyword_first_match(spark, d):
    return table(spark, d, "site_source_seeds", "id", "category").select("id", S.first_keyword("category", _KEYS).alias("keyword"))


_STOPS = ["soziales-netz.test", "com.example"]


@q(f"""WITH t AS (SELECT id, website_url, {_HOST} AS h FROM site_source_seeds)
SELECT id, CASE WHEN website_url IS NULL OR trim(website_url) = '' THEN 'no_url' WHEN h IS NULL OR NOT contains(h, '.') THEN 'bad_url'
WHEN h IN ('soziales-netz.test','com.example') OR h LIKE '%.soziales-netz.test' OR h LIKE '%.com.example' THEN 'stop_domain' END AS reason FROM t""")
def stop_domain_triage(spark, d):
    t = table(spark, d, "site_source_seeds", "id", "website_url").withColumn("h", S.normalise_domain("website_url"))
    return t.select("id", F.when(S.blank_to_null("website_url").isNull(), "no_url").when(F.col("h").isNull(), "bad_url").when(S.is_stop_domain("h", _STOPS), "stop_domain").alias("reason"))


@q("SELECT DISTINCT period, substr(period,1,4)::BIGINT*4 + substr(period,7,1)::BIGINT - 1 AS idx, ((substr(period,1,4)::BIGINT*4 + substr(period,7,1)::BIGINT - 2)//4)::VARCHAR || '-q' || ((substr(period,1,4)::BIGINT*4 + substr(period,7,1)::BIGINT - 2)%4 + 1)::VARCHAR AS previous FROM asset_states")
def period_parse(spark, d):
    return table(spark, d, "asset_states", "period").distinct().select("period", S.period_index("period").alias("idx"), S.previous_period("period").alias("previous"))


@q("SELECT id, year(scored_at)::VARCHAR || '-q' || quarter(scored_at)::VARCHAR AS period, strftime(make_timestamp(epoch(scored_at)::BIGINT*1000000), '%Y-%m-%dT%H:%M:%S.000Z') AS iso FROM scores")
def epoch_iso(spark, d):
    t = table(spark, d, "scores", "id", "scored_at")
    return t.select("id", S.period_of("scored_at").alias("period"), S.iso_of_epoch(F.unix_timestamp(F.col("scored_at").cast("timestamp"))).alias("iso"))


@q("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events", "event_id", "props").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@q("SELECT id, (raw_json->>'$.pos')::BIGINT AS pos, raw_json->>'$.kat' AS kat FROM site_source_seeds")
def json_fence_strip(spark, d):
    t = table(spark, d, "site_source_seeds", "id", "raw_json").withColumn("s", F.concat(F.lit("Answer:\n```json\n"), "raw_json", F.lit("\n```\n")))
    inner = F.from_json(S.strip_json_fence("s"), "pos bigint, kat string")
    return t.select("id", inner["pos"].alias("pos"), inner["kat"].alias("kat"))


@q("""SELECT event_id, CASE WHEN event_type <> 'error' THEN NULL WHEN event_id % 7 = 0 THEN 'HTTP_5XX' WHEN event_id % 7 = 1 THEN 'ENOTFOUND' WHEN event_id % 7 = 2 THEN 'ECONNREFUSED' WHEN event_id % 7 = 3 THEN 'ETIMEDOUT'
WHEN event_id % 7 = 4 THEN 'SSL_ERROR' WHEN event_id % 7 = 5 THEN 'REDIRECT_LOOP' ELSE 'UNKNOWN' END AS class, event_type <> 'error' AS live FROM events""")
def error_taxonomy(spark, d):
    """Failed requests get a message or a 5xx answer in turn; views answer 404, which is a living site."""
    t = table(spark, d, "events", "event_id", "event_type")
    failed, turn = F.col("event_type") == "error", F.col("event_id") % 7
    said = F.element_at(F.array(*[F.lit(x) for x in ("", "getaddrinfo ENOTFOUND x.example", "connect ECONNREFUSED 1.2.3.4:443", "connect timed out", "self-signed certificate", "too many redirects", "socket hang up")]), (turn + 1).cast("int"))
    status = F.when(failed & (turn == 0), 503).when(failed, F.lit(None).cast("int")).when(F.col("event_type") == "view", 404).otherwise(200)
    return t.select("event_id", S.error_class(F.when(failed, said), status).alias("class"), S.is_live(status).alias("live"))


@q("""SELECT doc_id, try_cast(nullif(regexp_extract(text, '©\\s*(\\d{4})', 1), '') AS INTEGER) AS year, length(text) - length(replace(text, '@', '')) AS at_signs, len(regexp_extract_all(text, '[\\w.+-]+@[\\w-]+\\.[\\w.-]+')) AS emails FROM documents""")
def page_basics(spark, d):
    t = table(spark, d, "documents", "doc_id", "text")
    return t.select("doc_id", F.nullif(F.regexp_extract("text", r"©\s*(\d{4})", 1), F.lit("")).try_cast("int").alias("year"), (F.length("text") - F.length(F.replace("text", F.lit("@"), F.lit("")))).cast("long").alias("at_signs"), F.size(F.regexp_extract_all("text", F.lit(r"([\w.+-]+@[\w-]+\.[\w.-]+)"), F.lit(1))).cast("long").alias("emails"))


# ---- merge semantics -------------------------------------------------------
_SEEDKEY = ["site_id", "source_path", "source_item_key"]


@q("SELECT site_id, source_path, source_item_key, id, phone FROM (SELECT *, row_number() OVER (PARTITION BY site_id, source_path, source_item_key ORDER BY created_at DESC NULLS LAST, id DESC) AS rn FROM site_source_seeds) WHERE rn = 1")
def upsert_latest(spark, d):
    t = table(spark, d, "site_source_seeds", *_SEEDKEY, "created_at", "id", "phone")
    cut = F.col("id") % 2 == 0  # two deliveries; the key's latest row wins over both
    return U.upsert(t.where(cut), t.where(~cut), _SEEDKEY, ["created_at", "id"]).select(*_SEEDKEY, "id", "phone")


@q("""WITH o AS (SELECT * FROM asset_states WHERE period <= '2025-q1'), n AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY valid_from, recorded_at, bundesland NULLS FIRST, gewerk_group NULLS FIRST) AS rn FROM asset_states WHERE period > '2025-q1' AND asset_id NOT IN (SELECT asset_id FROM o))
SELECT asset_id, period, recorded_at FROM o UNION ALL SELECT asset_id, period, recorded_at FROM n WHERE rn = 1""")
def insert_ignore(spark, d):
    t = table(spark, d, "asset_states", "asset_id", "period", "recorded_at", "valid_from", "bundesland", "gewerk_group")
    out = U.insert_ignore(t.where("period <= '2025-q1'"), t.where("period > '2025-q1'"), ["asset_id"], [F.col("valid_from"), F.col("recorded_at"), F.col("bundesland").asc_nulls_first(), F.col("gewerk_group").asc_nulls_first()])
    return out.select("asset_id", "period", "recorded_at")


@q("""SELECT scoring_run_id, site_id, id FROM scores WHERE scored_at >= '2025-01-01' UNION ALL SELECT scoring_run_id, site_id, id FROM scores o WHERE scored_at < '2025-01-01' AND NOT EXISTS (SELECT 1 FROM scores n WHERE n.scored_at >= '2025-01-01' AND n.scoring_run_id = o.scoring_run_id AND n.site_id = o.site_id)""")
def replace_upsert(spark, d):
    t = table(spark, d, "scores", "scoring_run_id", "site_id", "id", "scored_at")
    new, old = t.where("scored_at >= '2025-01-01'"), t.where("scored_at < '2025-01-01'")
    return U.replace_all(old.drop("scored_at"), new.drop("scored_at"), ["scoring_run_id", "site_id"])


@q("SELECT run_id, count(*) AS n FROM asset_states WHERE run_id NOT IN (SELECT DISTINCT run_id FROM cohorts) GROUP BY 1")
def ledger_sync_anti(spark, d):
    return U.unsynced(table(spark, d, "asset_states", "run_id"), table(spark, d, "cohorts", "run_id"), ["run_id"]).groupBy("run_id").agg(F.count("*").alias("n"))


@q("""WITH k AS (SELECT DISTINCT asset_id, 'known-' || asset_id AS canonical FROM asset_states WHERE period = '2024-q1')
SELECT * FROM k UNION ALL SELECT DISTINCT asset_id, 'obs-' || substr(sha256(asset_id), 1, 12) FROM asset_states WHERE asset_id NOT IN (SELECT asset_id FROM k)""")
def id_map(spark, d):
    t = table(spark, d, "asset_states", "asset_id", "period")
    known = t.where("period = '2024-q1'").select("asset_id", F.concat(F.lit("known-"), "asset_id").alias("canonical")).distinct()
    return U.map_ids(t, known, "asset_id", F.concat(F.lit("obs-"), F.substring(F.sha2("asset_id", 256), 1, 12)))


_LWW = "row_number() OVER (PARTITION BY asset_id, period ORDER BY recorded_at DESC NULLS LAST, run_id DESC, gewerk_group DESC NULLS LAST, bundesland DESC NULLS LAST)"


def _lww(spark, d):
    t = table(spark, d, "asset_states", "asset_id", "period", "recorded_at", "run_id", "gewerk_group", "bundesland")
    return O.last_writer(t, ["asset_id", "period"], [F.col(c).desc_nulls_last() for c in ("recorded_at", "run_id", "gewerk_group", "bundesland")])


@q(f"SELECT asset_id, period, gewerk_group, bundesland FROM (SELECT *, {_LWW} AS rn FROM asset_states) WHERE rn = 1")
def lww_resolve(spark, d):
    return _lww(spark, d).where("won").select("asset_id", "period", "gewerk_group", "bundesland")


_ARRIVAL = "PARTITION BY asset_id, period ORDER BY valid_from, recorded_at, run_id, gewerk_group NULLS FIRST, bundesland NULLS FIRST"


@q(f"""WITH r AS (SELECT *, {_LWW} AS rn FROM asset_states), c AS (SELECT asset_id, period, recorded_at, rn, arg_min(recorded_at, rn) OVER w AS w_at, min(rn) OVER w AS w_rn FROM r WINDOW w AS ({_ARRIVAL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT asset_id, period, CASE WHEN rn < w_rn THEN recorded_at ELSE w_at END AS winner_recorded_at, CASE WHEN rn < w_rn THEN w_at ELSE recorded_at END AS loser_recorded_at FROM c WHERE w_rn IS NOT NULL""")
def lww_conflicts(spark, d):
    """Every conflict in order of arrival: who was the winner then, and who lost."""
    t = table(spark, d, "asset_states", "asset_id", "period", "recorded_at", "run_id", "gewerk_group", "bundesland", "valid_from")
    arrival = [F.col("valid_from"), F.col("recorded_at"), F.col("run_id"), F.col("gewerk_group").asc_nulls_first(), F.col("bundesland").asc_nulls_first()]
    return O.conflicts(t, ["asset_id", "period"], arrival, [F.col(c).desc_nulls_last() for c in ("recorded_at", "run_id", "gewerk_group", "bundesland")], ["recorded_at"])


_SCD = "WITH s AS (SELECT DISTINCT asset_id, valid_from FROM asset_states), v AS (SELECT asset_id, valid_from, lead(valid_from) OVER (PARTITION BY asset_id ORDER BY valid_from) AS valid_to FROM s) "


def _scd(spark, d):
    t = table(spark, d, "asset_states", "asset_id", "valid_from").distinct()
    return t.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy("asset_id").orderBy("valid_from")))


@q(_SCD + "SELECT * FROM v")
def scd2_states(spark, d):
    return _scd(spark, d)


@q(_SCD + "SELECT asset_id, valid_from FROM v WHERE valid_to IS NULL")
def scd2_current(spark, d):
    return _scd(spark, d).where("valid_to is null").select("asset_id", "valid_from")


@q(_SCD + "SELECT * FROM v WHERE valid_from <= '2025-03-31' AND (valid_to IS NULL OR valid_to > '2025-03-31')")
def scd2_as_of(spark, d):
    return U.as_of(_scd(spark, d), ["asset_id"], F.lit("2025-03-31").cast("timestamp_ntz"))


# ---- observations ----------------------------------------------------------
@q("SELECT p_partkey, signal_path, value_num FROM (SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM part) UNPIVOT (value_num FOR signal_path IN (p_size, p_retailprice))")
def unpivot_metrics(spark, d):
    t = table(spark, d, "part", "p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return O.unpivot(t, ["p_partkey"], ["p_size", "p_retailprice"])


@q("SELECT l_orderkey, max(CASE WHEN l_returnflag='A' THEN l_quantity END) AS a, max(CASE WHEN l_returnflag='N' THEN l_quantity END) AS n, max(CASE WHEN l_returnflag='R' THEN l_quantity END) AS r FROM lineitem GROUP BY 1")
def eav_pivot(spark, d):
    p = O.pivot_values(table(spark, d, "lineitem", "l_orderkey", "l_returnflag", "l_quantity"), "l_orderkey", "l_returnflag", "l_quantity", ["A", "N", "R"])
    return p.select("l_orderkey", F.col("A").alias("a"), F.col("N").alias("n"), F.col("R").alias("r"))


@q("SELECT id, CASE WHEN id % 3 = 0 THEN CASE WHEN phone IS NOT NULL THEN 'true' ELSE 'false' END WHEN id % 3 = 1 THEN city ELSE raw_json END AS value FROM site_source_seeds")
def eav_decode(spark, d):
    t = table(spark, d, "site_source_seeds", "id", "phone", "city", "raw_json").withColumn("value_type", F.element_at(F.array(F.lit("bool"), F.lit("str"), F.lit("json")), (F.col("id") % 3 + 1).cast("int")))
    t = t.withColumns({"value_bool": F.col("phone").isNotNull(), "value_num": F.lit(None).cast("double"), "value_str": F.col("city"), "value_json": F.col("raw_json")})
    return t.select("id", O.decoded().alias("value"))


_EXT = {"contact.phone.present": "phone", "contact.email.present": "email", "registry.category.present": "category", "content.web.present": "website_url"}


@q(" UNION ALL ".join(f"SELECT id, '{p}' AS signal_path, {c} IS NOT NULL AND trim({c}) <> '' AS value_bool FROM site_source_seeds" for p, c in _EXT.items()))
def translate_ext(spark, d):
    """Extractor columns to typed observations; a null column is a false one."""
    t = table(spark, d, "site_source_seeds", "id", *_EXT.values())
    rows = F.array(*[F.struct(F.lit(p).alias("signal_path"), F.coalesce(S.trim_all(c) != "", F.lit(False)).alias("value_bool")) for p, c in _EXT.items()])
    return t.select("id", F.explode(rows).alias("o")).select("id", "o.*")


_ONTO = [("event.click", "num", False), ("event.view", "num", True), ("event.purchase", "bool", False), ("event.signup", "num", False)]


@q("""WITH o(p,t,dep) AS (VALUES ('event.click','num',false),('event.view','num',true),('event.purchase','bool',false),('event.signup','num',false)),
e AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'Bad Path' ELSE 'event.' || event_type END AS sp, CASE WHEN event_id % 7 <> 0 THEN value END AS n, CASE WHEN event_id % 5 = 0 THEN props END AS j FROM events)
SELECT event_id, concat_ws(';', CASE WHEN sp = 'Bad Path' THEN 'invalid_path_format' END, CASE WHEN p IS NULL THEN 'unknown_signal' END, CASE WHEN dep THEN 'deprecated_signal' END,
CASE WHEN t <> 'num' THEN 'value_type_mismatch' END, CASE WHEN p IS NOT NULL AND n IS NULL AND j IS NULL THEN 'no_value_populated' END, CASE WHEN p IS NOT NULL AND n IS NOT NULL AND j IS NOT NULL THEN 'multiple_values_populated' END) AS issues FROM e LEFT JOIN o ON p = sp""")
def validate_observations(spark, d):
    e = table(spark, d, "events", "event_id", "event_type", "value", "props").select(
        "event_id", F.when(F.col("event_id") % 11 == 0, "Bad Path").otherwise(F.concat(F.lit("event."), "event_type")).alias("signal_path"), F.lit("num").alias("value_type"),
        F.lit(None).cast("boolean").alias("value_bool"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value_num"), F.lit(None).cast("string").alias("value_str"), F.when(F.col("event_id") % 5 == 0, F.col("props")).alias("value_json"),
    )
    onto = spark.createDataFrame(_ONTO, "signal_path string, value_type string, deprecated boolean")
    return O.issues(e, F.broadcast(onto)).select("event_id", F.array_join("issues", ";").alias("issues"))


@q("SELECT hwo_uid, NOT used AS unused, NOT listed AS unknown FROM (SELECT coalesce(s.hwo_uid, g.hwo_uid) AS hwo_uid, s.hwo_uid IS NOT NULL AS used, g.hwo_uid IS NOT NULL AS listed FROM (SELECT DISTINCT hwo_uid FROM asset_states WHERE hwo_uid IS NOT NULL) s FULL JOIN gewerke g ON g.hwo_uid = s.hwo_uid)")
def codebook_cross_check(spark, d):
    """Both sides of the check: trades in use beside the list, listed ones that nothing uses, used ones that aren't listed."""
    used = table(spark, d, "asset_states", "hwo_uid").where("hwo_uid is not null").distinct().withColumn("_u", F.lit(True))
    listed = table(spark, d, "gewerke", "hwo_uid").withColumn("_l", F.lit(True))
    return used.join(listed, "hwo_uid", "full").select("hwo_uid", F.col("_u").isNull().alias("unused"), F.col("_l").isNull().alias("unknown"))


# ---- cohorts, privacy, bands ----------------------------------------------
_VALID = "overall_score IS NOT NULL AND NOT isnan(overall_score) AND overall_score >= 0"


def _scores(spark, d, *cols):
    return table(spark, d, "scores", "overall_score", *cols).where("overall_score is not null and not isnan(overall_score) and overall_score >= 0")


def _site_scores(spark, d):
    sites = table(spark, d, "sites", F.col("id").alias("site_id"), "hwo_uid", "bundesland")
    trades = bounded_broadcast(table(spark, d, "gewerke", "hwo_uid", "gewerk_group"), MAX_LIST)
    return _scores(spark, d, "id", "site_id", "scored_at").join(sites, "site_id").join(trades, "hwo_uid", "left")


_JS = f"js AS (SELECT sc.id, sc.overall_score, sc.scored_at, s.bundesland, g.gewerk_group FROM scores sc JOIN sites s ON s.id = sc.site_id LEFT JOIN gewerke g ON g.hwo_uid = s.hwo_uid WHERE {_VALID})"
_SUM1 = "count({c}) AS n, floor(sum(floor({c}*100+0.5))::DOUBLE/count({c})/10.0::DOUBLE+0.5)/10 AS mean, " + ", ".join(_r(f"quantile_cont({{c}}, {p / 100})", 1) + f" AS p{p}" for p in (10, 25, 50, 75, 90)) + ", " + _r("min({c})", 1) + " AS min, " + _r("max({c})", 1) + " AS max, " + _r("stddev_samp({c})", 1) + " AS std_dev"


@q(f"SELECT cohort_id, {_SUM.format(c='overall_score')} FROM scores WHERE {_VALID} GROUP BY 1")
def summary_percentiles(spark, d):
    return _scores(spark, d, "cohort_id").groupBy("cohort_id").agg(*summary("overall_score"))


@q(f"SELECT cohort_id, {_SUM1.format(c='overall_score')} FROM scores WHERE {_VALID} GROUP BY 1")
def summary_stddev_1dp(spark, d):
    return _scores(spark, d, "cohort_id").groupBy("cohort_id").agg(*summary("overall_score", 1, True))


@q(f"WITH {_JS} SELECT CASE grouping(gewerk_group, bundesland) WHEN 3 THEN 'overall' WHEN 1 THEN 'gewerk_group' ELSE 'bundesland' END AS axis, CASE grouping(gewerk_group, bundesland) WHEN 3 THEN 'all' WHEN 1 THEN coalesce(gewerk_group,'null') ELSE coalesce(bundesland,'null') END AS value, {_SUM.format(c='overall_score')} FROM js GROUP BY GROUPING SETS ((), (gewerk_group), (bundesland))")
def cohort_axes(spark, d):
    return C.axes(_site_scores(spark, d), ["gewerk_group", "bundesland"], "overall_score")


@q(f"WITH {_JS} SELECT bundesland, {_SUM1.format(c='overall_score')} FROM js WHERE bundesland IS NOT NULL AND bundesland NOT IN ('','unknown') GROUP BY 1 HAVING count(*) >= 60")
def slices_k_anon(spark, d):
    return C.slices(_site_scores(spark, d), "bundesland", "overall_score", 60)


@q(f"WITH {_JS} SELECT bundesland, gewerk_group, count(*) AS n, {_r('quantile_cont(overall_score, 0.75)', 1)} AS p75 FROM js WHERE bundesland IS NOT NULL AND gewerk_group IS NOT NULL GROUP BY 1,2 HAVING count(*) >= 5 ORDER BY p75 DESC, bundesland, gewerk_group LIMIT 48")
def matrix_top48(spark, d):
    g = _site_scores(spark, d).where("bundesland is not null and gewerk_group is not null").groupBy("bundesland", "gewerk_group").agg(F.count("*").alias("n"), js_round(F.percentile("overall_score", F.lit(0.75)), 1).alias("p75"))
    return g.where("n >= 5").orderBy(F.desc("p75"), "bundesland", "gewerk_group").limit(48)


@q(f"WITH b(band,lo,hi) AS (VALUES ('0-20',0,20),('20-40',20,40),('40-60',40,60),('60-80',60,80),('80-100',80,101)), v AS (SELECT overall_score AS x FROM scores WHERE {_VALID}) SELECT band, count(x) AS n, floor(count(x)/(SELECT count(*) FROM v)*10000+0.5)/10000 AS share FROM b LEFT JOIN v ON x >= lo AND x < hi GROUP BY 1")
def maturity_bands(spark, d):
    return C.bands(_scores(spark, d), "overall_score")


@q("WITH s AS (SELECT *, count(*) OVER (PARTITION BY coalesce(hwo_uid,'null'), coalesce(bundesland,'null')) AS c FROM sites) SELECT id, hwo_uid, bundesland FROM s WHERE c >= 5")
def mart_sites_k_filtered(spark, d):
    return C.k_filter(table(spark, d, "sites", "id", "hwo_uid", "bundesland"), ["hwo_uid", "bundesland"], 5)


@q("SELECT bundesland, hwo_uid, count(*) AS n, count(*) < 5 AS suppressed, CASE WHEN count(*) < 5 THEN 'n<5' END AS reason FROM sites GROUP BY 1,2")
def k_anon_report(spark, d):
    return C.k_report(table(spark, d, "sites", "bundesland", "hwo_uid"), ["bundesland", "hwo_uid"])


@q(f"WITH {_SIG} SELECT site_id, dimension, indicator, {_r('score')} AS score FROM tr WHERE score IS NULL OR score < 60")
def remediation_report(spark, d):
    t = traces(site_signals(spark, d), BOOK, "site_id")
    return t.where("score is null or score < 60").select("site_id", "dimension", "indicator", js_round("score").alias("score"))


# ---- period series ----------------------------------------------------------
_TREND = f"""WITH {_JS}, p AS (SELECT coalesce(gewerk_group,'unclassified') || '|' || coalesce(bundesland,'-') AS grp, year(scored_at)::VARCHAR || '-q' || quarter(scored_at)::VARCHAR AS period, overall_score AS x FROM js),
a AS (SELECT grp, period, count(*) AS n, {_r('round(quantile_cont(x, 0.75), 9)', 1)} AS p75 FROM p GROUP BY 1,2),
g AS (SELECT * FROM (SELECT DISTINCT grp FROM a) CROSS JOIN (SELECT DISTINCT period FROM a)),
f AS (SELECT g.grp, g.period, n, p75, row_number() OVER w AS i, lag(n) OVER w AS pn, lag(p75) OVER w AS prev_p75 FROM g LEFT JOIN a ON a.grp = g.grp AND a.period = g.period WINDOW w AS (PARTITION BY g.grp ORDER BY g.period)),
t AS (SELECT *, floor((p75 - prev_p75)*10+0.5)/10 AS delta FROM f),
r AS (SELECT *, concat_ws(';', CASE WHEN n IS NULL THEN 'category_absent_current' WHEN pn IS NULL THEN 'no_previous_period' END,
  CASE WHEN n < 5 AND pn IS NOT NULL THEN 'current_sample_below_k' END, CASE WHEN pn < 5 AND n IS NOT NULL THEN 'previous_sample_below_k' END,
  CASE WHEN abs(delta) < 3 THEN 'delta_below_absolute_threshold' END, CASE WHEN abs(delta)/greatest(abs(prev_p75),1.0) < 0.03::DOUBLE THEN 'delta_below_relative_threshold' END) AS reasons FROM t) """


def _trend(spark, d):
    """Slices are group and state together, so that small ones occur."""
    t = _site_scores(spark, d).select(F.concat_ws("|", F.coalesce("gewerk_group", F.lit("unclassified")), F.coalesce("bundesland", F.lit("-"))).alias("grp"), S.period_of("scored_at").alias("period"), "overall_score")
    return C.period_series(t, "grp", "period", "overall_score")


@q(_TREND + "SELECT grp, period, n, p75, prev_p75, delta FROM r")
def period_trend_delta(spark, d):
    return _trend(spark, d).select("grp", "period", "n", "p75", "prev_p75", "delta")


@q(_TREND + "SELECT grp, period, reasons FROM r")
def suppression_reasons(spark, d):
    return _trend(spark, d).select("grp", "period", "reasons")


@q(_TREND + "SELECT grp, period, CASE WHEN reasons <> '' THEN 'suppressed' WHEN n < 30 OR pn < 30 OR abs(delta) < 3 THEN 'caution' ELSE 'reliable' END AS reliability FROM r")
def reliability(spark, d):
    return _trend(spark, d).select("grp", "period", "reliability")


@q("SELECT asset_id, min(period) AS first_period, max(period) AS last_period, string_agg(DISTINCT period, ',' ORDER BY period) AS periods FROM asset_states GROUP BY 1")
def comparison_manifest(spark, d):
    t = table(spark, d, "asset_states", "asset_id", "period")
    return t.groupBy("asset_id").agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.array_join(F.array_sort(F.collect_set("period")), ",").alias("periods"))


@q("WITH r AS (SELECT period, run_id, min(recorded_at) AS published FROM asset_states GROUP BY 1,2) SELECT period, run_id, lag(run_id) OVER w AS supersedes_run_id, CASE WHEN lead(run_id) OVER w IS NULL THEN 'published' ELSE 'superseded' END AS status FROM r WINDOW w AS (PARTITION BY period ORDER BY published, run_id)")
def supersede_runs(spark, d):
    r = table(spark, d, "asset_states", "period", "run_id", "recorded_at").groupBy("period", "run_id").agg(F.min("recorded_at").alias("published"))
    w = Window.partitionBy("period").orderBy("published", "run_id")
    return r.select("period", "run_id", F.lag("run_id").over(w).alias("supersedes_run_id"), F.when(F.lead("run_id").over(w).isNull(), "published").otherwise("superseded").alias("status"))


# ---- registry ---------------------------------------------------------------
@q("SELECT count(*) AS n FROM (SELECT site_id FROM site_source_seeds GROUP BY 1 HAVING count(DISTINCT split_part(source_path,'/',1)) > 1)")
def dedup_multi_source(spark, d):
    t = table(spark, d, "site_source_seeds", "site_id", F.split("source_path", "/")[0].alias("c"))
    return t.groupBy("site_id").agg(F.countDistinct("c").alias("k")).where("k > 1").agg(F.count("*").alias("n"))


@q("SELECT site_id, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM site_source_seeds WHERE category IS NOT NULL GROUP BY 1")
def group_concat_categories(spark, d):
    return table(spark, d, "site_source_seeds", "site_id", "category").where("category is not null").groupBy("site_id").agg(F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"))


@q("SELECT s.id, (SELECT min(business_name) FROM site_source_seeds d WHERE d.site_id = s.id AND category IS NOT NULL) AS name FROM sites s")
def scalar_subquery_first(spark, d):
    n = table(spark, d, "site_source_seeds", "site_id", "business_name", "category").where("category is not null").groupBy("site_id").agg(F.min("business_name").alias("name"))
    return table(spark, d, "sites", "id").join(n, F.col("id") == F.col("site_id"), "left").select("id", "name")


@q("SELECT domain, count(*) AS n_states, count(DISTINCT run_id) AS n_runs, string_agg(DISTINCT run_id, ',' ORDER BY run_id) AS runs, arg_min(asset_id, (recorded_at, asset_id)) AS first_asset FROM asset_states GROUP BY 1")
def registry_merge(spark, d):
    t = table(spark, d, "asset_states", "domain", "run_id", "asset_id", "recorded_at")
    return t.groupBy("domain").agg(F.count("*").alias("n_states"), F.countDistinct("run_id").alias("n_runs"), F.array_join(F.array_sort(F.collect_set("run_id")), ",").alias("runs"), F.min_by("asset_id", F.struct("recorded_at", "asset_id")).alias("first_asset"))


@q("SELECT gewerk_group, string_agg(hwo_uid || '=' || gewerk_name, '|' ORDER BY hwo_uid) AS mappings FROM gewerke GROUP BY 1")
def mappings_nested(spark, d):
    g = table(spark, d, "gewerke").groupBy("gewerk_group").agg(F.array_sort(F.collect_list(F.struct("hwo_uid", "gewerk_name"))).alias("m"))
    return g.select("gewerk_group", F.array_join(F.transform("m", lambda x: F.concat(x["hwo_uid"], F.lit("="), x["gewerk_name"])), "|").alias("mappings"))


@q("""WITH a AS (SELECT hwo_uid, lower(replace(gewerk_name,'handwerk','')) AS alias FROM gewerke),
c AS (SELECT DISTINCT category FROM site_source_seeds WHERE category IS NOT NULL),
m AS (SELECT category, hwo_uid, row_number() OVER (PARTITION BY category ORDER BY length(alias) DESC, hwo_uid) AS rn FROM c JOIN a ON contains(lower(category), alias))
SELECT s.id, hwo_uid FROM site_source_seeds s LEFT JOIN m ON m.category = s.category AND rn = 1""")
def classify_alias(spark, d):
    """Longest trade alias that a category contains; distinct categories meet any number of aliases by one equi-join."""
    names = table(spark, d, "gewerke", "hwo_uid", F.lower(F.replace("gewerk_name", F.lit("handwerk"), F.lit(""))).alias("term"))
    seeds = table(spark, d, "site_source_seeds", "id", F.lower("category").alias("category"))
    return seeds.join(contained_term(seeds, "category", names), "category", "left").select("id", "hwo_uid")


@q("SELECT s.id, z.place, z.state_code FROM site_source_seeds s JOIN zipcodes z ON z.zipcode = trim(s.postal_code)")
def zip_lookup(spark, d):
    z = bounded_broadcast(table(spark, d, "zipcodes", "zipcode", "place", "state_code"), MAX_LIST)
    return table(spark, d, "site_source_seeds", "id", "postal_code").join(z, F.trim("postal_code") == F.col("zipcode")).select("id", "place", "state_code")


# ---- counts, shares, distributions -----------------------------------------
@q("SELECT coalesce(s.bundesland,'Unknown') AS bundesland, count(*) AS n, count(a.domain) AS live, count(*) - count(a.domain) AS dead, floor(avg(s.hwo_confidence)*100+0.5)/100 AS confidence FROM sites s LEFT JOIN (SELECT DISTINCT domain FROM asset_states WHERE period = '2026-q2') a ON a.domain = s.domain GROUP BY 1")
def liveness_by_state(spark, d):
    live = table(spark, d, "asset_states", "domain", "period").where("period = '2026-q2'").select("domain").distinct().withColumn("live", F.lit(1))
    s = table(spark, d, "sites", "domain", "bundesland", "hwo_confidence").join(live, "domain", "left")
    return s.groupBy(F.coalesce("bundesland", F.lit("Unknown")).alias("bundesland")).agg(F.count("*").alias("n"), F.count("live").alias("live"), (F.count("*") - F.count("live")).alias("dead"), js_round(F.avg("hwo_confidence")).alias("confidence"))


@q("SELECT count(*) AS n, count_if(event_type = 'error') AS errors, count(DISTINCT user_id) AS users, coalesce(floor(avg(value)*100+0.5)/100, 0) AS mean_value FROM events")
def liveness_summary(spark, d):
    return table(spark, d, "events", "event_type", "user_id", "value").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.countDistinct("user_id").alias("users"), F.coalesce(js_round(F.avg("value")), F.lit(0.0)).alias("mean_value"))


@q("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, floor(avg(l_extendedprice)*10+0.5)/10 AS mean_price FROM lineitem GROUP BY 1,2")
def audit_tool_counts(spark, d):
    return table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), js_round(F.avg("l_extendedprice"), 1).alias("mean_price"))


@q("SELECT coalesce(page_lang, '-') AS lang, count(*) AS n, count(phone_text) AS phones, CASE WHEN count(*) > 0 THEN floor(100.0*count(phone_text)/count(*)+0.5)::BIGINT END AS phone_pct, CASE WHEN count(*) > 0 THEN floor(100.0*count(web_text)/count(*)+0.5)::BIGINT END AS web_pct FROM imprint_contacts GROUP BY 1")
def presence_pct(spark, d):
    g = table(spark, d, "imprint_contacts", "page_lang", "phone_text", "web_text").groupBy(F.coalesce("page_lang", F.lit("-")).alias("lang")).agg(F.count("*").alias("n"), F.count("phone_text").alias("phones"), F.count("web_text").alias("w"))
    return g.select("lang", "n", "phones", percent(F.col("phones"), F.col("n")).alias("phone_pct"), percent(F.col("w"), F.col("n")).alias("web_pct"))


@q(" UNION ALL ".join(f"SELECT '{c}' AS signal, count_if({c} IS NOT NULL AND {c} <> '') AS present FROM site_source_seeds" for c in ("phone", "email", "website_url", "category")))
def signal_presence_counts(spark, d):
    """All signals in one pass."""
    cols = ("phone", "email", "website_url", "category")
    one = table(spark, d, "site_source_seeds", *cols).agg(*[F.count_if(F.col(c).isNotNull() & (F.col(c) != "")).alias(c) for c in cols])
    return one.unpivot([], list(cols), "signal", "present")


@q("SELECT coalesce(bundesland,'unclassified') AS bundesland, count(*) AS n FROM sites GROUP BY 1")
def distribution_1d(spark, d):
    return table(spark, d, "sites", "bundesland").groupBy(F.coalesce("bundesland", F.lit("unclassified")).alias("bundesland")).agg(F.count("*").alias("n"))


_GROUPS = ["BauAusbau", "BauHaupt", "Gesundheit", "Gewerblich", "Kfz", "Nahrung", "Privat", "unclassified"]


@q("WITH t AS (SELECT coalesce(s.bundesland,'unclassified') AS b, coalesce(g.gewerk_group,'unclassified') AS grp FROM sites s LEFT JOIN gewerke g ON g.hwo_uid = s.hwo_uid) SELECT b AS bundesland, " + ", ".join(f"count_if(grp = '{g}') AS \"{g}\"" for g in _GROUPS) + " FROM t GROUP BY 1")
def distribution_2d(spark, d):
    g = bounded_broadcast(table(spark, d, "gewerke", "hwo_uid", "gewerk_group"), MAX_LIST)
    t = table(spark, d, "sites", "bundesland", "hwo_uid").join(g, "hwo_uid", "left").select(F.coalesce("bundesland", F.lit("unclassified")).alias("bundesland"), F.coalesce("gewerk_group", F.lit("unclassified")).alias("grp"))
    return t.groupBy("bundesland").pivot("grp", _GROUPS).count().fillna(0)


@q("WITH t AS (SELECT coalesce(hwo_provenance,'unclassified') AS p, count(*) AS n FROM sites GROUP BY 1) SELECT p AS provenance, n, row_number() OVER (ORDER BY coalesce(list_position(['manual','name','category','llm'], p), 99), n DESC, p) AS pos FROM t")
def custom_order_dist(spark, d):
    """A hand-given order of classes, the sentinel last. The window spans one row per class."""
    t = table(spark, d, "sites", "hwo_provenance").groupBy(F.coalesce("hwo_provenance", F.lit("unclassified")).alias("provenance")).agg(F.count("*").alias("n"))
    at = F.array_position(F.array(*[F.lit(x) for x in ("manual", "name", "category", "llm")]), F.col("provenance"))
    w = Window.orderBy(F.when(at > 0, at).otherwise(99), F.desc("n"), "provenance")
    return t.select("provenance", "n", F.row_number().over(w).alias("pos"))


@q("SELECT coalesce(split_part(source_path,'/',1), 'total') AS source, count(*) AS n, count_if(website_url IS NULL) AS no_url FROM site_source_seeds GROUP BY ROLLUP (split_part(source_path,'/',1))")
def parse_stats_rollup(spark, d):
    t = table(spark, d, "site_source_seeds", F.split("source_path", "/")[0].alias("source"), "website_url")
    return t.rollup("source").agg(F.count("*").alias("n"), F.count_if(F.col("website_url").isNull()).alias("no_url")).select(F.coalesce("source", F.lit("total")).alias("source"), "n", "no_url")


# ---- joins and sets ---------------------------------------------------------
@q("SELECT s.id, st.asset_id, st.period FROM sites s JOIN asset_states st ON st.domain = s.domain WHERE st.valid_to IS NULL")
def join_current_states(spark, d):
    return table(spark, d, "asset_states", "asset_id", "domain", "period", "valid_to").where("valid_to is null").join(table(spark, d, "sites", "id", "domain"), "domain").select("id", "asset_id", "period")


@q("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def semi_in(spark, d):
    o = table(spark, d, "orders", "o_custkey", "o_totalprice").where("o_totalprice > 200000")
    return table(spark, d, "customer", "c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@q("SELECT id FROM sites WHERE id NOT IN (SELECT site_id FROM site_source_seeds)")
def anti_not_in(spark, d):
    """NOT IN as SQL means it: a null on the right leaves nothing, told by one count beside the anti join."""
    right = table(spark, d, "site_source_seeds", "site_id")
    nulls = right.where("site_id is null").groupBy().agg(F.count("*").alias("k")).where("k > 0").limit(1)
    return table(spark, d, "sites", "id").join(right, F.col("id") == F.col("site_id"), "left_anti").join(F.broadcast(nulls), F.lit(True), "left_anti")


@q("SELECT s.id, coalesce(g.gewerk_name,'unknown') AS trade FROM sites s LEFT JOIN gewerke g ON g.hwo_uid = s.hwo_uid")
def left_default_unknown(spark, d):
    g = bounded_broadcast(table(spark, d, "gewerke", "hwo_uid", "gewerk_name"), MAX_LIST)
    return table(spark, d, "sites", "id", "hwo_uid").join(g, "hwo_uid", "left").select("id", F.coalesce("gewerk_name", F.lit("unknown")).alias("trade"))


@q("SELECT DISTINCT site_id, split_part(source_path,'/',1) AS catalog FROM site_source_seeds")
def distinct_pairs(spark, d):
    return table(spark, d, "site_source_seeds", "site_id", F.split("source_path", "/")[0].alias("catalog")).distinct()


@q("SELECT 'seed' AS origin, count(*) AS n FROM site_source_seeds UNION ALL SELECT 'contact', count(*) FROM imprint_contacts")
def union_all_sources(spark, d):
    u = table(spark, d, "site_source_seeds", F.lit("seed").alias("origin")).unionByName(table(spark, d, "imprint_contacts", F.lit("contact").alias("origin")))
    return u.groupBy("origin").agg(F.count("*").alias("n"))


@q("SELECT lower(domain) AS key, min(id) AS id FROM sites GROUP BY 1 UNION ALL SELECT 'catalog:' || catalog, trust_rank FROM source_catalogs")
def axis_universe(spark, d):
    a = table(spark, d, "sites", F.lower("domain").alias("key"), "id").groupBy("key").agg(F.min("id").alias("id"))
    return a.unionByName(table(spark, d, "source_catalogs", F.concat(F.lit("catalog:"), "catalog").alias("key"), F.col("trust_rank").cast("long").alias("id")))


@q("SELECT id, category FROM site_source_seeds ORDER BY length(category) DESC NULLS LAST, category, id LIMIT 20")
def top_k_order(spark, d):
    return table(spark, d, "site_source_seeds", "id", "category").orderBy(F.length("category").desc_nulls_last(), "category", "id").limit(20)


# ---- vault and content ------------------------------------------------------
@q("SELECT period, count(*) AS n, count(DISTINCT asset_id) AS assets FROM asset_states GROUP BY 1")
def vault_signal_counts(spark, d):
    return table(spark, d, "asset_states", "period", "asset_id").groupBy("period").agg(F.count("*").alias("n"), F.countDistinct("asset_id").alias("assets"))


@q("SELECT asset_id, max(valid_from) AS valid_from FROM asset_states GROUP BY 1")
def vault_current_state(spark, d):
    return table(spark, d, "asset_states", "asset_id", "valid_from").groupBy("asset_id").agg(F.max("valid_from").alias("valid_from"))


@q("SELECT sha256(text) AS sha, min(doc_id) AS doc_id, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_dedup_first_seen(spark, d):
    return table(spark, d, "documents", "text", "doc_id").where("text is not null").groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


@q("SELECT domain, coalesce(url_path,'/') AS url_path, min(doc_id) AS doc_id FROM documents GROUP BY 1,2")
def detected_url_dedup(spark, d):
    return table(spark, d, "documents", "domain", "url_path", "doc_id").groupBy("domain", F.coalesce("url_path", F.lit("/")).alias("url_path")).agg(F.min("doc_id").alias("doc_id"))


@q("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1,2")
def stream_tumbling_counts(spark, d):
    """The windowed count that ``streaming.ingest`` runs continuously, here as a replay of the whole table."""
    from ..streaming.ingest import tumbling_counts

    return tumbling_counts(table(spark, d, "events", "ts", "event_type"), "ts", "event_type", "1 hour")


@q()
def page_signals_udf(spark, d):
    """All page signals of every document, one parse a page (no SQL can express them)."""
    from ..functions.page_signals import page_signals

    return page_signals(table(spark, d, "documents", "doc_id", "text", F.concat(F.lit("https://"), "domain", F.coalesce("url_path", F.lit("/"))).alias("url")), "doc_id", "text", "url", 2026)


@q("SELECT id, '{\"kat\":' || coalesce(to_json(raw_json->>'$.kat')::VARCHAR, 'null') || ',\"pos\":' || (raw_json->>'$.pos') || ',\"tel\":' || coalesce(to_json(raw_json->>'$.tel')::VARCHAR, 'null') || '}' AS j FROM site_source_seeds")
def json_canonical(spark, d):
    from ..functions.canonical_json import canonical_json

    return table(spark, d, "site_source_seeds", "id", "raw_json").select("id", canonical_json("raw_json").alias("j"))


@q("SELECT user_id, sum(CASE WHEN event_type='error' THEN coalesce((props->>'$.k')::BIGINT, 1) ELSE 0 END)::BIGINT AS weighted_errors, count_if(event_type='error') AS errors FROM events GROUP BY 1")
def violation_counts(spark, d):
    """Node-weighted counts; a missing number of nodes counts as one."""
    nodes = F.coalesce(F.get_json_object("props", "$.k").try_cast("long"), F.lit(1))
    bad = F.col("event_type") == "error"
    return table(spark, d, "events", "user_id", "event_type", "props").groupBy("user_id").agg(F.sum(F.when(bad, nodes).otherwise(0)).alias("weighted_errors"), F.count_if(bad).alias("errors"))


@q("WITH m AS (SELECT cohort_id, floor(sum(floor(overall_score*100+0.5))::DOUBLE/count(*)+0.5)/100 AS mean FROM scores WHERE overall_score >= 0 AND NOT isnan(overall_score) AND cohort_id IS NOT NULL GROUP BY 1) SELECT cohort_id, mean, row_number() OVER (ORDER BY mean DESC, cohort_id) AS pos FROM m")
def rank_by_mean(spark, d):
    """Rank of every cohort by its mean; the window spans one row per cohort."""
    m = _scores(spark, d, "cohort_id").where("cohort_id is not null").groupBy("cohort_id").agg((F.floor(F.sum(F.floor(F.col("overall_score") * 100 + 0.5)) / F.count("*") + 0.5) / 100.0).alias("mean"))
    return m.select("cohort_id", "mean", F.row_number().over(Window.orderBy(F.desc("mean"), "cohort_id")).alias("pos"))


@q("SELECT id, postal_code, city FROM site_source_seeds WHERE (postal_code IS NOT NULL AND postal_code <> '' OR city IS NOT NULL AND city <> '') AND source_path LIKE 'branchenkranz/%' AND city NOT IN ('', 'Unknown') AND length(trim(business_name)) > 0")
def filter_chain(spark, d):
    t = table(spark, d, "site_source_seeds", "id", "postal_code", "city", "source_path", "business_name")
    there = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return t.where((there("postal_code") | there("city")) & F.col("source_path").startswith("branchenkranz/") & ~F.col("city").isin("", "Unknown") & (F.length(F.trim("business_name")) > 0)).select("id", "postal_code", "city")


@q("SELECT id, coalesce(nullif(trim(s.city), ''), z.place) AS city FROM site_source_seeds s LEFT JOIN zipcodes z ON z.zipcode = s.postal_code")
def update_from_lookup(spark, d):
    z = bounded_broadcast(table(spark, d, "zipcodes", F.col("zipcode").alias("postal_code"), "place"), MAX_LIST)
    return table(spark, d, "site_source_seeds", "id", "city", "postal_code").join(z, "postal_code", "left").select("id", F.coalesce(F.nullif(F.trim("city"), F.lit("")), "place").alias("city"))

"""Scoring: rules, missing-value policies, traces, dimensions, overall scores and cohort summaries of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.num import js_round, summary
from ..functions.rules import RULES, missing_policy
from ..functions.strings import computation_hash
from ..operators.codebook import dimensions, scores, traces
from ..sources.tables import bounded_broadcast, table

#: A small codebook over signals that the site tables give; every rule and policy occurs.
BOOK = {
    "id": "site-presence", "version": "1.0.0",
    "dimensions": [
        {"id": "contact", "weight": 0.5, "indicators": [
            {"id": "phone", "inputKey": "phone", "weight": 0.5, "rule": {"type": "bool"}, "missing": {"kind": "zero"}},
            {"id": "emails", "inputKey": "emails", "weight": 0.3, "rule": {"type": "countClamp", "min": 0, "max": 3}, "missing": {"kind": "zero"}},
            {"id": "web", "inputKey": "web", "weight": 0.2, "rule": {"type": "bool"}, "missing": {"kind": "skip"}},
        ]},
        {"id": "identity", "weight": 0.3, "indicators": [
            {"id": "provenance", "inputKey": "provenance", "weight": 0.6, "rule": {"type": "enum", "cases": {"manual": 100, "name": 80, "category": 60, "llm": 40}, "defaultScore": 0}, "missing": {"kind": "impute", "imputedScore": 50}},
            {"id": "category", "inputKey": "category", "weight": 0.4, "rule": {"type": "presence"}},
        ]},
        {"id": "density", "weight": 0.2, "indicators": [
            {"id": "listings", "inputKey": "listings", "weight": 1.0, "rule": {"type": "countClampInverse", "min": 0, "max": 10}, "missing": {"kind": "conditional", "states": {"absent": "exclude"}, "default": "zero"}},
        ]},
    ],
}
#: Reference lists are hand-kept.
MAX_LIST = 100_000
K = 5


def site_signals(spark: SparkSession, folder: str) -> DataFrame:
    """One row per site: signals from its listings (null without any), trade group and state."""
    sites = table(spark, folder, "sites", "id", "hwo_uid", "hwo_provenance", "bundesland")
    seeds = table(spark, folder, "site_source_seeds", "site_id", "phone", "email", "website_url", "category")
    agg = seeds.groupBy("site_id").agg(
        (F.count("phone") > 0).alias("phone"), F.countDistinct(F.lower("email")).alias("emails"), (F.count("website_url") > 0).alias("web"),
        F.min("category").alias("category"), F.count("*").alias("listings"),
    )
    trades = bounded_broadcast(table(spark, folder, "gewerke", "hwo_uid", "gewerk_group"), MAX_LIST)
    return sites.join(agg, sites["id"] == agg["site_id"], "left").join(trades, "hwo_uid", "left").select(
        sites["id"].alias("site_id"), "phone", "emails", "web", F.col("hwo_provenance").alias("provenance"), "category", "listings",
        F.coalesce("gewerk_group", F.lit("unclassified")).alias("gewerk_group"), F.coalesce("bundesland", F.lit("unknown")).alias("bundesland"),
    )


KEEP = ("gewerk_group", "bundesland")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return scores(site_signals(spark, folder), BOOK, "site_id", KEEP)


def score_traces(spark, folder):
    """One row per site and indicator."""
    return traces(site_signals(spark, folder), BOOK, "site_id").select("site_id", "dimension", "indicator", js_round("score").alias("score"), "weight", "confidence", "note")


def score_dimensions(spark, folder):
    return dimensions(_scored(spark, folder), BOOK, "site_id").where("score is not null")


def score_overall(spark, folder):
    return _scored(spark, folder).select("site_id", "overall", "confidence")


def score_cohorts(spark, folder):
    """Flagship: overall scores summarised over all sites, per trade group, per state and per both, k >= 5."""
    s = _scored(spark, folder).where("overall is not null").select("overall", *KEEP)
    g = s.groupingSets([[], ["gewerk_group"], ["bundesland"], ["gewerk_group", "bundesland"]], "gewerk_group", "bundesland").agg(F.grouping_id().alias("gid"), *summary("overall"))
    axis = F.element_at(F.create_map(F.lit(0), F.lit("stratum"), F.lit(1), F.lit("gewerk_group"), F.lit(2), F.lit("bundesland"), F.lit(3), F.lit("all")), F.col("gid").cast("int"))
    return g.where(F.col("n") >= K).select(axis.alias("axis"), "gewerk_group", "bundesland", "n", "mean", "p10", "p25", "p50", "p75", "p90", "min", "max")


_SIG = """
agg AS (SELECT site_id, count(phone) > 0 AS phone, count(DISTINCT lower(email)) AS emails, count(website_url) > 0 AS web, min(category) AS category, count(*) AS listings FROM site_source_seeds GROUP BY site_id),
sig AS (SELECT s.id AS site_id, a.phone, a.emails, a.web, s.hwo_provenance AS provenance, a.category, a.listings, coalesce(g.gewerk_group,'unclassified') AS gewerk_group, coalesce(s.bundesland,'unknown') AS bundesland
  FROM sites s LEFT JOIN agg a ON a.site_id = s.id LEFT JOIN gewerke g ON g.hwo_uid = s.hwo_uid),
tr AS (
  SELECT site_id,'contact' AS dimension,'phone' AS indicator,0.5::DOUBLE AS declared, CASE WHEN phone IS NULL THEN 0 WHEN phone THEN 100 ELSE 0 END::DOUBLE AS score, 0.5::DOUBLE AS weight, 1.0::DOUBLE AS confidence, CASE WHEN phone IS NULL THEN 'missing: zero' END AS note FROM sig
  UNION ALL SELECT site_id,'contact','emails',0.3, CASE WHEN emails IS NULL THEN 0 ELSE least(greatest(emails,0),3)/3.0::DOUBLE*100 END, 0.3, 1, CASE WHEN emails IS NULL THEN 'missing: zero' END FROM sig
  UNION ALL SELECT site_id,'contact','web',0.2, CASE WHEN web THEN 100 WHEN NOT web THEN 0 END, CASE WHEN web IS NULL THEN 0 ELSE 0.2 END, CASE WHEN web IS NULL THEN 0 ELSE 1 END, CASE WHEN web IS NULL THEN 'missing: skip' END FROM sig
  UNION ALL SELECT site_id,'identity','provenance',0.6, CASE WHEN provenance IS NULL OR trim(provenance)='' THEN 50 ELSE CASE provenance WHEN 'manual' THEN 100 WHEN 'name' THEN 80 WHEN 'category' THEN 60 WHEN 'llm' THEN 40 ELSE 0 END END, 0.6, CASE WHEN provenance IS NULL THEN 0.5 ELSE 1 END, CASE WHEN provenance IS NULL THEN 'missing: impute' END FROM sig
  UNION ALL SELECT site_id,'identity','category',0.4, CASE WHEN trim(coalesce(category,'')) <> '' THEN 100 ELSE 0 END, 0.4, 1, NULL FROM sig
  UNION ALL SELECT site_id,'density','listings',1.0, CASE WHEN listings IS NOT NULL THEN 100 + least(greatest(listings,0),10)/10.0::DOUBLE*(-100) END, CASE WHEN listings IS NULL THEN 0 ELSE 1 END, CASE WHEN listings IS NULL THEN 0 ELSE 1 END, CASE WHEN listings IS NULL THEN 'missing: conditional' END FROM sig
),
dims AS (SELECT site_id, dimension, CASE WHEN sum(weight)>0 THEN sum(coalesce(score,0)*weight)/sum(weight) END AS s, CASE WHEN sum(weight)>0 THEN floor(sum(confidence*weight)/sum(weight)*100+0.5)/100 ELSE 0 END AS c,
  sum(weight)/sum(declared)*(CASE dimension WHEN 'contact' THEN 0.5 WHEN 'identity' THEN 0.3 ELSE 0.2 END) AS e FROM tr GROUP BY 1,2),
ov AS (SELECT site_id, floor(sum(s*e)/sum(e)*100+0.5)/100 AS overall, floor(sum(c*e)/sum(e)*100+0.5)/100 AS confidence FROM dims WHERE s IS NOT NULL GROUP BY 1)
"""


def _r(x, d=2):
    k = 10**d
    return f"floor({x}*{k}+0.5)/{k}"


_SUM = "count({c}) AS n, floor(sum(floor({c}*100+0.5))::DOUBLE/count({c})+0.5)/100 AS mean, " + ", ".join(_r(f"quantile_cont({{c}}, {p / 100})") + f" AS p{p}" for p in (10, 25, 50, 75, 90)) + ", " + _r("min({c})") + " AS min, " + _r("max({c})") + " AS max"

_COHORT_SQL = f"""WITH {_SIG}, j AS (SELECT overall, gewerk_group, bundesland FROM ov JOIN sig USING (site_id))
SELECT CASE grouping(gewerk_group, bundesland) WHEN 0 THEN 'stratum' WHEN 1 THEN 'gewerk_group' WHEN 2 THEN 'bundesland' ELSE 'all' END AS axis, gewerk_group, bundesland, {_SUM.format(c='overall')}
FROM j GROUP BY GROUPING SETS ((), (gewerk_group), (bundesland), (gewerk_group, bundesland)) HAVING count(*) >= {K}"""


# Single rules and policies on columns of the benchmark tables.
def _rule(name, value, spec, columns):
    def f(spark, folder):
        df = table(spark, folder, *columns)
        s, bad = RULES[name](value(), spec)
        return df.select(df.columns[0], js_round(s).alias("score"), bad.alias("rule_error"))

    f.__doc__ = f"The {name} rule on one column."
    return f


rule_bool = _rule("bool", lambda: F.when(F.col("event_type") == "view", "true").when(F.col("event_type") == "click", "0").when(F.col("event_type") == "error", "maybe"), {}, ("events", "event_id", "event_type"))
rule_presence = _rule("presence", lambda: F.col("category"), {}, ("site_source_seeds", "id", "category"))
rule_count_clamp = _rule("countClamp", lambda: F.col("l_quantity"), {"min": 5, "max": 40, "scoreAtMax": 80}, ("lineitem", "l_orderkey", "l_linenumber", "l_quantity"))
rule_count_clamp_inverse = _rule("countClampInverse", lambda: F.col("value"), {"min": 0, "max": 50, "scoreAtMin": 90, "scoreAtMax": 30}, ("events", "event_id", "value"))
rule_enum = _rule("enum", lambda: F.col("o_orderpriority"), {"cases": {"1-URGENT": 100, "2-HIGH": 60, "5-LOW": 30}, "defaultScore": 5}, ("orders", "o_orderkey", "o_orderpriority"))


def _missing(kind, policy):
    def f(spark, folder):
        df = table(spark, folder, "imprint_contacts", "contact_id", "phone_text", "page_lang")
        s, c, w = missing_policy({"kind": kind, **policy}, F.when(F.col("page_lang") == "en", "unreachable").when(F.col("page_lang") == "de", "not_applicable"))
        return df.where("phone_text is null").select("contact_id", s.alias("score"), c.alias("confidence"), w.alias("weight"))

    f.__doc__ = f"The {kind} policy on contacts without a phone number."
    return f


missing_zero, missing_skip = _missing("zero", {}), _missing("skip", {})
missing_impute = _missing("impute", {"imputedScore": 40})
missing_conditional = _missing("conditional", {"states": {"absent": "zero", "unreachable": "exclude", "not_applicable": "skip"}, "default": "zero"})


def computation_hash_q(spark, folder):
    """Hash over codebook version and the sorted ids of the scores of each site."""
    s = table(spark, folder, "scores", "id", "site_id", "codebook_version")
    return s.groupBy("site_id").agg(F.max("codebook_version").alias("v"), F.collect_list(F.col("id").cast("string")).alias("ids")).select("site_id", computation_hash(F.col("v"), F.col("ids")).alias("computation_hash"))


QUERIES = {
    "score_cohorts": score_cohorts, "score_traces": score_traces, "score_dimensions": score_dimensions, "score_overall": score_overall,
    "rule_bool": rule_bool, "rule_presence": rule_presence, "rule_count_clamp": rule_count_clamp, "rule_count_clamp_inverse": rule_count_clamp_inverse, "rule_enum": rule_enum,
    "missing_zero": missing_zero, "missing_skip": missing_skip, "missing_impute": missing_impute, "missing_conditional": missing_conditional,
    "computation_hash": computation_hash_q,
}
ORACLE = {
    "score_cohorts": _COHORT_SQL,
    "score_traces": f"WITH {_SIG} SELECT site_id, dimension, indicator, {_r('score')} AS score, weight, confidence, note FROM tr",
    "score_dimensions": f"WITH {_SIG} SELECT site_id, dimension, {_r('s')} AS score, {_r('e', 3)} AS effective_weight, c AS confidence FROM dims WHERE s IS NOT NULL",
    "score_overall": f"WITH {_SIG} SELECT sig.site_id, overall, confidence FROM sig LEFT JOIN ov USING (site_id)",
    "rule_bool": "SELECT event_id, CASE event_type WHEN 'view' THEN 100.0 WHEN 'click' THEN 0.0 END::DOUBLE AS score, event_type = 'error' AS rule_error FROM events",
    "rule_presence": "SELECT id, CASE WHEN length(trim(coalesce(category,''))) > 0 THEN 100 ELSE 0 END::DOUBLE AS score, false AS rule_error FROM site_source_seeds",
    "rule_count_clamp": f"SELECT l_orderkey, {_r('((least(greatest(l_quantity,5),40)-5)/35.0::DOUBLE*80)')} AS score, false AS rule_error FROM lineitem",
    "rule_count_clamp_inverse": f"SELECT event_id, {_r('(90 + least(greatest(value,0),50)/50.0::DOUBLE*(-60))')} AS score, coalesce(isnan(value), false) AS rule_error FROM events",
    "rule_enum": "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '2-HIGH' THEN 60 WHEN '5-LOW' THEN 30 ELSE 5 END::DOUBLE AS score, false AS rule_error FROM orders",
    "missing_zero": "SELECT contact_id, 0.0::DOUBLE AS score, 1.0::DOUBLE AS confidence, 1.0::DOUBLE AS weight FROM imprint_contacts WHERE phone_text IS NULL",
    "missing_skip": "SELECT contact_id, NULL::DOUBLE AS score, 0.0::DOUBLE AS confidence, 0.0::DOUBLE AS weight FROM imprint_contacts WHERE phone_text IS NULL",
    "missing_impute": "SELECT contact_id, 40.0::DOUBLE AS score, 0.5::DOUBLE AS confidence, 1.0::DOUBLE AS weight FROM imprint_contacts WHERE phone_text IS NULL",
    "missing_conditional": "SELECT contact_id, CASE WHEN page_lang IS NULL OR page_lang NOT IN ('en','de') THEN 0.0 END::DOUBLE AS score, CASE WHEN page_lang IS NULL OR page_lang NOT IN ('en','de') THEN 1.0 ELSE 0.0 END::DOUBLE AS confidence, CASE WHEN page_lang IS NULL OR page_lang NOT IN ('en','de') THEN 1.0 ELSE 0.0 END::DOUBLE AS weight FROM imprint_contacts WHERE phone_text IS NULL",
    "computation_hash": """SELECT site_id, sha256('{"codebookVersion":"' || max(codebook_version) || '","observationIds":[' || string_agg('"' || id::VARCHAR || '"', ',' ORDER BY id::VARCHAR) || ']}') AS computation_hash FROM scores GROUP BY site_id""",
}

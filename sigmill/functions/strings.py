"""Scalar functions on domains, addresses of pages, texts, ids and periods, all as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c) -> Column:
    """Strips every Unicode blank, also tabs, line breaks and no-break spaces."""
    return F.regexp_replace(_c(c), r"^[\s ]+|[\s ]+$", "")


def blank_to_null(c) -> Column:
    t = trim_all(c)
    return F.when(t != "", t)


def normalise_domain(c) -> Column:
    """Host of a URL or bare host: lower case, without www., port and closing dots; null for IPs and single labels."""
    h = F.regexp_extract(F.lower(trim_all(c)), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    h = F.regexp_replace(F.regexp_replace(h, r"\.+$", ""), r"^www\.", "")
    return F.when(h.contains(".") & ~h.rlike(r"^\d+(\.\d+){3}$"), h)


def registrable_domain(c, second_level: tuple[str, ...] = ("co.uk", "com.au", "co.at", "or.at", "de.com")) -> Column:
    """Last two labels of a host, three below the given public suffixes (a short list, no full suffix table)."""
    h = normalise_domain(c)
    two = F.regexp_extract(h, r"([^.]+\.[^.]+)$", 1)
    return F.when(h.isNotNull(), F.when(two.isin(*second_level), F.coalesce(F.nullif(F.regexp_extract(h, r"([^.]+\.[^.]+\.[^.]+)$", 1), F.lit("")), two)).otherwise(two))


def normalise_page_url(c) -> Column:
    """Without fragment, host in lower case, "/" where there is no path."""
    u = F.regexp_replace(trim_all(c), r"#.*$", "")
    head, rest = F.lower(F.regexp_extract(u, r"^([A-Za-z]+://[^/?]+)", 1)), F.regexp_replace(u, r"^[A-Za-z]+://[^/?]+", "")
    return F.when(head != "", F.concat(head, F.when(rest == "", "/").when(rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)))


def normalise_phone(c) -> Column:
    """Without blanks, hyphens, slashes and dots; a leading 0049 or 0 becomes +49. Other signs stay."""
    t = F.regexp_replace(_c(c), r"[\s\u00a0\-/.]", "")
    return F.regexp_replace(F.regexp_replace(t, r"^0049", "+49"), r"^0", "+49")


def match_text(c) -> Column:
    """Lower case without blanks, hyphens, underscores and slashes."""
    return F.regexp_replace(F.lower(_c(c)), r"[\s\-_/]", "")


def place_key(c) -> Column:
    """Town name for lookups: lower case, without what follows a hyphen, slash, bracket or "OT", without dots and commas."""
    t = F.regexp_replace(F.lower(_c(c)), r"\s*[-/(].*$", "")
    return trim_all(F.regexp_replace(F.regexp_replace(t, r"(?<![A-Za-z0-9_])ot\s+.*$", ""), r"[.,]", ""))


def slug(c) -> Column:
    """ASCII words joined by hyphens; umlauts as two letters."""
    t = F.lower(_c(c))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def first_keyword(c, keywords: list[str]) -> Column:
    """The first of ``keywords`` (in their order) that the folded text contains; null if none."""
    t = match_text(c)
    return F.coalesce(*[F.when(t.contains(k), F.lit(k)) for k in keywords])


def is_stop_domain(c, stops: list[str]) -> Column:
    """The domain is one of ``stops`` or lies below one."""
    c = _c(c)
    hit = F.lit(False)
    for s in stops:
        hit = hit | (c == s) | c.endswith("." + s)
    return hit


def stable_id(prefix: str, salt: str, c, length: int = 32) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat(F.lit(salt), _c(c)), 256), 1, length))


def asset_id(c) -> Column:
    """da- and 32 hex digits of the salted domain."""
    return stable_id("da-", "observatory:asset:", F.lower(trim_all(c)), 32)


def public_id(asset: Column, salt: str) -> Column:
    """pub_ and 16 hex digits of the asset's id with the salt of the day."""
    return stable_id("pub_", f"public:{salt}:", asset, 16)


def computation_hash(version: Column, ids: Column) -> Column:
    """SHA-256 over the version and the sorted ids, written as canonical JSON."""
    q = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    return F.sha2(F.concat(F.lit('{"codebookVersion":'), q(version), F.lit(',"observationIds":['), F.array_join(F.transform(F.array_sort(ids), q), ","), F.lit("]}")), 256)


def period_of(ts) -> Column:
    """YYYY-qN of a time."""
    return F.concat(F.year(ts).cast("string"), F.lit("-q"), F.quarter(ts).cast("string"))


def period_index(c) -> Column:
    """Quarters since year 0 of a period text; null unless it reads YYYY-qN."""
    c = _c(c)
    ok = c.rlike(r"^\d{4}-q[1-4]$")
    return F.when(ok, F.try_to_number(F.substring(c, 1, 4), F.lit("9999")).cast("long") * 4 + F.substring(c, 7, 1).try_cast("long") - 1)


def previous_period(c) -> Column:
    i = period_index(c) - 1
    return F.concat(F.floor(i / 4).cast("string"), F.lit("-q"), (F.pmod(i, F.lit(4)) + 1).cast("string"))


def iso_of_epoch(c) -> Column:
    return F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


#: Parts of a network error's message (upper case) and the class they tell, first match wins.
ERROR_PARTS = (
    (("ENOTFOUND", "DNS"), "ENOTFOUND"), (("ECONNREFUSED",), "ECONNREFUSED"), (("ETIMEDOUT", "CONNECT TIMED OUT"), "ETIMEDOUT"),
    (("SSL", "TLS", "CERTIFICATE", "CERT_", "ERR_CERT"), "SSL_ERROR"), (("REDIRECT",), "REDIRECT_LOOP"),
)
#: Codes of network errors and their classes.
ERROR_CODES = {"ERR_OPERATION_ABORTED": "TIMEOUT", "ENOTFOUND": "ENOTFOUND", "EAI_AGAIN": "ENOTFOUND", "ECONNREFUSED": "ECONNREFUSED", "ETIMEDOUT": "ETIMEDOUT", "ESOCKETTIMEDOUT": "ETIMEDOUT"}


def is_live(status) -> Column:
    """A response under 500 is a living site, client errors included; no response is none."""
    return F.coalesce(_c(status) < 500, F.lit(False))


def error_class(message, status, code=None) -> Column:
    """Class of a failed request: null for a living site, HTTP_5XX for its answer, else by the error's code, then by its message."""
    m, code = _c(message), F.lit(None).cast("string") if code is None else _c(code)
    out = F.when(is_live(status), F.lit(None).cast("string")).when(_c(status).isNotNull(), "HTTP_5XX").when(m.contains("abort") | m.contains("AbortError"), "TIMEOUT")
    for k, name in ERROR_CODES.items():
        out = out.when(code == k, name)
    for parts, name in ERROR_PARTS:
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.upper(m).contains(p)
        out = out.when(hit, name)
    return out.otherwise("UNKNOWN")


def strip_json_fence(c) -> Column:
    """JSON text out of a fenced code block; the outermost braces if there is no fence."""
    inner = F.regexp_extract(_c(c), r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(inner != "", inner).otherwise(F.regexp_extract(_c(c), r"(?s)(\{.*\})", 1))

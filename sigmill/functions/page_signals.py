"""All signals of an HTML page from one pass over its tags; runs as ``mapInPandas``, one parse per page."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame

from . import page_tables as T

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SCHEMA = "signal_path string, present boolean, url string, confidence int, value string"
#: What counts as a German telephone number and as an e-mail address.
PHONE = re.compile(r"(?:(?:\+49|0049)[\s\-/.]?\d[\s\-/.]?(?:\d[\s\-/.]?){6,13}|0\d[\s\-/.]?(?:\d[\s\-/.]?){5,12})", re.A)
EMAIL = re.compile(r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}")
YEAR = re.compile(r"(?:©|\(c\)|copyright)\s*(?:\d{4}\s*[-–—]\s*)?(\d{4})", re.I)
HOURS = re.compile(r"(?:öffnungszeiten|opening\s+hours|business\s+hours|horaires)[^\n]{0,60}\n([^\n]{5,120})", re.I)


class Page(HTMLParser):
    """What the signals need of a page; malformed markup is read as far as it goes."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.links: list[list] = []  # [href, text]
        self.marks: list[str] = []  # ids and classes, lower case
        self.texts: dict[str, list[str]] = {k: [] for k in ("body", "footer", "title", "h1")}
        self.alts, self.frames, self.actions, self.json_ld = [], [], [], []
        self.mail_form = self.banner = False
        self.toggles, self.buttons = 0, []
        self.lang = self.description = self.canonical = None
        self.stack: list[tuple[str, bool]] = []
        self.script: list[str] | None = None
        self.has_body = re.search(r"<body[\s/>]", html, re.I) is not None
        self.feed(html)
        self.close()

    def _inside(self, tag: str) -> bool:
        return any(t == tag for t, _ in self.stack)

    def handle_starttag(self, tag, attrs):
        a = {k: (v or "") for k, v in attrs}
        ident, cls = a.get("id", "").lower(), a.get("class", "").lower()
        self.marks += [x for x in (ident, cls) if x]
        root = any(m in ident or m in cls for m in T.COOKIE_MARKS) or ident in T.COOKIE_IDS or any(c in cls.split() for c in T.COOKIE_CLASSES)
        self.banner |= root
        scope = any(b for _, b in self.stack)
        if tag == "a" and "href" in a:
            self.links.append([a["href"], ""])
        if scope and (tag in ("button", "a") or a.get("role") == "button" or tag == "input" and a.get("type") in ("button", "submit")):
            self.buttons.append([tag, f" {a.get('value', '')} {a.get('aria-label', '')}"])
        if scope and (tag == "input" and a.get("type") in ("checkbox", "radio") or a.get("role") == "switch"):
            self.toggles += 1
        if tag == "form":
            self.actions.append(a.get("action", "").lower())
        if tag == "input" and self._inside("form") and (a.get("type") == "email" or "mail" in a.get("name", "").lower()):
            self.mail_form = True
        if tag == "iframe":
            self.frames.append(a.get("src", "").lower())
        if tag == "img":
            self.alts.append(a.get("alt", "").lower())
        if tag == "html":
            self.lang = a.get("lang") or None
        if tag == "meta" and a.get("name", "").lower() == "description":
            self.description = a.get("content")
        if tag == "link" and a.get("rel", "").lower() == "canonical":
            self.canonical = a.get("href")
        if tag == "script":
            self.script = [a.get("type", "")]
        if tag not in VOID:
            self.stack.append((tag, root or scope))

    def handle_endtag(self, tag):
        if tag == "script" and self.script is not None:
            if self.script[0] == "application/ld+json":
                self.json_ld.append("".join(self.script[1:]))
            self.script = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        if self.script is not None:
            self.script.append(data)
        tags = {t for t, _ in self.stack}
        if "a" in tags and self.links:
            self.links[-1][1] += data
        if self.buttons and self.buttons[-1][0] in tags:
            self.buttons[-1][1] += data
        for k in ("footer", "title", "h1"):
            if k in tags:
                self.texts[k].append(data)
        if "body" in tags or not self.has_body and not tags & {"head", "title"}:
            self.texts["body"].append(data)

    def text(self, part: str) -> str:
        return "".join(self.texts[part])


def fold(s: str) -> str:
    return re.sub(r"[\s\-_/]", "", s.lower())


def _keyword(href: str, text: str, words: dict[str, int]) -> int | None:
    h, t = fold(href), fold(text)
    return next((c for k, c in words.items() if k in h or k in t), None)


def _host(href: str) -> str:
    try:
        p = urlsplit(href)
    except ValueError:
        return ""
    return (p.hostname or "").removeprefix("www.") if p.scheme in ("http", "https") else ""


def _types(node, out: set) -> None:
    if isinstance(node, list):
        for x in node:
            _types(x, out)
    elif isinstance(node, dict):
        t = node.get("@type")
        out.update(str(x).lower() for x in (t if isinstance(t, list) else [t]) if x)
        for v in node.values():
            if isinstance(v, (dict, list)):
                _types(v, out)


def signals(html: str | None, base: str | None, as_of_year: int) -> list[tuple]:
    """(signal_path, present, url, confidence, value) of every signal; ``as_of_year`` bounds copyright years."""
    p = Page(html or "")
    body, out = p.text("body"), []
    low, alts = body.lower(), " ".join(p.alts)

    def add(path, present, url=None, confidence=None, value=None):
        out.append((path, bool(present), url if present else None, int(confidence) if present and confidence is not None else None, value))

    for path, words in T.FIRST_LINK.items():
        hit = next(((h, c) for h, t in p.links if (c := _keyword(h, t, words)) is not None), None)
        add(path, hit, urljoin(base or "", hit[0]) if hit else None, hit and hit[1])
    for path, words in T.BEST_LINK.items():
        best = None
        for h, t in p.links:
            if best is not None and best >= 85:
                break
            c = _keyword(h, t, words)
            best = c if c is not None and (best is None or c > best) else best
        if best is None and path in T.BODY_FALLBACK and any(x in low for x in T.BODY_FALLBACK[path][0]):
            best = T.BODY_FALLBACK[path][1]
        if best is None and path in T.MARK_FALLBACK and any(x in m for x in T.MARK_FALLBACK[path][0] for m in p.marks):
            best = T.MARK_FALLBACK[path][1]
        add(path, best is not None, None, best)
    form = 85 if any(x in m for x in T.CONTACT_MARKS for m in p.marks) or any(x in a for x in T.CONTACT_ACTIONS for a in p.actions) else 70 if p.mail_form else None
    add("contact.form.present", form, None, form)
    where = 95 if any(x in f for x in T.MAP_FRAMES for f in p.frames) else 65 if any(x in m for x in T.MAP_MARKS for m in p.marks) else None
    add("content.map.present", where, None, where)
    for path, (terms, words, images, conf) in T.BODY_TERMS.items():
        text = f"{low} {alts}" if images else low
        add(path, any(t in text for t in terms) or any(re.search(rf"(?<![a-z0-9_]){w}(?![a-z0-9_])", text) for w in words), None, conf)
    for path, (patterns, conf) in T.HOSTS.items():
        hit = next((h for h, _ in p.links if (n := _host(h)) and any(x in n for x in patterns)), None)
        add(path, hit, hit, conf)
    hit = next((h for h, _ in p.links if (n := _host(h)) and (any(n == g or n.endswith("." + g) for g in T.GOOGLE_HOSTS) or n in ("maps.google.com", "google.com") and ("cid=" in h or "/maps/place/" in h))), None)
    add("registry.google_business.present", hit, hit, 90)
    types: set[str] = set()
    hours = None
    for raw in p.json_ld:
        try:
            obj = json.loads(raw)
        except ValueError:
            continue
        _types(obj, types)
        if hours is None and isinstance(obj, dict):
            h = obj.get("openingHours") or (json.dumps(obj["openingHoursSpecification"]) if obj.get("openingHoursSpecification") else None)
            hours = ", ".join(map(str, h)) if isinstance(h, list) else str(h)[:500] if h else None
    for path, names in T.SCHEMA_TYPES.items():
        add(path, types & set(names))
    m = None if hours else HOURS.search(body)
    add("content.opening_hours.present", hours or m, None, 90 if hours else 50, hours or (m[1].strip() if m else None))
    years = [y for t in (p.text("footer"), body) if (y := [int(x) for x in YEAR.findall(t) if 1990 <= int(x) <= as_of_year + 1])]
    add("content.copyright.year", years, None, None, str(max(years[0])) if years else None)
    seen = lambda rx: any(re.search(rx, t, re.I) for _, t in p.buttons)
    quality = "none" if not p.banner else "granular_with_revoke" if p.toggles >= 2 and re.search(T.REVOKE, body, re.I) else "reject_equal_prominence" if seen(T.REJECT) else "accept_only" if seen(T.ACCEPT) or seen(T.SETTINGS) else "informational_only"
    add("privacy.consent.banner.present", p.banner, None, 80, quality)
    phones = list(dict.fromkeys(re.sub(r"^0", "+49", re.sub(r"^0049", "+49", re.sub(r"[\s\-/.]", "", x))) for x in PHONE.findall(body)))
    mails = list(dict.fromkeys(x.lower() for x in EMAIL.findall(body)))
    for path, v in (("contact.phones", phones), ("contact.emails", mails)):
        add(path, v, None, None, ";".join(v) or None)
    for path, v in (("page.title", p.text("title").strip()), ("page.h1", p.text("h1").strip()), ("page.description", p.description), ("page.canonical", p.canonical), ("page.lang", p.lang)):
        add(path, v, None, None, v or None)
    return out


def page_signals(pages: DataFrame, key: str, html: str, base: str | None, as_of_year: int) -> DataFrame:
    """Long table (key, signal_path, present, url, confidence, value): every page parsed once, no shuffle."""
    kind = pages.schema[key].dataType.simpleString()
    src = pages.select(key, html, *([base] if base else []))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *s) for k, h, *b in pdf.itertuples(index=False, name=None) for s in signals(h, b[0] if b else None, as_of_year)]
            out = pd.DataFrame(rows, columns=[key, "signal_path", "present", "url", "confidence", "value"])
            out["confidence"] = out["confidence"].astype("Int32")
            yield out

    return src.mapInPandas(run, f"{key} {kind}, {SCHEMA}")

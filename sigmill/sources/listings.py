"""Listing pages to catalogue rows: one page, any number of entries, through a parser chosen by the source."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

FIELDS = ("business_name", "street_address", "postal_code", "city", "phone", "email", "website_url", "category")
Parser = Callable[[str], list[dict]]


def _node(n: dict) -> dict:
    a = n.get("address") if isinstance(n.get("address"), dict) else {}
    return {"business_name": n.get("name"), "street_address": a.get("streetAddress"), "postal_code": a.get("postalCode"), "city": a.get("addressLocality"), "phone": n.get("telephone"), "email": n.get("email"), "website_url": n.get("url"), "category": n.get("category")}


def _walk(n, out: list[dict]) -> None:
    if isinstance(n, list):
        for x in n:
            _walk(x, out)
    elif isinstance(n, dict):
        if n.get("name") and isinstance(n.get("address"), dict):
            out.append(_node(n))
        else:
            for v in n.values():
                _walk(v, out)


class _Marked(HTMLParser):
    """Entries marked by microdata or by the classes of vCards; JSON-LD scripts are kept apart."""

    #: Property or class -> field.
    NAMES = {
        "name": "business_name", "fn": "business_name", "org": "business_name", "streetaddress": "street_address", "street-address": "street_address", "postalcode": "postal_code", "postal-code": "postal_code",
        "addresslocality": "city", "locality": "city", "telephone": "phone", "tel": "phone", "email": "email", "url": "website_url", "category": "category",
    }

    def __init__(self, html: str):
        super().__init__()
        self.rows: list[dict] = []
        self.scripts: list[str] = []
        self.depth, self.entry, self.field, self.script = 0, None, None, False
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        a = {k: (v or "") for k, v in attrs}
        void = tag in ("br", "img", "meta", "link", "input", "hr")
        self.depth += not void
        classes = a.get("class", "").lower().split()
        if self.entry is None and (("itemscope" in a and "business" in a.get("itemtype", "").lower()) or "vcard" in classes):
            self.entry = self.depth
            self.rows.append({})
        if self.entry is not None:
            f = next((self.NAMES[x] for x in [a.get("itemprop", "").lower(), *classes] if x in self.NAMES), None)
            if f:
                value = a.get("content") or (a.get("href") if f == "website_url" else None)
                if value:
                    self.rows[-1].setdefault(f, value)
                else:
                    self.field = (f, self.depth)
        self.script = tag == "script" and a.get("type") == "application/ld+json"
        if self.script:
            self.scripts.append("")

    def handle_endtag(self, tag):
        if self.field and self.depth == self.field[1]:
            self.field = None
        if self.entry == self.depth:
            self.entry = None
        self.depth = max(0, self.depth - 1)
        self.script = False

    def handle_data(self, data):
        if self.script:
            self.scripts[-1] += data
        elif self.field and self.rows:
            f = self.field[0]
            self.rows[-1][f] = (self.rows[-1].get(f, "") + data).strip()


def parse_listing(html: str) -> list[dict]:
    """Entries by JSON-LD, microdata and vCard marks, in this order."""
    p, out = _Marked(html), []
    for raw in p.scripts:
        try:
            _walk(json.loads(raw), out)
        except ValueError:
            continue
    return out + [r for r in p.rows if r.get("business_name")]


#: First part of a source's path -> parser; "" is the default.
PARSERS: dict[str, Parser] = {"": parse_listing}


def parse_pages(pages: DataFrame, path: str, html: str, parsers: dict[str, Parser] | None = None) -> DataFrame:
    """(source_path, source_item_key, fields...): a page gives any number of rows, an unreadable or null one none."""
    table = PARSERS | (parsers or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, h in zip(pdf[path], pdf[html]):
                for i, r in enumerate(table.get(str(p).split("/")[0], table[""])(h) if h else [], 1):
                    rows.append((p, f"{p}#{i}", *[None if r.get(f) in (None, "") else str(r[f]) for f in FIELDS]))
            yield pd.DataFrame(rows, columns=["source_path", "source_item_key", *FIELDS])

    return pages.select(path, html).mapInPandas(run, "source_path string, source_item_key string, " + ", ".join(f"{f} string" for f in FIELDS))

"""Passages of held-out items inside a corpus, tolerant to single changed words.

Fixed masks ignore selected token positions (spaced seeds). The hashes of the
seen positions of all items are joined with those of every document; where an
item's seeds hit often enough, a local alignment of the words around the hits
tells how much of the item stands there in its order.

The items are the stated query set: they are sent to the workers in blocks of
bounded size, and the corpus is read once per block and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .text import ACCENTED, BASE

#: Masks over token positions: 1 is hashed, 0 ignored.
MASKS = ("11111", "1101011", "11011001", "1010111")
#: Characters of items sent to the workers at once (about 100 MB of words and seeds there).
BLOCK_CHARS = 4_000_000
#: Words of documents that are hashed at once, and aligned pairs at once: bound what a task holds.
CHUNK_WORDS, CHUNK_PAIRS = 1_000_000, 64
#: Words that a task remembers.
CACHE = 300_000
FOLD = str.maketrans({**dict(zip(ACCENTED, BASE)), "ß": "ss"})
INVISIBLE = re.compile("[\u00ad\u200b-\u200d\ufeff]")
TAG = re.compile(r"</?[a-z!][^<>]*>")
ENTITY = re.compile(r"&([aou])uml;")
BROKEN = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n\s*(?=[a-zäöüß])")
WORD = re.compile(r"[^\W_]+(?:[?�]+[^\W_]+)*")


def raw_words(text: str) -> list[str]:
    """Lower-case words without markup, with words joined that a line break hyphenated."""
    t = text
    if "-" in t and "\n" in t:
        t = BROKEN.sub("", t)
    t = t.lower()
    if "<" in t:
        t = TAG.sub(" ", t)
    if "&" in t:
        t = ENTITY.sub(r"\1", t).replace("&szlig;", "ss")
    if INVISIBLE.search(t):
        t = INVISIBLE.sub("", t)
    return WORD.findall(t)


@lru_cache(maxsize=CACHE)
def fold(word: str) -> str:
    """A lower-case word without accents and transliterated umlauts."""
    return word.translate(FOLD).replace("ae", "a").replace("oe", "o").replace("ue", "u")


def plain_words(text: str) -> list[str]:
    """The folded words of a text."""
    return [fold(w) for w in raw_words(text)]


def _forms(word: str) -> set[str]:
    """The word and, from five letters on, its forms with one letter deleted."""
    return {word} | ({word[:i] + word[i + 1 :] for i in range(len(word))} if len(word) >= 5 else set())


class Item:
    """The words of an item and where a word of a document stands among them."""

    def __init__(self, words: list[str]):
        self.words = words
        self.by_form: dict[str, set[str]] = {}
        self.at: dict[str, list[int]] = {}
        for i, x in enumerate(words):
            self.at.setdefault(x, []).append(i)
        for x in self.at:
            for f in _forms(x):
                self.by_form.setdefault(f, set()).add(x)
        self.known: dict[str, list[int]] = {}

    def places(self, word: str) -> list[int]:
        """Positions of the same word; words of five letters or more are the same up to one edit or swap (a shared form)."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            near = set().union(*(self.by_form.get(f, ()) for f in _forms(word)))
            got = self.known[word] = [i for x in near for i in self.at[x]]
        return got


def covered(pairs: list[tuple[Item, list[str]]]) -> list[float]:
    """Per pair (item, document words): the share of the item's words that the best local alignment covers.

    Covered are the same words in the same order, and a single changed word
    between two of them. Longer differences and left out or inserted words
    cost but cover nothing. All pairs are aligned together, row by row.
    """
    if not pairs:
        return []
    n, m = max(len(a.words) for a, _ in pairs), max(len(b) for _, b in pairs)
    if not n or not m:
        return [0.0] * len(pairs)
    same = np.zeros((n, len(pairs), m), bool)
    for k, (a, b) in enumerate(pairs):
        places = [a.places(y) for y in b]
        same[[i for p in places for i in p], k, [j for j, p in enumerate(places) for _ in p]] = True
    # Score and covered words of an alignment share one integer: score * unit + covered.
    unit = 1 << (n + 1).bit_length()
    kind = np.int32 if (2 * n + m + 4) * unit < 1 << 31 else np.int64
    shape = (len(pairs), m + 1)
    ramp = (unit * np.arange(m + 1)).astype(kind)
    # Best alignments ending in a same word, in a single changed word, in a difference.
    hit, changed, other = np.zeros(shape, kind), np.zeros(shape, kind), np.zeros(shape, kind)
    best = np.zeros(len(pairs), kind)
    gain, loss = kind(2 * unit + 1), kind(unit - 1)
    for i in range(n):
        new_hit, new_changed = np.zeros(shape, kind), np.zeros(shape, kind)
        base = np.maximum(hit, other)
        np.maximum(base, changed, out=changed)
        np.multiply(changed[:, :-1] + gain, same[i], out=new_hit[:, 1:])
        np.maximum(hit[:, :-1] - loss, 0, out=new_changed[:, 1:])
        new_changed[:, 1:][same[i] | (hit[:, :-1] < unit)] = 0
        base[:, 1:] = np.maximum(np.maximum(base[:, 1:], base[:, :-1]), new_hit[:, :-1])
        base -= unit
        base += ramp
        np.maximum.accumulate(base, axis=1, out=base)
        base -= ramp
        base[base < unit] = 0
        hit, changed, other = new_hit, new_changed, base
        np.maximum(best, hit.max(axis=1), out=best)
    return [int(b % unit) / len(a.words) if a.words else 0.0 for b, (a, _) in zip(best, pairs)]


def contained(item: list[str], doc: list[str]) -> float:
    """``covered`` of one pair."""
    return covered([(Item(item), doc)])[0]


class Seeds:
    """Spaced seeds of a block of items, ready to be joined with those of documents."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids = [i for i, _ in items]
        words = [plain_words(t) for _, t in items]
        self.items = [Item(w) for w in words]
        self.code = {w: k for k, w in enumerate(dict.fromkeys(w for ws in words for w in ws), 1)}
        self.raw: dict[str, int] = {}
        self.size = np.array([len(w) for w in words], np.int64)
        h, item, pos = self.hashes(words)
        order = np.argsort(h, kind="stable")
        h, self.item, self.pos = h[order], item[order], pos[order]
        self.h, self.start = np.unique(h, return_index=True)
        self.end = np.append(self.start[1:], len(h))

    def hashes(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, position) of every mask at every place whose seen words are all known."""
        lens = np.array([len(w) for w in texts], np.int64)
        raw, code = self.raw, self.code
        if len(raw) >= CACHE:
            raw.clear()
        for w in {w for ws in texts for w in ws if w not in raw}:
            raw[w] = code.get(fold(w), 0)
        codes = np.array([raw[w] for ws in texts for w in ws], np.uint64)
        text = np.repeat(np.arange(len(texts)), lens)
        pos = np.arange(len(codes)) - np.repeat(np.cumsum(lens) - lens, lens)
        left = np.repeat(lens, lens) - pos
        out = []
        for k, mask in enumerate(MASKS):
            n = len(codes) - len(mask) + 1
            if n <= 0:
                continue
            ok = left[:n] >= len(mask)
            h = np.full(n, k, np.uint64)
            for o in (i for i, x in enumerate(mask) if x == "1"):
                c = codes[o : o + n]
                ok &= c > 0
                h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            at = np.flatnonzero(ok)
            out.append((h[at], text[at], pos[at]))
        if not out:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out))

    def candidates(self, docs: list[list[str]], hits: float) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, first, last place) where seeds start at a share ``hits`` of the item's positions."""
        if not len(self.h):
            return
        h, doc, pos = self.hashes(docs)
        i = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        found = np.flatnonzero(self.h[i] == h)
        doc, pos, i = doc[found], pos[found], i[found]
        many = self.end[i] - self.start[i]
        first = np.repeat(np.cumsum(many) - many, many)
        j = np.repeat(self.start[i], many) + np.arange(int(many.sum())) - first
        frame = pd.DataFrame({"doc": np.repeat(doc, many), "pos": np.repeat(pos, many), "item": self.item[j], "ipos": self.pos[j]})
        got = frame.groupby(["doc", "item"]).agg(k=("ipos", "nunique"), lo=("pos", "min"), hi=("pos", "max")).reset_index()
        got = got[got["k"].to_numpy() >= self.size[got["item"].to_numpy(np.int64)] * hits]
        yield from got[["doc", "item", "lo", "hi"]].itertuples(index=False, name=None)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[list[str]]]]:
    ids, words, size = [], [], 0
    for pdf in batches:
        for i, t in zip(pdf["doc"], pdf["text"]):
            w = raw_words(t)
            ids.append(i)
            words.append(w)
            size += len(w)
            if size >= CHUNK_WORDS:
                yield ids, words
                ids, words, size = [], [], 0
    if ids:
        yield ids, words


def leaked_items(docs: DataFrame, items: DataFrame, share: float = 0.5, hits: float = 0.18) -> DataFrame:
    """(doc, item, share) of documents that contain at least ``share`` of an item's words in order in one place.

    ``docs``: (doc, text), ``items``: (item, text). Seeds of an item must
    start at a fraction ``hits`` of its positions before the pair is aligned;
    general sentences that items share with ordinary pages stay below. Null
    and empty texts and texts shorter than a mask match nothing. Of rows with
    one id the best share counts. Any number of items is taken in blocks of
    ``BLOCK_CHARS``; one item must fit in a worker.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = items.where("item is not null and text is not null").select("item", "text").distinct()
    total = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_CHARS))
    schema = f"doc {docs.schema['doc'].dataType.simpleString()}, item {items.schema['item'].dataType.simpleString()}, share double"
    corpus = docs.where("text is not null").select("doc", "text")

    def search(block: int) -> DataFrame:
        rows = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()  # a block of the query set
        shared = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in rows])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            seeds = Seeds(shared.value)
            for ids, words in _chunks(batches):
                held = []
                for d, i, lo, hi in seeds.candidates(words, hits):
                    n = len(seeds.items[i].words)
                    held.append((ids[d], seeds.ids[i], seeds.items[i], [fold(w) for w in words[d][max(0, lo - n) : hi + n + 10]]))
                held.sort(key=lambda x: len(x[3]))  # pairs of like size are aligned together
                for k in range(0, len(held), CHUNK_PAIRS):
                    part = held[k : k + CHUNK_PAIRS]
                    got = covered([(a, b) for _, _, a, b in part])
                    out = pd.DataFrame({"doc": [x[0] for x in part], "item": [x[1] for x in part], "share": got})
                    yield out[out["share"] >= share]

        return corpus.mapInPandas(run, schema)

    found = search(0)
    for block in range(1, blocks):
        found = found.unionByName(search(block))
    return found.groupBy("doc", "item").agg(F.max("share").alias("share"))

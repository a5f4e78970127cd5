"""Text decoded with a wrong character set: find it and restore the original.

Characters are mapped back to the bytes of a legacy encoding, an automaton over
the byte structure of UTF-8 finds the maximal well-formed multibyte spans, and
only those spans are decoded; rounds repeat for text encoded twice. What has no
multibyte structure (one legacy encoding read as another, signs lost to ``?``
or U+FFFD) is judged by where the sign stands in its word and, where that
doesn't decide, by how often the restored word and its letter trigrams occur in
all rows.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import cut, spread

#: Encodings in which UTF-8 bytes may have been read.
SHOWN_AS = ("cp1252", "cp437", "cp850", "cp1251", "mac_roman")
#: (true encoding, encoding it was read as) of one-byte confusions.
CONFUSED = (
    ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"),
    ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp437", "mac_roman"), ("mac_roman", "cp850"),
)
GERMAN = "äöüßÄÖÜ"
#: What can stand for a sign lost to "?" at the end of a word.
LOST = "äöüßéøåçłñã"
#: A value without any of these needs no look.
SUSPICIOUS = r"[^\x00-\x7FäöüÄÖÜß]|\?|\+[A-Za-z0-9+/]{2,}-"
#: Signs that may stand inside a word.
JOINERS = set("-'’`´.&/+,:;*()|_@#\"“”„»«!–—·…") - set("„”“…")


@lru_cache
def _bytes_of(encoding: str) -> dict[str, int]:
    """Character -> byte of the encoding; bytes it leaves undefined are shown as C1 controls."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            pass
        if encoding in ("cp1252", "cp1251"):
            out.setdefault(chr(b), b)
    return out


@lru_cache
def _letters(true: str, shown: str) -> dict[str, str]:
    """Shown character -> letter that was meant, for one confusion."""
    out = {}
    for c, b in _bytes_of(shown).items():
        try:
            meant = bytes([b]).decode(true)
        except UnicodeDecodeError:
            continue
        if meant != c and meant.isalpha() and ord(meant) < 0x180 and meant not in "ªº":
            out[c] = meant
    return out


def _spans(text: str, encoding: str) -> tuple[str, bool]:
    """Decode the maximal well-formed multibyte spans of ``text`` seen as bytes of ``encoding``."""
    table = _bytes_of(encoding)
    out, i, hit = [], 0, False
    while i < len(text):
        lead = table.get(text[i], 0)
        need = 1 if 0xC2 <= lead <= 0xDF else 2 if 0xE0 <= lead <= 0xEF else 3 if 0xF0 <= lead <= 0xF4 else 0
        tail = [table.get(c, 0) for c in text[i + 1 : i + 1 + need]]
        if need and len(tail) == need and all(0x80 <= b <= 0xBF for b in tail):
            try:
                c = bytes([lead, *tail]).decode("utf-8")
            except UnicodeDecodeError:
                c = ""
            if c and (c.isalpha() and ord(c) < 0x250 or 0xA0 <= ord(c) < 0x100 or 0x2010 <= ord(c) <= 0x2122 or c == "﻿"):
                out.append(c)
                i += 1 + need
                hit = True
                continue
        out.append(text[i])
        i += 1
    return "".join(out), hit


def _utf7(m: re.Match) -> str:
    try:
        out = base64.b64decode(m[1] + "=" * (-len(m[1]) % 4)).decode("utf-16-be")
    except ValueError:
        return m[0]
    return out if out and all(c.isalpha() and not c.isascii() or 0x2010 <= ord(c) < 0x2200 for c in out) else m[0]


def restore_spans(text: str, rounds: int = 3) -> tuple[str, bool]:
    """(text with all multibyte spans decoded, whether there was one)."""
    found = False
    if "+" in text:
        new = UTF7.sub(_utf7, text)
        text, found = new, new != text
    for _ in range(rounds):
        best = None
        for enc in SHOWN_AS:
            new, hit = _spans(text, enc)
            if hit and (best is None or len(new) < len(best)):
                best = new
        if best is None:
            break
        text, found = best, True
    return text.replace("﻿", ""), found


def _symbol(c: str) -> bool:
    """No letter of a script: signs, and modifier letters, which no word is spelt with."""
    return not c.isalpha() or unicodedata.category(c) == "Lm"


def _script(c: str) -> str:
    n = ord(c)
    return "x" if 0x370 <= n < 0x530 and c.isalpha() else "l" if c.isalpha() else ""


#: A span of UTF-7, which pure ASCII readers leave as it is.
UTF7 = re.compile(r"\+([A-Za-z0-9+/]{2,})-")
WORD = re.compile(r"[^\s\-/(),.&|]+")


def _word_state(word: str) -> str:
    """'bad': certainly wrong, 'ask': the corpus decides, '': nothing to ask."""
    latin = any(_script(c) == "l" and ord(c) < 0x250 for c in word)
    ask = False
    for i, c in enumerate(word):
        if c == "�" or 0x80 <= ord(c) <= 0x9F or 0x2500 <= ord(c) <= 0x259F:
            return "bad"
        if c.isascii() and c != "?" or c in GERMAN:
            continue
        left, right = (word[i - 1] if i else ""), (word[i + 1] if i + 1 < len(word) else "")
        inner = left.isalpha() and right.isalpha()
        if c in "„”“…" and not inner:
            continue
        if _script(c) == "x" and latin:
            return "bad"
        if c == "?":
            if right.isalpha():
                return "bad"
            ask |= left.isalpha()
            continue
        meant = {m[c] for m in map(lambda p: _letters(*p), CONFUSED) if c in m}
        if not meant:
            continue
        if _symbol(c) and inner and c not in JOINERS and any(m.islower() or left.isupper() and right.isupper() for m in meant):
            return "bad"
        ask = True
    return "ask" if ask else ""


def _candidates(word: str) -> set[str]:
    out = set()
    for pair in CONFUSED:
        m = _letters(*pair)
        new = "".join(m.get(c, c) if not c.isascii() and c not in GERMAN else c for c in word)
        if new != word and all(c.isascii() or c.isalpha() for c in new):
            out.add(new)
    for lost in {"?", "�"} & set(word):
        out |= {word.replace(lost, x) for x in (LOST.upper() if word.isupper() else LOST + "ÄÖÜ")}
    return out


def inspect(value: str) -> tuple[str, bool, list[tuple[str, str]]]:
    """(value with spans decoded, certainly wrong, [(word, possible original)] for the corpus to decide)."""
    text, bad = restore_spans(value)
    bad |= value[:1] in "﻿​￾" and value != ""
    ask = []
    for m in WORD.finditer(text):
        word = m.group()
        if word.isascii() and "?" not in word:
            continue
        s = _word_state(word)
        bad |= s == "bad"
        if s and len(word) > 1:
            ask += [(word, c) for c in sorted(_candidates(word))]
    return text, bad, ask


def _inspect_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        got = [inspect(v) for v in pdf["value"]]
        yield pd.DataFrame(
            {"value": pdf["value"].to_numpy(), "text": [g[0] for g in got], "bad": [g[1] for g in got],
             "ask": [[{"word": w, "cand": c} for w, c in g[2]] for g in got]}
        )


def _trigrams(word) -> F.Column:
    """Distinct letter trigrams of a word with its borders."""
    w = F.concat(F.lit("^"), F.lower(word), F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 2, F.lit(1))), lambda i: F.substring(w, i, F.lit(3))))


def damaged_values(values: DataFrame, column: str = "value", margin: float = 3.0) -> DataFrame:
    """(value, restored, bad) of the distinct suspicious values in ``column``.

    ``bad`` is true where at least one character is wrong by decoding;
    ``restored`` is the original as far as it can be told. Word and trigram
    counts cover all rows. A word of doubt is wrong if a possible original is
    ``margin`` times as frequent, or, where neither is known, if the trigrams
    that only the original has are that much more frequent. Null and empty
    values are not damaged.
    """
    v = values.select(F.col(column).alias("value")).where("value is not null and value != ''")
    counted = v.groupBy("value").agg(F.count("*").alias("n"))
    doubt = counted.where(F.col("value").rlike(SUSPICIOUS)).select("value")
    seen = spread(doubt, "value").mapInPandas(_inspect_batches, "value string, text string, bad boolean, ask array<struct<word:string,cand:string>>")
    seen = cut(seen)
    words = counted.select(F.explode(F.split(F.lower("value"), r"[\s\-/(),.&|]+")).alias("w"), "n").where("w != ''").groupBy("w").agg(F.sum("n").alias("n"))
    asked = seen.select(F.explode("ask").alias("a")).select("a.word", "a.cand").distinct()
    asked = (
        asked.join(words.select(F.col("w").alias("_w"), F.col("n").alias("n_word")), F.lower("word") == F.col("_w"), "left").drop("_w")
        .join(words.select(F.col("w").alias("_c"), F.col("n").alias("n_cand")), F.lower("cand") == F.col("_c"), "left").drop("_c")
        .fillna(0, ["n_word", "n_cand"])
    )
    known = asked.where(F.col("n_cand") >= margin * F.greatest("n_word", F.lit(1)))
    # Words that occur nowhere else: the trigrams around the changed signs decide.
    open_ = asked.where((F.col("n_cand") < margin) & (F.col("n_word") <= margin) & ~F.col("word").rlike("[?�]"))
    grams = words.where(~F.col("w").rlike(SUSPICIOUS) | (F.col("n") > 20)).select(F.explode(_trigrams(F.col("w"))).alias("g"), "n").groupBy("g").agg(F.sum("n").alias("gn"))
    own = lambda mine, other, new: F.transform(F.array_except(_trigrams(F.col(mine)), _trigrams(F.col(other))), lambda g: F.struct(g.alias("g"), F.lit(new).alias("new")))
    both = open_.select("word", "cand", F.explode(F.concat(own("cand", "word", True), own("word", "cand", False))).alias("d")).select("word", "cand", "d.*")
    both = both.join(grams, "g", "left").select("word", "cand", "new", F.coalesce("gn", F.lit(0)).alias("gn"))
    by_gram = both.groupBy("word", "cand").agg(
        F.avg(F.when(F.col("new"), F.log1p("gn"))).alias("s_cand"), F.avg(F.when(~F.col("new"), F.log1p("gn"))).alias("s_word"), F.min(F.when(F.col("new"), F.col("gn"))).alias("s_cand_min"),
    ).where((F.col("s_cand_min") > 0) & (F.col("s_cand") > F.col("s_word") + F.log(F.lit(margin))))
    decided = known.select("word", "cand", (F.lit(1000.0) + F.log1p("n_cand")).alias("s")).unionByName(by_gram.select("word", "cand", F.col("s_cand").alias("s")))
    best = decided.groupBy("word").agg(F.max_by("cand", F.struct("s", "cand")).alias("cand"))
    hits = (
        seen.select("value", F.explode(F.array_distinct(F.transform("ask", lambda a: a["word"]))).alias("word"))
        .join(best, "word").groupBy("value").agg(F.collect_list(F.struct("word", "cand")).alias("repairs"))
    )
    repaired = F.aggregate(F.coalesce("repairs", F.array().cast("array<struct<word:string,cand:string>>")), F.col("text"), lambda t, r: F.replace(t, r["word"], r["cand"]))
    return seen.select("value", "text", "bad").join(hits, "value", "left").select(
        "value", repaired.alias("restored"), (F.col("bad") | F.col("repairs").isNotNull()).alias("bad")
    )


def _restore_quick(s: pd.Series) -> pd.Series:
    return s.map(lambda v: v if v is None or v.isascii() and "+" not in v else quick(v))


@lru_cache(maxsize=100_000)
def quick(value: str) -> str:
    """Restoration without corpus counts: spans, and signs whose place in the word gives them away."""
    text = restore_spans(value)[0]

    def fix(m: re.Match) -> str:
        word = m.group()
        if word.isascii():
            return word
        best = None
        for pair in CONFUSED:
            t = _letters(*pair)
            odd = [c for c in word if not c.isascii() and c not in GERMAN]
            if odd and all(t.get(c, "") and t[c] in GERMAN for c in odd) and (_word_state(word) == "bad" or all(_symbol(c) or c in "õšŠŸáŽﬂ" for c in odd)):
                new = "".join(t.get(c, c) if c in odd else c for c in word)
                if any(a.islower() and b in "ÄÖÜ" for a, b in zip(new, new[1:])):
                    continue
                if word[-1] in odd and not new.lower().endswith("ß"):
                    continue
                best = best or new
        return best or word

    return unicodedata.normalize("NFC", WORD.sub(fix, text))


restore_udf = F.pandas_udf(_restore_quick, StringType())

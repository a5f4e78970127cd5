"""Texts that were cut off before their last sentence is complete.

Texts are split into segments (sentences and lines). The last segment that
belongs to the body, whatever menu, address or markup stands behind it, is cut
if it is a strict prefix of longer copies elsewhere: all distinct segments and
all open tails are sorted by value, running counts along the order tell how
many segments begin with a tail, and how many are equal to it. Tails whose
names and figures occur nowhere else are looked up once more by their plain
words, names and figures being replaced by one mark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, spread

#: Beginnings of lines that stand behind a text without being a part of it.
TRAILING = (
    "©", "(c) ", "tel", "telefon", "fax", "mobil", "email", "e-mail", "stand:", "öffnungszeiten:", "opening hours:", "ihr team", "your team", "mit freundlichen",
    "freundliche grüße", "kind regards", "best regards", "http://", "https://", "www.",
)
#: Lines of one address, one number or one signed name.
LONE = re.compile(r"[\w.+-]+@[\w.-]+\s*$|\+?[\d\s()/-]{6,}$|[a-zäöü]\.\s*[\wäöüß-]+$")
#: Steps of a menu.
MENU = re.compile(r".*\s\|\s.*\||\S+(?: \S+)? \| \S+$")
#: Items of a list: a list behind a text is no part of its last sentence, but its last item is judged too.
BULLET = re.compile(r"[-–*•]\s+")
#: Short forms whose full stop ends no sentence; so do single letters.
SHORT = frozenset(("ca", "bzw", "inkl", "Nr", "Hausnr", "Tel", "Dr", "St", "Inh", "Fa", "evtl", "ggf"))
#: A sentence may end here.
SENTENCE = re.compile(r"[.!?][\"“”«)]?\s+(?=[A-ZÄÖÜÉ„»\"(])")
#: Closing marks, and what may stand behind them.
CLOSING, BEHIND = frozenset("!?:;."), "\"'“”«»)]*_ "
#: Marks of a cut, put behind it by whoever cut, and the characters they end with.
CUT_MARK = re.compile(r"(?:\s*(?:…|\.\.\.|\[…\]|\[\.\.\.\]|\(…\)|\[mehr\]|\bmehr\b|\[?\bweiterlesen\b\]?|\bread more\b|»)\s*)+$")
MARK_ENDS = frozenset("….])rne»")
TAG = re.compile(r"</?[A-Za-z][^<>]*(?:>|$)|<$")
UMLAUT, UMLAUTS = re.compile(r"&[aouAOU]uml;"), str.maketrans("aouAOU", "äöüÄÖÜ")
HALF_ENTITY = re.compile(r"&#?\w{0,6}$")
FIGURE, WORD = re.compile(r"\d+(?:[.,]\d+)*"), re.compile(r"[^\W_]+")
#: Greater than every character of a text: closes the range of the values with one prefix.
LAST = "\U0010ffff"
#: Plain words that a tail must have to be looked up without its names.
PLAIN = 2


def body_lines(text: str) -> list[str]:
    """Lines of a text without markup and outer blanks, empty ones left out; a tag or entity that the cut left half is dropped."""
    if "<" in text:
        text = TAG.sub("\n", text)
    if "&" in text:
        text = HALF_ENTITY.sub("", UMLAUT.sub(lambda m: m[0][1].translate(UMLAUTS), text).replace("&szlig;", "ß").replace("&nbsp;", " ").replace("&amp;", "&"))
    return [x for x in (" ".join(line.split()) for line in text.split("\n")) if x]


def is_trailer(line: str) -> bool:
    """What stands behind a text: contacts, menus, greetings."""
    low = line.lower()
    if low.startswith(TRAILING):
        start = next(t for t in TRAILING if low.startswith(t))
        if not start[-1].isalpha() or not low[len(start) : len(start) + 1].isalpha():
            return True
    return ("@" in low or low[1:2] == "." or low[0].isdigit() or low[0] in "+(") and LONE.match(low) is not None or "|" in low and MENU.match(low) is not None


def is_short(before: str) -> bool:
    """Whether a text ends with a short form or a single letter (its full stop left out)."""
    word = before[before.rfind(" ") + 1 :].lstrip("(„\"")
    return word in SHORT or len(word) == 1 and word.isalpha() or word[-2:-1] == "." and word[-1].isalpha()


def segments(lines: list[str]) -> list[str]:
    """Sentences of lines: a closing mark, a blank and an upper-case letter part them, unless a short form ends there."""
    out = []
    for line in lines:
        at = 0
        for m in SENTENCE.finditer(line):
            if line[m.start()] != "." or not is_short(line[at : m.start()]):
                out.append(line[at : m.end()].rstrip())
                at = m.end()
        out.append(line[at:])
    return [x for x in out if x]


def is_closed(segment: str) -> bool:
    """A closing mark stands at the end, perhaps quotes or brackets behind it."""
    bare = segment.rstrip(BEHIND)
    return bare != "" and bare[-1] in CLOSING and not (bare[-1] == "." and is_short(bare[:-1])) or bare.endswith(" …")


def keys(segment: str, closed: bool) -> tuple[str, str]:
    """The two forms that are compared: lower-case words with figures folded, and the words in small letters with
    one ``*`` for every run of names, nouns and figures. The closing mark is a part of them, so that what stops right
    before it is a strict prefix too."""
    words = WORD.findall(FIGURE.sub("0", segment))
    plain, last = [], ""
    for w in words:
        mark = w if w[0].islower() else "*"
        if mark != "*" or last != "*":
            plain.append(mark)
        last = mark
    end = " ." if closed else ""
    return "a " + " ".join(words).lower() + end, "b " + " ".join(plain) + end


def pieces(text: str) -> tuple[list[tuple[str, bool]], list[str]]:
    """(segments with whether they are closed, open tails without marks of a cut) of a text.

    The tails are the last segment of the body and the last item of a list at the end.
    """
    lines = [x for x in body_lines(text) if not is_trailer(x)]
    items = [BULLET.sub("", x) for x in lines if BULLET.match(x)]
    groups = [(segments([x for x in lines if not BULLET.match(x)]), True), (segments(items), bool(lines) and BULLET.match(lines[-1]) is not None)]
    inner, tails = [], []
    for found, judged in groups:
        for k, s in enumerate(found):
            last = judged and k == len(found) - 1
            m = CUT_MARK.search(s) if last and s[-1] in MARK_ENDS else None
            if m and not s.endswith(" …"):
                tails.append(s[: m.start()])
            elif last and not is_closed(s):
                tails.append(s)
            else:
                inner.append((s, is_closed(s)))
    return inner, tails


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the segments of a batch, and its tails, which keep their document."""
    for pdf in batches:
        raw: Counter = Counter()
        tails = []
        for doc, text in zip(pdf["doc"], pdf["text"]):
            inner, ends = pieces(text)
            raw.update(inner)
            th = hash_text(text) if ends else 0
            tails += [(v, 0, True, doc, th, t) for t in ends for v in keys(t, False)]
        count: Counter = Counter()
        for (s, closed), n in raw.items():
            for v in keys(s, closed):
                count[v] += n
        rows = [(v, n, False, None, 0, None) for v, n in count.items()] + tails
        yield pd.DataFrame([r for r in rows if len(r[0]) > 4], columns=["v", "n", "asks", "doc", "th", "tail"], dtype=object)


def hash_text(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Along sorted points of one partition: for every asked point the rows before it and those equal to it, and the total."""
    total, last, last_n, pid = 0, None, 0, -1
    for pdf in batches:
        if pdf.empty:
            continue
        pid = int(pdf["pid"].iloc[0])
        n, side, v = pdf["n"].to_numpy(np.int64), pdf["side"].to_numpy(), pdf["v"].to_numpy(object)
        at = total + np.cumsum(n)
        asked = np.flatnonzero(side >= 0)
        same = np.zeros(len(asked), np.int64)
        for k, i in enumerate(asked):
            if side[i] == 0:
                before, count = (v[i - 1], n[i - 1]) if i else (last, last_n)
                same[k] = count if before == v[i] else 0
        yield pd.DataFrame({"pid": pid, "v": v[asked], "side": side[asked], "at": at[asked], "same": same})
        total, last, last_n = int(at[-1]), v[-1], int(n[-1])
    if pid >= 0:
        yield pd.DataFrame({"pid": [pid], "v": [None], "side": [9], "at": [total], "same": [0]})


def prefix_counts(values: DataFrame, asked: DataFrame) -> DataFrame:
    """(v, same, longer) of the strings in ``asked`` (v): rows of ``values`` (v, n), v distinct, equal to it and strictly beginning with it.

    One sort by value: what begins with a string lies between it and the
    string closed by the greatest character. Ranges cut anywhere, so frequent
    beginnings are spread; running counts of the ranges are added up by a table
    with one row per range. Null strings are neither counted nor asked.
    """
    ask = asked.where("v is not null").select("v").distinct()
    points = (
        values.where("v is not null").select("v", F.col("n").cast("long").alias("n"), F.lit(-1).alias("side"))
        .unionByName(ask.select("v", F.lit(0).cast("long").alias("n"), F.lit(0).alias("side")))
        .unionByName(ask.select(F.concat("v", F.lit(LAST)).alias("v"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("side")))
    )
    ordered = points.repartitionByRange("v", "side").sortWithinPartitions("v", "side").withColumn("pid", F.spark_partition_id())
    told = cut(ordered.mapInPandas(_running, "pid int, v string, side int, at long, same long"))
    w = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = told.where("side = 9").select("pid", F.coalesce(F.sum("at").over(w), F.lit(0)).alias("before"))
    told = told.where("side < 9").join(F.broadcast(before), "pid")
    value = F.when(F.col("side") == 1, F.expr("substring(v, 1, length(v) - 1)")).otherwise(F.col("v"))
    place = F.col("at") + F.col("before")
    return told.groupBy(value.alias("v")).agg(
        F.sum("same").alias("same"), F.sum(F.when(F.col("side") == 1, place).otherwise(-place)).alias("longer")
    )


def truncated_documents(docs: DataFrame) -> DataFrame:
    """(doc, source, tail, cut): one row per document with a text; ``tail`` is the open tail that was judged.

    A document is cut if its last body segment (or the last item of a list
    behind it) is open or marked as cut and, with figures folded and the mark
    taken off, is a strict prefix of more segments of the corpus than are equal
    to it; other documents with the same tail count as equal, unless their
    whole text is the same. A tail that no segment equals or begins with is
    looked up by ``PLAIN`` or more plain words, its names left open. Open tails
    of documents are no longer copies. Counts cover all documents. Null and
    empty texts are not cut; texts of trailers only neither.
    """
    texts = spread(docs.where("text is not null").select("doc", "text"))
    found = texts.mapInPandas(_pieces, f"v string, n long, asks boolean, doc {docs.schema['doc'].dataType.simpleString()}, th long, tail string")
    # Values collapse to their counts, open tails stay rows of their own.
    rows = cut(found.groupBy("v", "asks", "doc", "th", "tail").agg(F.sum("n").alias("n")))
    values = rows.where("not asks").select("v", "n")
    tails = rows.where("asks").select("v", "doc", "th", "tail")
    known = prefix_counts(values, tails)
    others = tails.groupBy("v").agg((F.countDistinct("th") - 1).alias("others"))
    judged = tails.join(known.join(others, "v"), "v").withColumn("a", F.col("v").startswith("a "))
    judged = judged.withColumn("plain_words", F.size(F.filter(F.split("v", " "), lambda x: x != "*")) - 1).withColumn("more", F.col("longer") > F.col("same") + F.col("others"))
    told = judged.groupBy("doc", "tail").agg(
        F.max(F.col("a") & F.col("more")).alias("as_is"), F.max(F.col("a") & (F.col("longer") + F.col("same") > 0)).alias("seen"),
        F.max(~F.col("a") & (F.col("plain_words") >= PLAIN) & F.col("more")).alias("by_plain"),
    )
    found = told.select("doc", "tail", (F.col("as_is") | ~F.col("seen") & F.col("by_plain")).alias("cut"))
    found = found.groupBy("doc").agg(F.max("cut").alias("cut"), F.max_by("tail", F.struct("cut", "tail")).alias("tail"))
    return docs.where("text is not null").select("doc", "source").join(found, "doc", "left").select("doc", "source", "tail", F.coalesce("cut", F.lit(False)).alias("cut"))

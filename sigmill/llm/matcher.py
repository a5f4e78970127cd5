"""Ranking against a reference list that fits in memory: the same rule as ``canonical.rank_entries``.

The list is counted before it is collected; a longer list takes the join.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..session import spread
from .text import LONG, PIECE

#: Longest reference list (wordings) that is sent to the workers; about 20 MB with its index.
MAX_WORDINGS = 20_000
#: The rarest word shared must have this share of the weight of the wording's rarest word.
TOP = 0.7


def _cuts(word: str, most: int) -> set[str]:
    out = {word}
    last = {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


def _keys(word: str, most: int, shifts: int) -> set[str]:
    """``text.near_keys`` of one word."""
    n, out = len(word), set()
    if n <= LONG + 2:
        out |= _cuts(word, most)
    if n >= LONG - 4:
        out |= {"<" + word[:PIECE], ">" + word[-PIECE:]} | {"=" + word[i : i + PIECE] for i in range(PIECE - shifts, PIECE + shifts + 1)}
    return out


def _allowed(n: int) -> int:
    return 2 if n >= 7 else 1 if n >= 4 else 0


def levenshtein(a: str, b: str, most: int = 99) -> int:
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


class Matcher:
    """Soft TF-IDF ranking of repaired words against the wordings of a list."""

    def __init__(self, wordings: list[tuple[str, tuple[str, ...]]]):
        self.wordings = sorted({(e, tuple(sorted(set(w)))) for e, w in wordings})
        n = len({e for e, _ in self.wordings})
        of = defaultdict(set)
        for e, ws in self.wordings:
            for w in ws:
                of[w].add(e)
        self.idf = {w: math.log1p(n / len(es)) for w, es in of.items()}
        self.top = [max((self.idf[w] for w in ws), default=0.0) for _, ws in self.wordings]
        self.mass = [sum(self.idf[w] ** 2 for w in ws) for _, ws in self.wordings]
        self.holds = defaultdict(list)
        for k, (_, ws) in enumerate(self.wordings):
            for w in ws:
                self.holds[w].append(k)
        self.near = defaultdict(set)
        for w in self.idf:
            if len(w) >= 3:
                for c in _keys(w, _allowed(len(w) + 1), 2):
                    self.near[c].add(w)
        self.known: dict[str, list[tuple[str, float]]] = {}

    def repair(self, word: str) -> list[tuple[str, float]]:
        """(term, similarity) of the nearest terms."""
        if word in self.idf:
            return [(word, 1.0)]
        got = self.known.get(word)
        if got is None:
            got = []
            if len(word) >= 4 and not any(c.isdigit() for c in word):
                most = 4 if len(word) >= 9 else 2
                found = {t: levenshtein(word, t, most) for c in _keys(word, _allowed(len(word)), 0) for t in self.near.get(c, ())}
                found = {t: d for t, d in found.items() if d <= most}
                least = min(found.values(), default=0)
                got = [(t, 1 - d / max(len(word), len(t))) for t, d in found.items() if d == least]
            if len(self.known) < 200_000:
                self.known[word] = got
        return got

    def rank(self, words: list[str], coverage: float, agreement: float) -> str | None:
        words = set(words)
        sims: dict[str, float] = {}
        for w in words:
            for t, s in self.repair(w):
                sims[t] = max(s, sims.get(t, 0.0))
        got: dict[int, list[float]] = defaultdict(lambda: [0.0, 0, 0.0])
        for t, s in sims.items():
            for k in self.holds[t]:
                got[k][0] += self.idf[t] ** 2 * s
                got[k][1] += 1
                got[k][2] = max(got[k][2], self.idf[t])
        best = min(
            ((-g / math.sqrt(self.mass[k]), -g / self.mass[k], self.wordings[k][0]) for k, (g, n, top) in got.items() if g / self.mass[k] >= coverage and n >= agreement * len(words) and top >= TOP * self.top[k]),
            default=None,
        )
        return best and best[2]


def rank_small(values: DataFrame, wordings: list[tuple[str, tuple[str, ...]]], coverage: float, agreement: float) -> DataFrame:
    """(value, entry) for (value, words) by a matcher that every Python worker builds once per task."""
    shared = values.sparkSession.sparkContext.broadcast(wordings)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = None
        for pdf in batches:
            m = m or Matcher(shared.value)
            out = pd.DataFrame({"value": pdf["value"], "entry": [m.rank(list(w), coverage, agreement) if w is not None else None for w in pdf["words"]]})
            yield out[out["entry"].notna()]

    return spread(values.select("value", "words"), "value").mapInPandas(run, "value string, entry string")


def collect_wordings(entries: DataFrame) -> list[tuple[str, tuple[str, ...]]] | None:
    """The list, or None if it is longer than ``MAX_WORDINGS``."""
    rows = entries.select("entry", "words").distinct().limit(MAX_WORDINGS + 1).collect()
    return None if len(rows) > MAX_WORDINGS else [(r["entry"], tuple(r["words"])) for r in rows]

"""Probabilistic record linkage of two tables without a common key.

Several blocking passes propose pairs, each attribute is compared on a few
agreement levels, expectation-maximisation estimates how often each level
occurs among matches and non-matches, and the posterior is the confidence.
EM runs on the counts of level patterns (a few hundred at most), which a
distributed aggregation gathers from all candidate pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .encoding import restore_udf
from .text import skeleton, tokens

#: Legal forms and ornaments of firm names, folded.
FIRM_NOISE = (
    "gmbh", "ohg", "gbr", "ug", "kg", "co", "ek", "e", "k", "haftungsbeschrankt", "gesellschaft", "mbh", "firma", "fa", "betrieb", "und",
    "meisterbetrieb", "ihr", "eingetr", "kaufmann", "inh", "ag", "eingetragener",
)
#: Levels that tell nothing (an attribute is missing on one side).
MISSING = -1


def firm_words(c) -> Column:
    """Sorted distinct words of a firm's name without legal form, owner and ornaments."""
    t = skeleton(restore_udf(c))
    t = F.regexp_replace(t, r"\binh\b.*$|[-–]\s*ihr meisterbetrieb\s*$|\.\.\.$|…$", " ")
    return F.array_sort(F.array_distinct(F.filter(tokens(t), lambda w: ~w.isin(*FIRM_NOISE) & (F.length(w) > 1))))


def firm_level(a: str, b: str) -> Column:
    """3: nearly the same words, 2: most of them, 1: some, 0: none; MISSING without words."""
    common = F.size(F.array_intersect(a, b))
    least = F.least(F.size(a), F.size(b))
    sa, sb = F.array_join(a, " "), F.array_join(b, " ")
    near = 1 - F.levenshtein(sa, sb) / F.greatest(F.length(sa), F.length(sb))
    share = F.greatest(near, common / F.greatest(F.size(a), F.size(b)))
    return (
        F.when(least == 0, MISSING)
        .when((share >= 0.8) | (common == least) & (least >= 2), 3)
        .when((share >= 0.6) | (common >= 2), 2)
        .when((common >= 1) | (near >= 0.5), 1)
        .otherwise(0)
    )


def fit_levels(patterns: list[tuple[tuple[int, ...], int]], start: list[dict[int, float]], rounds: int = 100) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """EM over counts of level patterns: (share of matches, per attribute level -> (m, u)).

    ``start`` holds a first guess of P(level | match) relative to
    P(level | non-match) per attribute. A missing level counts as no evidence.
    """
    k = len(start)
    prob = [{lv: (max(r, 1e-6) / (1 + r), 1 / (1 + r)) for lv, r in s.items()} for s in start]
    for j in range(k):
        for side in (0, 1):
            total = sum(p[side] for p in prob[j].values())
            prob[j] = {lv: tuple(p[i] / total if i == side else p[i] for i in (0, 1)) for lv, p in prob[j].items()}
    share = 0.3
    for _ in range(rounds):
        num = [{lv: [0.01, 0.01] for lv in prob[j]} for j in range(k)]
        hit = total = 0.0
        for pattern, n in patterns:
            p = posterior(pattern, share, prob)
            hit, total = hit + p * n, total + n
            for j, lv in enumerate(pattern):
                if lv != MISSING:
                    num[j][lv][0] += p * n
                    num[j][lv][1] += (1 - p) * n
        share = min(0.99, max(1e-4, hit / total)) if total else share
        for j in range(k):
            a, b = (sum(v[i] for v in num[j].values()) for i in (0, 1))
            prob[j] = {lv: (v[0] / a, v[1] / b) for lv, v in num[j].items()}
    return share, prob


def posterior(pattern, share: float, prob) -> float:
    w = math.log(share / (1 - share))
    for j, lv in enumerate(pattern):
        if lv != MISSING:
            m, u = prob[j][lv]
            w += math.log(max(m, 1e-9) / max(u, 1e-9))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, w))))


#: First guess of the likelihood ratios; EM moves them to the data.
START = {
    "phone": {2: 500.0, 1: 100.0, 0: 0.1},
    "place": {2: 50.0, 1: 0.7, 0: 0.05},
    "firm": {3: 20.0, 2: 4.0, 1: 0.3, 0: 0.03},
    "web": {1: 30.0, 0: 0.2},
}


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Adds ``confidence`` to pairs that carry the level columns of ``START``."""
    names = list(START)
    counted = pairs.groupBy(*names).count().collect()  # bounded: the product of the levels
    patterns = [(tuple(int(r[n]) for n in names), int(r["count"])) for r in counted]
    share, prob = fit_levels(patterns, [START[n] for n in names])
    table = pairs.sparkSession.createDataFrame(
        [(*p, float(posterior(p, share, prob))) for p, _ in patterns], ", ".join(f"{n} int" for n in names) + ", confidence double"
    )
    return pairs.join(F.broadcast(table), names)

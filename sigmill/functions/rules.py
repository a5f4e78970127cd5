"""The rule language of codebooks: value -> score, each rule a column factory, plus the policies for missing values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import trim_all

#: A rule gives (score, whether the value can't be judged).
Rule = Callable[[Column, dict], tuple[Column, Column]]


def _text(v: Column) -> Column:
    return v.cast("string")


def bool_rule(v: Column, r: dict):
    yes, no = r.get("trueScore", 100.0), r.get("falseScore", 0.0)
    t = _text(v)
    score = F.when(t.isin("true", "1", "1.0"), float(yes)).when(t.isin("false", "0", "0.0"), float(no))
    return score, v.isNotNull() & score.isNull()


def presence_rule(v: Column, r: dict):
    there = F.length(F.regexp_replace(F.coalesce(_text(v), F.lit("")), r"^[\s ]+|[\s ]+$", "")) > 0
    return F.when(there, float(r.get("presentScore", 100.0))).otherwise(float(r.get("absentScore", 0.0))), F.lit(False)


def _clamp(v: Column, r: dict, first: float, last: float):
    lo, hi = float(r["min"]), float(r["max"])
    if hi <= lo:
        raise ValueError("max must exceed min")
    a, b = float(r.get("scoreAtMin", first)), float(r.get("scoreAtMax", last))
    x = v.try_cast("double")
    bad = v.isNotNull() & (x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    at = (F.least(F.greatest(x, F.lit(lo)), F.lit(hi)) - lo) / (hi - lo)
    return F.when(~bad, a + at * (b - a)), bad


def count_clamp(v: Column, r: dict):
    return _clamp(v, r, 0.0, 100.0)


def count_clamp_inverse(v: Column, r: dict):
    return _clamp(v, r, 100.0, 0.0)


def enum_rule(v: Column, r: dict):
    score = F.lit(float(r.get("defaultScore", 0.0)))
    t = _text(v)
    out = None
    for k, s in r["cases"].items():
        out = F.when(t == str(k), float(s)) if out is None else out.when(t == str(k), float(s))
    return (out.otherwise(score) if out is not None else score), F.lit(False)


#: Name -> rule; new rules are registered here.
RULES: dict[str, Rule] = {"bool": bool_rule, "presence": presence_rule, "countClamp": count_clamp, "countClampInverse": count_clamp_inverse, "enum": enum_rule}


def is_missing(v: Column, rule: str) -> Column:
    """Null or blank; never for presence, which judges blanks itself."""
    return F.lit(False) if rule == "presence" else v.isNull() | (trim_all(_text(v)) == "")


def missing_policy(policy: dict, status: Column) -> tuple[Column, Column, Column]:
    """(score, confidence, share of the weight that counts) for a missing value.

    zero: 0, 1, 1; skip and exclude: none, 0, 0; impute: x, 0.5, 1;
    conditional: by collection status, "absent" without one, else the default.
    """
    kind = policy.get("kind", "zero")
    if kind == "conditional":
        states, default = policy.get("states", {}), policy.get("default", "zero")
        s = F.coalesce(status, F.lit("absent"))
        zero = F.lit(default == "zero")
        for k, what in states.items():
            zero = F.when(s == k, F.lit(what == "zero")).otherwise(zero)
        return F.when(zero, 0.0), F.when(zero, 1.0).otherwise(0.0), F.when(zero, 1.0).otherwise(0.0)
    if kind == "zero":
        return F.lit(0.0), F.lit(1.0), F.lit(1.0)
    if kind == "impute":
        return F.lit(float(policy["imputedScore"])), F.lit(0.5), F.lit(1.0)
    return F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0)

"""Scoring of entities by a declarative codebook, compiled to column expressions (no shuffle, no UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.num import js_round
from ..functions.rules import RULES, is_missing, missing_policy


def check_codebook(book: dict) -> list[str]:
    """Problems of a codebook: version form, doubled ids, unknown rules, empty ranges, weights that aren't positive."""
    out = []
    if not re.fullmatch(r"\d+\.\d+\.\d+", str(book.get("version", ""))):
        out.append("version must read MAJOR.MINOR.PATCH")
    dims = [d["id"] for d in book["dimensions"]]
    out += [f"dimension {d} occurs twice" for d in sorted({d for d in dims if dims.count(d) > 1})]
    for d in book["dimensions"]:
        ids = [i["id"] for i in d["indicators"]]
        out += [f"indicator {d['id']}/{i} occurs twice" for i in sorted({i for i in ids if ids.count(i) > 1})]
        if not d["indicators"]:
            out.append(f"dimension {d['id']} has no indicators")
        for i in d["indicators"]:
            r = i["rule"]
            if r["type"] not in RULES:
                out.append(f"unknown rule {r['type']}")
            if "min" in r and r["max"] <= r["min"]:
                out.append(f"{d['id']}/{i['id']}: max must exceed min")
            if i["weight"] <= 0:
                out.append(f"{d['id']}/{i['id']}: weight must be positive")
    return out


def same_major(a: str, b: str) -> bool:
    """Two versions are compatible if their first numbers agree."""
    return a.split(".")[0] == b.split(".")[0]


def _judged(ind: dict, df: DataFrame, status: str | None) -> tuple[Column, Column, Column, Column]:
    """(score, confidence, counted weight, note) of one indicator."""
    key = ind["inputKey"]
    v = F.col(f"`{key}`") if key in df.columns else F.lit(None).cast("string")
    st = F.col(status)[key] if status else F.lit(None).cast("string")
    score, bad = RULES[ind["rule"]["type"]](v, ind["rule"])
    gone = is_missing(v, ind["rule"]["type"])
    ms, mc, mw = missing_policy(ind.get("missing", {"kind": "zero"}), st)
    w = float(ind["weight"])
    return (
        F.when(gone, ms).when(~bad, score).cast("double"),
        F.when(gone, mc).when(bad, 0.0).otherwise(1.0).cast("double"),
        F.when(gone, mw * w).when(bad, 0.0).otherwise(w).cast("double"),
        F.when(gone, F.concat(F.lit("missing: "), F.lit(ind.get("missing", {}).get("kind", "zero")))).when(bad, F.lit("rule error")),
    )


def traces(df: DataFrame, book: dict, entity: str, keep: tuple[str, ...] = (), status: str | None = None) -> DataFrame:
    """One row per entity and indicator: raw value, rule, score, counted weight, confidence, note."""
    # Judged in one projection, gathered in the next: generated code stays small.
    judged = []
    for d in book["dimensions"]:
        for i in d["indicators"]:
            s, c, w, n = _judged(i, df, status)
            raw = F.col(f"`{i['inputKey']}`").cast("string") if i["inputKey"] in df.columns else F.lit(None).cast("string")
            judged.append(F.struct(F.lit(d["id"]).alias("dimension"), F.lit(i["id"]).alias("indicator"), raw.alias("raw"), F.lit(i["rule"]["type"]).alias("rule"), s.alias("score"), w.alias("weight"), c.alias("confidence"), n.alias("note")).alias(f"_j{len(judged)}"))
    wide = df.select(entity, *keep, *judged)
    return wide.select(entity, *keep, F.explode(F.array(*[f"_j{k}" for k in range(len(judged))])).alias("t")).select(entity, *keep, "t.*")


def scores(df: DataFrame, book: dict, entity: str, keep: tuple[str, ...] = (), status: str | None = None) -> DataFrame:
    """Wide scores: per entity a struct for each dimension, the overall score and its confidence, in one projection.

    A dimension's score is the weighted mean of the indicators that count; its
    effective weight is its weight times the counted share; the overall uses
    unrounded scores and weights but rounded confidences. Entities without any
    scored dimension get null.
    """
    # Three projections, each naming what the next uses more than once: code stays linear in the indicators.
    names = {(d["id"], i["id"]): f"_j{k}" for k, (d, i) in enumerate((d, i) for d in book["dimensions"] for i in d["indicators"])}
    judged = []
    for d in book["dimensions"]:
        for i in d["indicators"]:
            s, c, w, _ = _judged(i, df, status)
            judged.append(F.struct(F.coalesce(s, F.lit(0.0)).alias("s"), c.alias("c"), w.alias("w")).alias(names[d["id"], i["id"]]))
    out = df.select(entity, *keep, *judged)
    parts, dims = [], []
    for d in book["dimensions"]:
        js = [F.col(names[d["id"], i["id"]]) for i in d["indicators"]]
        w = sum((j["w"] for j in js[1:]), js[0]["w"])
        ws = sum((j["s"] * j["w"] for j in js[1:]), js[0]["s"] * js[0]["w"])
        wc = sum((j["c"] * j["w"] for j in js[1:]), js[0]["c"] * js[0]["w"])
        name = d["id"]
        dims += [w.alias(f"_{name}_w"), F.when(w > 0, ws / w).alias(f"_{name}_s"), F.when(w > 0, js_round(wc / w)).otherwise(0.0).alias(f"_{name}_c")]
        parts.append((name, float(d["weight"]), sum(float(i["weight"]) for i in d["indicators"])))
    out = out.select(entity, *keep, *dims)
    eff = {n: F.col(f"_{n}_w") / declared * weight for n, weight, declared in parts}
    there = {n: F.col(f"_{n}_s").isNotNull() for n, _, _ in parts}
    zero = F.lit(0.0)
    total = sum((F.when(there[n], eff[n]).otherwise(zero) for n in eff), zero)
    overall = sum((F.when(there[n], F.col(f"_{n}_s") * eff[n]).otherwise(zero) for n in eff), zero)
    conf = sum((F.when(there[n], F.col(f"_{n}_c") * eff[n]).otherwise(zero) for n in eff), zero)
    cols = [F.struct(js_round(F.col(f"_{n}_s")).alias("score"), js_round(eff[n], 3).alias("effective_weight"), F.col(f"_{n}_c").alias("confidence")).alias(n) for n, _, _ in parts]
    out = out.select(entity, *keep, *cols, total.alias("_t"), overall.alias("_o"), conf.alias("_k"))
    ok = F.col("_t") > 0
    return out.select(entity, *keep, *[d["id"] for d in book["dimensions"]], F.when(ok, js_round(F.col("_o") / F.col("_t"))).alias("overall"), F.when(ok, js_round(F.col("_k") / F.col("_t"))).alias("confidence"))


def dimensions(wide: DataFrame, book: dict, entity: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Long form of the dimension structs."""
    rows = F.array(*[F.struct(F.lit(d["id"]).alias("dimension"), F.col(d["id"])["score"].alias("score"), F.col(d["id"])["effective_weight"].alias("effective_weight"), F.col(d["id"])["confidence"].alias("confidence")) for d in book["dimensions"]])
    return wide.select(entity, *keep, F.explode(rows).alias("d")).select(entity, *keep, "d.*")

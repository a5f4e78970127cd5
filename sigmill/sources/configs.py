"""Codebooks, ontologies and briefs from files, discovery of stored periods, and small reports as text."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.codebook import check_codebook


def load_document(path: str) -> dict:
    """A YAML or JSON file; YAML needs PyYAML."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML files need PyYAML; give the codebook as JSON") from e
    return yaml.safe_load(text)


def load_codebook(path: str) -> dict:
    """A checked codebook; raises with all its problems at once."""
    book = load_document(path)
    if problems := check_codebook(book):
        raise ValueError("; ".join(problems))
    return book


def load_ontology(spark: SparkSession, path: str) -> DataFrame:
    """(signal_path, value_type, deprecated) of an ontology file, for joins with the observation log."""
    rows = [(s["signal_path"], s["value_type"], s.get("deprecated_in") is not None) for s in load_document(path)["signals"]]
    return spark.createDataFrame(rows, "signal_path string, value_type string, deprecated boolean")


def book_against_ontology(book: dict, ontology: DataFrame) -> tuple[list[str], list[str]]:
    """(unknown, deprecated) input keys of a codebook; at most as many as it has indicators."""
    keys = sorted({i["inputKey"] for d in book["dimensions"] for i in d["indicators"]})
    used = ontology.sparkSession.createDataFrame([(k,) for k in keys], "signal_path string")
    found = {r["signal_path"]: r["deprecated"] for r in used.join(ontology, "signal_path").collect()}
    return [k for k in keys if k not in found], [k for k in keys if found.get(k)]


def merge_brief(root: str, local: str) -> dict[str, str]:
    """Front matter (key: value between two lines of dashes) of two briefs; the local one wins."""
    out: dict[str, str] = {}
    for text in (root, local):
        m = re.match(r"---\s*\n(.*?)\n---\s*(?:\n|$)", text, re.S)
        for line in (m[1] if m else "").splitlines():
            if k := re.match(r"\s*([\w.-]+)\s*:\s*(.*?)\s*$", line):
                out[k[1]] = k[2].strip("\"'")
    return out


def stored_periods(paths: DataFrame, column: str = "path") -> DataFrame:
    """(path, kind, year, half) of databases named kind_YYYY or kind_YYYYh1/h2."""
    name = F.regexp_extract(column, r"([a-z]+)_(\d{4})(?:-?(h[12]))?(?:\.\w+)?$", 1)
    return paths.select(
        F.col(column).alias("path"), name.alias("kind"), F.regexp_extract(column, r"_(\d{4})(?:-?h[12])?(?:\.\w+)?$", 1).try_cast("int").alias("year"),
        F.nullif(F.regexp_extract(column, r"_\d{4}-?(h[12])(?:\.\w+)?$", 1), F.lit("")).alias("half"),
    ).where(name != "")


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A small result as a Markdown table; raises above ``most`` rows instead of cutting."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    cell = lambda v: "–" if v is None else str(v).replace("|", "\\|")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)] + ["| " + " | ".join(map(cell, r)) + " |" for r in rows])

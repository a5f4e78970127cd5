"""Catalogue files, exchange bundles, SQLite files and content-addressed stores as sources and sinks."""

from __future__ import annotations

import hashlib
import json
import sqlite3
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import blank_to_null

#: Ends and parts of paths of a crawl that hold no listing.
NOISE_ENDS = ("favicon.ico.html", "/favicon.ico", "robots.txt.html", "/robots.txt", ".png.html", ".jpg.html", ".gif.html", ".css.html", ".js.html")
NOISE_PARTS = ("/infos/tag/", "/tags/", "/search/", "/suche/", "/handwerkernet.de/php/")


def is_noise(path) -> Column:
    """A file of a crawl that holds no listing, by its path; case and the kind of slash don't matter."""
    p = F.lower(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("\\"), F.lit("/")))
    hit = F.lit(False)
    for e in NOISE_ENDS:
        hit = hit | p.endswith(e)
    for e in NOISE_PARTS:
        hit = hit | p.contains(e)
    return hit


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, length, modificationTime) of all files below a folder that aren't noise, without their content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).drop("content").where(~is_noise("path"))


#: Where Windows-1252 differs from ISO-8859-1: the latter's controls and the signs that are meant.
C1 = "".join(chr(b) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore"))
CP1252 = "".join(bytes([ord(c)]).decode("cp1252") for c in C1)


def decode_html(content: Column) -> Column:
    """Text of raw bytes by the charset the page names (ISO-8859-1 is read as Windows-1252), else UTF-8."""
    head = F.lower(F.decode(F.substring(content, 1, 2048), "ISO-8859-1"))
    named = F.regexp_extract(head, r"charset\s*=\s*[\"']?\s*([a-z0-9_-]+)", 1)
    return F.when(named.isin("iso-8859-1", "latin1", "windows-1252", "cp1252"), F.translate(F.decode(content, "ISO-8859-1"), C1, CP1252)).otherwise(F.decode(content, "UTF-8"))


def read_catalog_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Catalogue rows: trimmed, blanks as null, a header garbled after "Stra" repaired, missing columns as null."""
    df = spark.read.csv(path, header=True, multiLine=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, enforceSchema=False)
    df = df.toDF(*["Straße" if c.strip().startswith("Stra") else c.strip().lstrip("﻿") for c in df.columns])
    return df.select(*[(blank_to_null(F.col(f"`{c}`")) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns])


def read_sqlite(spark: SparkSession, path: str, sql: str, schema: str, slices: list[str] | None = None) -> DataFrame:
    """Rows of a SQLite file that all workers can read; ``slices`` are predicates read in parallel."""
    parts = spark.createDataFrame([(s,) for s in (slices or ["1=1"])], "p string").repartition(max(1, len(slices or [1])))
    names = [f.name for f in spark.createDataFrame([], schema).schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for where in pdf["p"]:
                con = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
                try:
                    cur = con.execute(f"SELECT * FROM ({sql}) WHERE {where}")
                    while rows := cur.fetchmany(10_000):
                        yield pd.DataFrame(rows, columns=names)
                finally:
                    con.close()

    return parts.mapInPandas(run, schema)


#: Longest file that Spark reads as one binary value.
BINARY_MAX = (1 << 31) - 1


def content_sha256(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file, taken by a worker; one too long for a single value is streamed through the driver's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).getLen() < BINARY_MAX:
        return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
    h, stream = hashlib.sha256(), fs.open(p)
    try:
        while block := bytes(stream.readNBytes(1 << 20)):
            h.update(block)
    finally:
        stream.close()
    return h.hexdigest()


def write_bundle(df: DataFrame, folder: str, order: list[str], meta: dict) -> dict:
    """One NDJSON file in a fixed order and, last, the manifest with count and hash that makes the bundle valid.

    An exchange bundle is one file by its format; use ``write_vault`` for large data.
    """
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    h, n = hashlib.sha256(), 0
    with open(out / "observations.ndjson", "wb") as f:
        for r in df.orderBy(*order).select(F.to_json(F.struct(*df.columns)).alias("j")).toLocalIterator():
            line = (r["j"] + "\n").encode()
            f.write(line)
            h.update(line)
            n += 1
    manifest = meta | {"schema_version": "2", "format": "ndjson-v1", "observation_count": n, "bundle_hash": h.hexdigest()}
    (out / "manifest.json").write_text(json.dumps(manifest, indent=2, sort_keys=True))
    return manifest


def read_bundle(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of a bundle; raises if version, format, hash or count don't agree with the manifest (a null hash isn't checked)."""
    m = json.loads(spark.read.text(f"{folder}/manifest.json", wholetext=True).first()[0])
    if str(m.get("schema_version")) not in ("1", "2") or m.get("format") != "ndjson-v1":
        raise ValueError(f"unknown bundle form: {m.get('schema_version')}, {m.get('format')}")
    path = f"{folder}/observations.ndjson"
    df = spark.read.schema(schema).json(path)
    if not m["observation_count"]:
        return df.limit(0)
    if m.get("bundle_hash") and content_sha256(spark, path) != m["bundle_hash"]:
        raise ValueError("the bundle's hash differs from its manifest")
    if df.count() != m["observation_count"]:
        raise ValueError("the bundle's count differs from its manifest")
    return df


def write_vault(df: DataFrame, base: str, year: str, run: str, run_id: str) -> bool:
    """One partition year=/run_id= of a Parquet vault; False if that run is there already."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{year}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    hits = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/year=*/run_id={run_id}"))
    if hits is not None and len(hits):
        return False
    df.where(F.col(run) == run_id).withColumn("year", F.col(year)).withColumn("run_id", F.col(run)).write.partitionBy("year", "run_id").option("compression", "zstd").mode("append").parquet(base)
    return True


def new_blobs(df: DataFrame, content: str, stored: DataFrame | None) -> DataFrame:
    """(sha256, prefix, content) of contents that the store lacks, each once."""
    out = df.where(F.col(content).isNotNull()).select(F.sha2(content, 256).alias("sha256"), F.col(content).alias("content")).dropDuplicates(["sha256"])
    out = out.join(stored.select("sha256"), "sha256", "left_anti") if stored is not None else out
    return out.select("sha256", F.substring("sha256", 1, 2).alias("prefix"), "content")


def write_csv(df: DataFrame, path: str, names: dict[str, str] | None = None) -> None:
    """One CSV with a header, columns renamed."""
    df.select(*[F.col(c).alias((names or {}).get(c, c)) for c in df.columns]).coalesce(1).write.mode("overwrite").csv(path, header=True)

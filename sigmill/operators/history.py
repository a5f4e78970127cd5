"""Versioned history of entity attributes from snapshots (slowly changing, type 2).

The rows of all snapshots are range-partitioned by (entity, time) and sorted
inside each partition, which is the k-way merge of the sorted runs of all
snapshots. One streaming pass per partition then closes a version whenever the
payload changes. Only one open version and one undecided row are held at a
time, never a whole history. Ranges also cut within one entity, so an entity
that holds a third of all rows is spread over many tasks; versions cut at a
range border are joined again by their first and last versions only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, ship

NULL_MARK = "\u0000"


def payload_key(*cols) -> F.Column:
    """One string per payload; null differs from every string and fields can't run into each other."""
    return F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in cols])


NO_TIME = np.iinfo(np.int64).min
VERSION = "entity string, start timestamp_ntz, end timestamp_ntz, is_last boolean, payload string, last_to timestamp_ntz, head boolean, tail boolean, pid int"


def _micros(column: pa.Array) -> np.ndarray:
    return np.asarray(column.cast(pa.timestamp("us")).view(pa.int64()).fill_null(NO_TIME))


def _times(micros: np.ndarray) -> pa.Array:
    return pa.array(micros, mask=micros == NO_TIME).view(pa.timestamp("us"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Versions of the sorted states of one range. Holds the open version and the newest undecided row."""
    fields = ("entity", "start", "last_to", "payload")
    open_version = undecided = None
    head, pid = True, 0

    def emit(v: dict[str, np.ndarray], closed: bool) -> pa.RecordBatch:
        """All versions but the last, which stays open, or with ``closed`` the last too."""
        nonlocal head
        n = len(v["entity"]) - (not closed)
        follows = np.zeros(n, bool)
        k = len(v["entity"]) - 1
        follows[:k] = v["entity"][1:] == v["entity"][:-1]
        end = v["last_to"][:n].copy()
        end[:k][follows[:k]] = v["start"][1:][follows[:k]]
        heads, tails = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            heads[0], head = head, False
            tails[-1] = closed
        return pa.RecordBatch.from_arrays(
            [
                pa.array(v["entity"][:n], pa.string()), _times(v["start"][:n]), _times(end), pa.array(~follows), pa.array(v["payload"][:n], pa.string()), _times(v["last_to"][:n]),
                pa.array(heads), pa.array(tails), pa.array(np.full(n, pid, np.int32)),
            ],
            names=[f.split(" ")[0] for f in VERSION.split(", ")],
        )

    def versions(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Runs of equal payload: the first row's start, the last row's ``last_to``."""
        change = np.ones(len(rows["entity"]), bool)
        change[1:] = (rows["entity"][1:] != rows["entity"][:-1]) | (rows["payload"][1:] != rows["payload"][:-1])
        first = np.flatnonzero(change)
        out = {f: rows[f][first] for f in fields}
        out["last_to"] = rows["last_to"][np.append(first[1:], len(change)) - 1]
        return out

    def join(a: dict | None, b: dict) -> dict:
        return b if a is None else {f: np.concatenate([a[f], b[f]]) for f in fields}

    for b in batches:
        if not b.num_rows:
            continue
        column = lambda f: b.column(b.schema.get_field_index(f))
        pid = column("pid")[0].as_py()
        rows = {f: _micros(column(f)) if f in ("start", "last_to") else column(f).to_numpy(zero_copy_only=False) for f in fields}
        rows = join(undecided, rows)
        told = np.zeros(len(rows["entity"]), bool)
        told[:-1] = (rows["entity"][:-1] != rows["entity"][1:]) | (rows["start"][:-1] != rows["start"][1:])
        undecided = {f: rows[f][-1:] for f in fields}
        if told.any():
            v = versions(join(open_version, {f: rows[f][told] for f in fields}))
            yield emit(v, False)
            open_version = {f: v[f][-1:] for f in fields}
    if undecided is not None:
        yield emit(versions(join(open_version, undecided)), True)


def _mend_borders(local: DataFrame) -> DataFrame:
    """(entity, start, end, is_last, payload): versions of single ranges joined where a range ended inside an entity.

    Only the first and the last version of every range take part, so the one
    unpartitioned window holds two rows per range, whatever the sizes.
    """
    w = Window.orderBy("pid", "tail")
    before = lambda c: F.lag(c).over(w)
    edge = local.where("head or tail").withColumn("goes_on", F.col("head") & F.coalesce((before("entity") == F.col("entity")) & (before("payload") == F.col("payload")), F.lit(False)))
    edge = edge.withColumn("run", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct("pid", "tail")
    runs = edge.groupBy("run").agg(F.min_by(F.struct("entity", "start", "payload"), at).alias("a"), F.max_by(F.struct("end", "is_last", "tail", "last_to"), at).alias("z"))
    order = Window.orderBy("run")
    nxt = F.lead("a").over(order)
    same = F.coalesce(nxt["entity"] == F.col("a.entity"), F.lit(False))
    mended = runs.select(
        "a.entity", "a.start", F.when(~F.col("z.tail"), F.col("z.end")).when(same, nxt["start"]).otherwise(F.col("z.last_to")).alias("end"),
        F.when(~F.col("z.tail"), F.col("z.is_last")).otherwise(~same).alias("is_last"), "a.payload",
    )
    return local.where("not head and not tail").select("entity", "start", "end", "is_last", "payload").unionByName(mended)


def version_history(states: DataFrame, entity: str, valid_from: str, valid_to: str, recorded_at: str, payload: list) -> DataFrame:
    """One row per version: entity, start, end (null: open), is_last, payload.

    ``start``/``end`` bound the version half-open; for the last version
    ``end`` is what the entity's last state itself tells (may be null).
    Of several rows with one (entity, valid_from) the latest ``recorded_at``
    tells the state; exact ties are resolved by the greatest ``valid_to`` and
    payload, so the result doesn't depend on row order. Rows with a null
    entity or valid_from tell nothing and are left out; a null payload field
    is a value of its own. An empty table gives an empty result; further
    columns of the input are ignored.
    """
    ship(states.sparkSession)
    rows = states.where(F.col(entity).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(entity).cast("string").alias("entity"),
        F.col(valid_from).cast("timestamp_ntz").alias("start"),
        F.col(valid_to).cast("timestamp_ntz").alias("last_to"),
        F.col(recorded_at).cast("timestamp_ntz").alias("seen"),
        payload_key(*payload).alias("payload"),
    )
    ordered = rows.repartitionByRange("entity", "start").sortWithinPartitions(
        "entity", "start", F.col("seen").asc_nulls_first(), F.col("last_to").asc_nulls_first(), "payload"
    )
    local = cut(ordered.drop("seen").withColumn("pid", F.spark_partition_id()).mapInArrow(_merge, VERSION))
    return _mend_borders(local)


def state_codes(zipcodes: DataFrame) -> DataFrame:
    """(spelling, code): every folded spelling of a federal state that ``zipcodes`` gives, at most 2 rows a state."""
    pairs = zipcodes.where("state_code is not null").select("state_code", "state").distinct()
    both = pairs.select(fold_label("state_code").alias("spelling"), "state_code").unionByName(
        pairs.select(fold_label("state").alias("spelling"), "state_code")
    )
    return both.groupBy("spelling").agg(F.min("state_code").alias("code"))


def fold_label(c) -> F.Column:
    """Letters and digits only, lower case, umlauts as two letters: spellings of one label become equal."""
    c = F.lower(F.col(c) if isinstance(c, str) else c)
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(c, r"^\s*de\s*[-_]\s*", ""), r"[^\p{L}\p{N}]", "")

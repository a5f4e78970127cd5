"""Percentiles of very large columns by mergeable rank-interval summaries.

A summary holds sorted values with the least and greatest rank each may have
among all values seen. Chunks are summarised exactly where they are read,
compressed as far as the permitted uncertainty allows, and merged level by
level; ranks add up exactly, so the error of a merged summary is read off its
own intervals. Everything is deterministic.

Summaries travel as Arrow lists and are built for all groups of a batch at
once, so that many small parts (groups by days) cost no more than few large
ones. A summary in which every value is kept carries no ranks; they are its
positions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Values that a task buffers before it summarises or merges them.
CHUNK = 1_000_000
#: Summaries merged in one call: bounds what a task holds.
FAN_IN = 64
SCHEMA = "group string, part string, n long, v array<double>, lo array<long>, hi array<long>"

Summary = tuple[np.ndarray, np.ndarray, np.ndarray]


def exact(values: np.ndarray) -> Summary:
    v = np.sort(values)
    r = np.arange(1, len(v) + 1, dtype=np.int64)
    return v, r, r.copy()


def is_exact(s: Summary) -> bool:
    return not len(s[0]) or s[2][-1] == len(s[0]) and bool((s[1] == s[2]).all())


def merge(a: Summary, b: Summary) -> Summary:
    """Summary of the union; rank intervals add up."""
    (av, al, ah), (bv, bl, bh) = a, b
    if not len(av) or not len(bv):
        return b if not len(av) else a

    def shift(x, y, yl, yh, side):
        i = np.searchsorted(y, x, side=side)
        return np.where(i > 0, yl[np.maximum(i - 1, 0)], 0), np.where(i < len(y), yh[np.minimum(i, len(y) - 1)] - 1, yh[-1])

    # Of equal values those of a count as smaller, so that each pair is ordered once.
    a_lo, a_hi = shift(av, bv, bl, bh, "left")
    b_lo, b_hi = shift(bv, av, al, ah, "right")
    v = np.concatenate([av, bv])
    order = np.argsort(v, kind="stable")
    lo, hi = np.concatenate([al + a_lo, bl + b_lo])[order], np.concatenate([ah + a_hi, bh + b_hi])[order]
    # Ranks rise along the values, which can only narrow the intervals.
    return v[order], np.maximum.accumulate(lo), np.minimum.accumulate(hi[::-1])[::-1]


def merge_all(rows: list[tuple[int, Summary]]) -> tuple[int, Summary]:
    """(n, summary) of the union: exact ones are sorted together, the others merged in pairs."""
    sure = [s[0] for _, s in rows if is_exact(s)]
    rest = sorted(((n, s) for n, s in rows if not is_exact(s)), key=lambda r: (r[0], r[1][0].tobytes()))
    if sure:
        v = np.concatenate(sure)
        rest.append((len(v), exact(v)))
    while len(rest) > 1:
        rest = [(rest[i][0] + rest[i + 1][0], merge(rest[i][1], rest[i + 1][1])) if i + 1 < len(rest) else rest[i] for i in range(0, len(rest), 2)]
    return rest[0]


def compress(s: Summary, n: int, eps: float) -> Summary:
    """Keep as few tuples as leave gaps of at most 2*eps*n ranks between neighbours; ends stay."""
    v, lo, hi = s
    room = 2 * eps * n
    if len(v) < 3 or room < 2:
        return s
    keep, last, end = [0], 0, len(v) - 1
    while last < end:
        last = min(end, max(last + 1, int(np.searchsorted(hi, lo[last] + room, side="right")) - 1))
        keep.append(last)
    k = np.array(keep)
    return v[k], lo[k], hi[k]


def value_at(s: Summary, n: int, p: float) -> tuple[float, int]:
    """(value, bound of its rank error) for the rank ceil(p * n), at least 1."""
    v, lo, hi = s
    r = min(n, max(1, math.ceil(p * n - 1e-9)))
    worst = np.maximum(r - lo, hi - r)
    i = int(np.argmin(worst))
    return float(v[i]), max(0, int(worst[i]))


def _lists(parts: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    """A list column; None is null."""
    lens = np.array([0 if x is None else len(x) for x in parts], np.int64)
    offsets = np.r_[0, np.cumsum(lens)].astype(np.int32)
    flat = [x for x in parts if x is not None and len(x)]
    values = pa.array(np.concatenate(flat) if flat else np.zeros(0), kind)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([x is None for x in parts]))


def _batch(rows: list[tuple[str, str, int, Summary]]) -> pa.RecordBatch:
    """Rows (group, part, n, summary) as one Arrow batch; exact summaries without ranks."""
    sure = [is_exact(s) for *_, s in rows]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64()),
            _lists([r[3][0] for r in rows], pa.float64()),
            _lists([None if e else r[3][1] for e, r in zip(sure, rows)], pa.int64()), _lists([None if e else r[3][2] for e, r in zip(sure, rows)], pa.int64()),
        ],
        names=SCHEMA_COLUMNS,
    )


def _packed(keys: list[tuple[str, str]], codes: np.ndarray, values: np.ndarray, eps: float, rest: dict[int, list] | None = None) -> pa.RecordBatch:
    """One summary per key: all values sorted together by key and value, ``rest`` gives summaries to be merged in.

    Only keys of 1/eps values or more are looked at one by one.
    """
    order = np.lexsort((values, codes))
    codes, values = codes[order], values[order]
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    end, mine = np.r_[at[1:], len(codes)].astype(np.int64) if len(codes) else at, codes[at]
    rest = rest or {}
    alone = (end - at) * 2 * eps < 2
    if rest:
        alone &= ~np.isin(mine, list(rest))
    # Exact summaries need no ranks and go out as they stand.
    keep = np.repeat(alone, end - at) if len(at) else np.zeros(0, bool)
    lens = (end - at)[alone]
    offsets = np.r_[0, np.cumsum(lens)].astype(np.int32)
    nulls = pa.ListArray.from_arrays(pa.array(np.zeros(len(lens) + 1, np.int32)), pa.array([], pa.int64()), mask=pa.array(np.ones(len(lens), bool)))
    small = pa.RecordBatch.from_arrays(
        [
            pa.array([keys[c][0] for c in mine[alone]], pa.string()), pa.array([keys[c][1] for c in mine[alone]], pa.string()), pa.array(lens, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[keep])), nulls, nulls,
        ],
        names=SCHEMA_COLUMNS,
    )
    large = {int(c): [(int(j - i), exact(values[i:j]))] for c, i, j in zip(mine[~alone], at[~alone], end[~alone])}
    for c, got in rest.items():
        large.setdefault(c, []).extend(got)
    if not large:
        return small
    rows = []
    for c, got in sorted(large.items()):
        n, s = merge_all(got)
        rows.append((*keys[c], n, compress(s, n, eps)))
    both = pa.Table.from_batches([small, _batch(rows)]).combine_chunks()
    return both.to_batches()[0]


def summaries(values: DataFrame, eps: float = 1e-4) -> DataFrame:
    """Summaries of (group, part, value): one or a few rows per group and part from every task.

    Null and NaN values are left out, as are null groups; a null part is a
    part of its own. ``eps`` bounds the rank error that compression adds to a
    summary, as a share of its size; summaries under 1/eps values stay exact.
    """
    ship(values.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[tuple[str, str], int] = {}
        codes, held, size = [], [], 0
        for b in batches:
            g, p = b.column(0).dictionary_encode(), b.column(1).dictionary_encode()
            pair = np.asarray(g.indices).astype(np.int64) * max(1, len(p.dictionary)) + np.asarray(p.indices)
            seen, local = np.unique(pair, return_inverse=True)
            gs, ps = g.dictionary.to_pylist(), p.dictionary.to_pylist()
            names = [(gs[x // max(1, len(ps))], ps[x % max(1, len(ps))]) for x in seen]
            codes.append(np.array([number.setdefault(k, len(number)) for k in names], np.int64)[local])
            held.append(np.asarray(b.column(2)))
            size += b.num_rows
            if size >= CHUNK:
                yield _packed(list(number), np.concatenate(codes), np.concatenate(held), eps)
                number, codes, held, size = {}, [], [], 0
        if size:
            yield _packed(list(number), np.concatenate(codes), np.concatenate(held), eps)

    clean = values.where("group is not null and value is not null and not isnan(value)").select(F.col("group").cast("string").alias("group"), F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), F.col("value").cast("double").alias("value"))
    return clean.mapInArrow(run, SCHEMA)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[str, str, int, Summary]]:
    v, lo, hi = (batch.column(batch.schema.get_field_index(c)) for c in ("v", "lo", "hi"))
    at, flat = np.asarray(v.offsets), np.asarray(v.values)
    at_r, low, high = np.asarray(lo.offsets), np.asarray(lo.values), np.asarray(hi.values)
    sure = np.asarray(lo.is_null())
    for k, (g, p, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())):
        x = flat[at[k] : at[k + 1]]
        r = None if sure[k] else slice(at_r[k], at_r[k + 1])
        yield g, p, n, (x, None, None) if r is None else (x, low[r], high[r])


def merged(parts: DataFrame, eps: float = 1e-4, by_part: bool = False) -> DataFrame:
    """One summary per group (or per group and part) by a tree of merges of about ``FAN_IN`` at a time.

    ``parts`` is read twice (once to count), so it should be stored. A group's
    summaries are dealt to buckets by a hash, so a hot group is spread over
    tasks until its last merge, which sees at most ``FAN_IN`` compressed ones.
    """
    ship(parts.sparkSession)
    keys = ["group", "part"] if by_part else ["group"]
    most = parts.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1
    steps = []
    while most > 1:
        most = math.ceil(most / FAN_IN)
        steps.append(most)
    steps = steps or [1]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by key and bucket; finished keys wait until a chunk is full.
        names: list[tuple[str, str]] = []
        codes, held, rest, size, last = [], [], {}, 0, None
        for b in batches:
            buckets = b.column(b.schema.get_field_index("_bucket")).to_pylist()
            for (g, p, n, s), bucket in zip(_rows(b), buckets):
                key = (g, p if by_part else "", bucket)
                if key != last:
                    if size >= CHUNK:
                        yield _packed(names, np.concatenate([np.zeros(0, np.int64), *codes]), np.concatenate([np.zeros(0), *held]), eps / len(steps), rest)
                        names, codes, held, rest, size = [], [], [], {}, 0
                    names.append((g, p))
                    last = key
                size += len(s[0])
                if s[1] is None:
                    codes.append(np.full(len(s[0]), len(names) - 1, np.int64))
                    held.append(s[0])
                else:
                    rest.setdefault(len(names) - 1, []).append((n, s))
        if names:
            yield _packed(names, np.concatenate([np.zeros(0, np.int64), *codes]), np.concatenate([np.zeros(0), *held]), eps / len(steps), rest)

    out = parts
    for buckets in steps:  # each step leaves about 1/FAN_IN of the summaries
        slot = F.pmod(F.xxhash64("part", "n", F.element_at("v", 1), F.element_at("v", -1)), F.lit(buckets)) if buckets > 1 else F.lit(0).cast("long")
        dealt = out.select(*SCHEMA_COLUMNS, slot.alias("_bucket")).repartition(*keys, "_bucket")
        out = dealt.sortWithinPartitions(*keys, "_bucket", "part", "n").mapInArrow(fold, SCHEMA)
    return out


SCHEMA_COLUMNS = ["group", "part", "n", "v", "lo", "hi"]


def percentiles(summary: DataFrame, at: list[float]) -> DataFrame:
    """(group, part, n, p, value, rank_error) of merged summaries; the error is a proven bound in ranks."""
    ship(summary.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for g, part, n, (v, lo, hi) in _rows(b):
                r = np.arange(1, len(v) + 1)
                s = (v, r, r) if lo is None else (v, lo, hi)
                rows += [(g, part, n, p, *value_at(s, n, p)) for p in at]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["group", "part", "n", "p", "value", "rank_error"]), preserve_index=False)

    return summary.select(*SCHEMA_COLUMNS).mapInArrow(run, "group string, part string, n long, p double, value double, rank_error long")

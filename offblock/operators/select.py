"""Exact order statistics without a global sort (used by R27 medians and R35 split).

``kth_smallest`` finds the k-th smallest value of numeric columns by histogram
refinement: each round is ONE aggregate over (target, bucket) -> (count, min,
max) with at most ``BUCKETS`` rows per target reaching the driver; the target
bucket's data min/max become the next round's closed range (exact, as the
bucketing is monotone). A bucket whose min equals its max is a single value
(a hot value is found at once); buckets of at most ``FETCH_LIMIT`` rows are
fetched whole, all targets in ONE job. Nothing unbounded goes to the driver
or to one task, and no window or sort is used. Typical cost: one stats
aggregate (often shared with the caller), one histogram, one fetch.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
FETCH_LIMIT = 20_000


@dataclass
class _Target:
    tid: int
    expr: Column
    k: int               # 1-based rank within the current range
    lo: object = None
    hi: object = None
    value: object = None
    done: bool = False
    fetch: bool = False


def _valid(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x.cast("double"))


def _in_range(t: _Target) -> Column:
    return _valid(t.expr) & (t.expr >= F.lit(t.lo)) & (t.expr <= F.lit(t.hi))


def column_stats(df: DataFrame, exprs: list[Column]) -> list[tuple[int, object, object]]:
    """(valid count, min, max) per expression, one aggregate."""
    aggs = []
    for i, e in enumerate(exprs):
        ok = _valid(e)
        aggs += [F.count_if(ok).alias(f"n{i}"), F.min(F.when(ok, e)).alias(f"lo{i}"), F.max(F.when(ok, e)).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return [(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(exprs))]


def _bucket(t: _Target) -> Column:
    """Bucket 0 to BUCKETS - 1, rising with the value; the least and the greatest value never share one.

    Integers are dealt by exact decimal arithmetic; infinite doubles lie at either end.
    """
    x, lo, hi = t.expr, t.lo, t.hi
    if isinstance(lo, int):
        place = (x.cast("decimal(20,0)") - F.lit(Decimal(lo))) / F.lit(Decimal((hi - lo) // BUCKETS + 1))
    else:
        top = sys.float_info.max
        low, high = max(lo, -top), min(hi, top)
        width = high / BUCKETS - low / BUCKETS
        place = x / F.lit(width) - F.lit(low / width) if width > 0 and math.isfinite(low / width) else F.lit(0.0)
    inner = F.least(F.greatest(F.floor(place), F.lit(0)), F.lit(BUCKETS - 1))
    return F.when(x <= F.lit(lo), 0).when(x >= F.lit(hi), BUCKETS - 1).otherwise(inner).cast("long")


def _histogram_round(df: DataFrame, active: list[_Target]) -> None:
    ranges: dict[tuple, list[_Target]] = {}  # ranks of one column and range, as the two of a median, share its buckets
    for t in active:
        ranges.setdefault((id(t.expr), t.lo, t.hi), []).append(t)
    parts = [F.when(_in_range(t), F.struct(F.lit(t.tid).alias("tid"), _bucket(t).alias("b"), t.expr.alias("xd"))) for t, *_ in ranges.values()]
    hist = (df.select(F.explode(F.array(*parts)).alias("p")).where(F.col("p").isNotNull())
            .groupBy("p.tid", "p.b").agg(F.count(F.lit(1)).alias("n"), F.min("p.xd").alias("mn"), F.max("p.xd").alias("mx"))
            .collect())
    by_tid: dict[int, list] = {}
    for r in hist:
        by_tid.setdefault(r["tid"], []).append(r)
    for t, tid in [(t, ts[0].tid) for ts in ranges.values() for t in ts]:
        below = 0
        for r in sorted(by_tid.get(tid, []), key=lambda r: r["b"]):
            if below + r["n"] >= t.k:
                t.k -= below
                lo, hi = r["mn"], r["mx"]
                t.lo, t.hi = lo, hi
                if lo == hi:
                    t.value, t.done = lo, True
                elif r["n"] <= FETCH_LIMIT:
                    t.fetch = True
                break
            below += r["n"]


def _fetch_round(df: DataFrame, targets: list[_Target]) -> None:
    parts = [F.when(_in_range(t), F.struct(F.lit(t.tid).alias("tid"), t.expr.alias("x"))) for t in targets]
    rows = df.select(F.explode(F.array(*parts)).alias("p")).where(F.col("p").isNotNull()).select("p.tid", "p.x").collect()
    vals: dict[int, list] = {}
    for r in rows:
        vals.setdefault(r["tid"], []).append(r["x"])
    for t in targets:
        v = sorted(vals.get(t.tid, []))
        t.value, t.done, t.fetch = v[t.k - 1], True, False


def kth_smallest(df: DataFrame, targets: list[tuple[Column, int]],
                 stats: list[tuple[int, object, object]] | None = None) -> list[object]:
    """Exact k-th smallest (1-based, NULL/NaN skipped) per (column, k); None when k is out of range.

    ``stats`` (valid count, min, max) per target skips the first aggregate when the caller has it.
    """
    if not targets:
        return []
    stats = stats or column_stats(df, [e for e, _ in targets])
    ts = []
    for i, ((e, k), (n, lo, hi)) in enumerate(zip(targets, stats, strict=True)):
        t = _Target(i, e, k, lo, hi)
        if k < 1 or k > (n or 0):
            t.done = True
        elif lo == hi:
            t.value, t.done = lo, True
        ts.append(t)
    while True:  # each round parts the least from the greatest value that is left
        fetch = [t for t in ts if t.fetch and not t.done]
        if fetch:
            _fetch_round(df, fetch)
        active = [t for t in ts if not t.done]
        if not active:
            break
        _histogram_round(df, active)
    return [t.value for t in ts]


def exact_median(df: DataFrame, cols: list[str],
                 stats: dict[str, tuple[int, object, object]] | None = None) -> dict[str, float | None]:
    """Exact median per column (mean of the two middle values for an even count), NULL skipped."""
    exprs = {c: F.col(f"`{c}`").cast("double") for c in cols}
    if stats is None:
        got = column_stats(df, list(exprs.values()))
        stats = dict(zip(cols, got, strict=True))
    targets, tstats, slots = [], [], []
    for c in cols:
        n, lo, hi = stats[c]
        if not n:
            slots.append(None)
            continue
        slots.append((len(targets), len(targets) + 1))
        lo_d, hi_d = float(lo), float(hi)
        targets += [(exprs[c], (n + 1) // 2), (exprs[c], n // 2 + 1)]
        tstats += [(n, lo_d, hi_d), (n, lo_d, hi_d)]
    vals = kth_smallest(df, targets, tstats)
    return {c: None if s is None else (float(vals[s[0]]) + float(vals[s[1]])) / 2.0 for c, s in zip(cols, slots, strict=True)}


def kth_key(df: DataFrame, keys: list[Column], k: int) -> list[object] | None:
    """Exact k-th smallest key tuple (1-based, lexicographic over ``keys``, which hold no NULLs).

    Histogram refinement on the first key; once the target range holds at most
    ``FETCH_LIMIT`` rows the full tuples of that range are fetched and sorted
    (one job resolves every key). Only a hot first-key value (min == max over
    more rows) descends to the next key, restricted to that value.
    """
    prefix: list[object] = []
    cond = F.lit(True)
    for level, key in enumerate(keys):
        (n, lo, hi), = column_stats(df.where(cond), [key])
        if k < 1 or k > (n or 0):
            return None
        t = _Target(0, key, k, lo, hi)
        sub = df.where(cond)
        while not t.done and not t.fetch and t.lo != t.hi:
            _histogram_round(sub, [t])
        if t.fetch:
            rest = keys[level:]
            rows = (sub.where(_in_range(t)).select(*[e.alias(f"k{i}") for i, e in enumerate(rest)])
                    .collect())
            rows.sort(key=lambda r: tuple(r))
            return prefix + list(rows[t.k - 1])
        value = t.value if t.done else t.lo
        prefix.append(value)
        k = t.k
        cond = cond & (key == F.lit(value))
    return prefix

"""Quantiles of many columns at once, per group, approximate or exact.

Approximate: one aggregate with ``percentile_approx``.

Exact: Spark's ``percentile`` keeps every distinct value of a group in one
buffer, which a large group overflows. Here the approximate quantile only
proposes a bracket of values; further passes count what lies below and inside
the bracket and narrow it until the few rows left can be listed. Each pass is a
pre-aggregated scan of the needed columns, no task holds more than a histogram.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import known
from riskframe.operators.clean import MAX_CLASSES

ACCURACY = 10_000          # approximate quantiles are off by 1 / ACCURACY of the rows
BRACKET_ACCURACY = 1_000   # the same for the sketch that proposes brackets
FETCH_ROWS = 10_000        # rows listed in the last pass, per bracket
BINS = 1_024


class _Overall:
    def __repr__(self):
        return "OVERALL"


OVERALL = _Overall()       # stands for "all rows" beside the groups of ``by``


@dataclass
class _Target:
    group: object
    col: str
    n: int             # rows with a value
    first: int         # wanted ranks, counted from 0; first <= last <= first + 1
    last: int
    lo: float
    hi: float
    below: int = 0     # rows under lo
    inside: int = 0    # rows in [lo, hi]
    guess: tuple[float, float] | None = None
    value: tuple[float, float] | None = None


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: str | None = None,
              exact: bool = False) -> dict:
    """``{(group, column): [value per prob]}`` for each group of ``by`` and for
    OVERALL, all rows.

    Exact values interpolate linearly between neighbours. Approximate ones are
    values of the table. Columns without any value map to None per prob.
    """
    if exact:
        return exact_quantiles(df, cols, probs, by)
    stats = _stats(df, cols, probs, by, ACCURACY)
    return {k: s["near"] if s["n"] else [None] * len(probs) for k, s in stats.items()}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: str | None = None) -> dict:
    slack = 2.0 / BRACKET_ACCURACY
    around = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    stats = _stats(df, cols, around, by, BRACKET_ACCURACY)
    targets = {k: [_target(*k, s, p, s["near"][i], s["near"][i + len(probs)])
                   for i, p in enumerate(probs)] for k, s in stats.items() if s["n"]}
    _resolve(df, cols, by, [t for ts in targets.values() for t in ts])

    def blend(t, p):
        at = p * (t.n - 1)
        low, high = t.value
        return low + (high - low) * (at - math.floor(at))

    return {k: [blend(t, p) for t, p in zip(targets[k], probs)] if k in targets
            else [None] * len(probs) for k in stats}


def _target(group, col, stats, p, lo, hi) -> _Target:
    n = stats["n"]
    at = p * (n - 1)
    t = _Target(group, col, n, math.floor(at), math.ceil(at), stats["min"], stats["max"], 0, n)
    if n > FETCH_ROWS:
        t.guess = (lo, hi)
    return t


def _stats(df, cols, probs, by, accuracy):
    grouped = df.rollup(by) if by else df.groupBy()
    aggs = [(F.grouping(by) if by else F.lit(1)).alias("overall")]
    for i, c in enumerate(cols):
        v = known(df, c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}"),
                 F.percentile_approx(v, [float(p) for p in probs], accuracy).alias(f"near{i}")]
    rows = grouped.agg(*aggs).limit(MAX_CLASSES + 2).collect()
    if len(rows) > MAX_CLASSES + 1:
        raise ValueError(f"{by} has more than {MAX_CLASSES} values")
    return {(OVERALL if r["overall"] else r[by], c): {"n": r[f"n{i}"], "min": r[f"min{i}"],
                                         "max": r[f"max{i}"], "near": r[f"near{i}"]}
            for r in rows for i, c in enumerate(cols)}


def _resolve(df, cols, by, todo) -> None:
    """Find the values at the wanted ranks of all targets, pass by pass."""
    if any(not (math.isfinite(t.lo) and math.isfinite(t.hi)) for t in todo):
        raise ValueError("exact quantiles need finite values")
    long = df.select(F.col(by).alias("g") if by else F.lit(None).alias("g"),
                     *(known(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)))
    index = {c: i for i, c in enumerate(cols)}
    _check_guesses(long, index, [t for t in todo if t.guess])
    while True:
        for t in todo:
            if t.value is None and t.lo == t.hi:
                t.value = (t.lo, t.hi)
        wide = [t for t in todo if t.value is None and t.inside > FETCH_ROWS]
        if not wide:
            break
        _narrow(long, index, wide)
    _fetch(long, index, [t for t in todo if t.value is None])


def _is_in(t):
    return F.lit(True) if t.group is OVERALL else F.col("g").eqNullSafe(F.lit(t.group))


def _check_guesses(long, index, todo) -> None:
    """Take over those proposed brackets that really hold the wanted ranks."""
    if not todo:
        return
    aggs = []
    for j, t in enumerate(todo):
        v, mine = F.col(f"v{index[t.col]}"), _is_in(t)
        aggs += [F.count_if(mine & (v < t.guess[0])).alias(f"b{j}"),
                 F.count_if(mine & v.between(*t.guess)).alias(f"i{j}")]
    row = long.agg(*aggs).first()
    for j, t in enumerate(todo):
        below, inside = row[f"b{j}"], row[f"i{j}"]
        if below <= t.first and t.last < below + inside:
            (t.lo, t.hi), t.below, t.inside = t.guess, below, inside


def _hits(long, index, targets, detail):
    """Rows inside some bracket as (target, ``detail(value, target)``, value)."""
    def inside(t):
        return _is_in(t) & F.col(f"v{index[t.col]}").between(t.lo, t.hi)

    def hit(j, t):
        v = F.col(f"v{index[t.col]}")
        return F.when(inside(t), F.struct(F.lit(j).alias("t"), detail(v, t).alias("d"),
                                          v.alias("v")))
    some = F.lit(False)
    for t in targets:
        some = some | inside(t)
    found = F.explode(F.array(*(hit(j, t) for j, t in enumerate(targets))))
    return long.filter(some).select(found.alias("h")).filter(F.col("h").isNotNull()).select("h.*")


def _narrow(long, index, targets):
    """Replace each bracket by the histogram bin that holds the wanted ranks."""
    def bin_of(v, t):
        # halves keep the width finite for the widest brackets
        share = (v * 0.5 - t.lo * 0.5) / (t.hi * 0.5 - t.lo * 0.5)
        return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")

    rows = (_hits(long, index, targets, bin_of).groupBy("t", "d")
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
    for j, t in enumerate(targets):
        below = t.below
        bins = sorted((r for r in rows if r["t"] == j), key=lambda r: r["d"])
        for pos, r in enumerate(bins):
            if t.first < below + r["n"]:
                if t.last >= below + r["n"]:
                    t.value = (r["hi"], bins[pos + 1]["lo"])
                t.lo, t.hi, t.below, t.inside = r["lo"], r["hi"], below, r["n"]
                break
            below += r["n"]


def _fetch(long, index, targets):
    """List the values left in each bracket and read off the wanted ranks."""
    if not targets:
        return
    rows = (_hits(long, index, targets, lambda v, t: F.lit(0)).groupBy("t", "v").count()
            .collect())
    for j, t in enumerate(targets):
        below, first = t.below, None
        for v, n in sorted((r["v"], r["count"]) for r in rows if r["t"] == j):
            if first is None and t.first < below + n:
                first = v
            if t.last < below + n:
                t.value = (first, v)
                break
            below += n

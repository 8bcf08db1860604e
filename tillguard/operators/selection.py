"""Order statistics by narrowing histograms: no value moves or is sorted.

Doubles are mapped to whole numbers of the same order.  A pass counts, in each
task, the values that fall into bins of the intervals still asked for; only
bin totals leave a task (count and sum for each of two samples, least and
greatest value).  The driver keeps the bins whose inside still matters and
asks for them again, cut finer.  The intervals of a column are cut into about
``COLUMN_BINS`` bins a pass, so a few passes reach single values, whatever the
number of rows and of columns; all columns, probabilities and distances share
the passes.  A task passes over several partitions, so that the bins that leave
the tasks do not grow with the input.

* quantiles: the bin that holds the rank;
* Kolmogorov-Smirnov: bins inside which the distributions may be further
  apart than at the bin ends seen so far;
* Wasserstein: bins inside which the difference of the distributions may
  change its sign; elsewhere the integral follows from counts and sums.

A column that asks for more than ``MOST_INTERVALS`` intervals (distributions
that are alike at every scale) is given back to the caller, which has an exact
way that shuffles distinct values.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of one column in a pass, about; and intervals of a column at most.
COLUMN_BINS, MOST_INTERVALS = 1 << 16, 1 << 14
#: Values of a column's intervals, copies included, up to which a pass counts single values.
SINGLE_VALUES = 1 << 17
#: Tasks of a pass for each core.
TASKS_PER_CORE = 2
_FLIP = np.int64(0x7FFFFFFFFFFFFFFF)
BINS = "c int, b long, n1 long, n2 long, s1 double, s2 double, lo long, hi long"


def to_keys(v: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles (-0.0 is 0.0)."""
    k = (v + 0.0).view(np.int64)
    return np.where(k < 0, k ^ _FLIP, k)


def to_values(keys: np.ndarray) -> np.ndarray:
    return np.where(keys < 0, keys ^ _FLIP, keys).view(np.float64)


def to_value(key: int) -> float:
    return float(to_values(np.array([key], np.int64))[0])


@dataclass
class Bin:
    """Non-empty bin: counts and sums of both samples, least and greatest key."""
    n1: int
    n2: int
    s1: float
    s2: float
    lo: int
    hi: int


def _layout(intervals: list[tuple[int, int]]):
    """Starts, ends, shifts and first bins of disjoint, rising intervals."""
    bits = max(1, (COLUMN_BINS // max(1, len(intervals))).bit_length() - 1)
    shifts = [max(0, (hi - lo).bit_length() - bits) for lo, hi in intervals]
    sizes = [((hi - lo) >> s) + 1 for (lo, hi), s in zip(intervals, shifts)]
    return (np.array([x for x, _ in intervals], np.int64), np.array([x for _, x in intervals], np.int64),
            np.array(shifts, np.uint64), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), int(sum(sizes)))


def _pass(df: DataFrame, cols: Sequence[str], sample: str | None, asked: dict[str, list[tuple[int, int]]],
          single: frozenset[str] | set[str] = frozenset()) -> dict[str, list[Bin]]:
    """Bins of the asked intervals, rising, from one scan; ``sample`` is a
    boolean column that tells the second sample.  Columns in ``single`` have
    few values in their intervals: each distinct one is a bin."""
    names = [c for c in cols if asked.get(c)]
    layouts = [_layout(asked[c]) for c in names]
    alone = [c in single for c in names]
    frame = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)],
                      (F.col(sample) if sample else F.lit(False)).alias("_s"))
    frame = frame.coalesce(TASKS_PER_CORE * max(1, df.sparkSession.sparkContext.defaultParallelism))

    def run(batches):
        held = [None] * len(alone)
        few = [[] for _ in alone]
        for batch in batches:
            second = batch.column(len(alone)).to_numpy(zero_copy_only=False).astype(bool)
            for i, (lows, highs, shifts, base, total) in enumerate(layouts):
                v = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)  # null as NaN
                fine = ~np.isnan(v)
                v, two = v[fine], second[fine]
                k = to_keys(v)
                at = np.searchsorted(lows, k, "right") - 1
                inside = (at >= 0) & (k <= highs[np.maximum(at, 0)])
                v, two, k, at = v[inside], two[inside], k[inside], at[inside]
                if not len(k):
                    continue
                if alone[i]:
                    few[i].append((k, two))
                    continue
                b = base[at] + ((k.view(np.uint64) - lows[at].view(np.uint64)) >> shifts[at]).astype(np.int64)
                if held[i] is None:
                    held[i] = (np.zeros((2, total), np.int64), np.zeros((2, total)), np.full(total, _FLIP), np.full(total, -_FLIP - 1))
                n, s, lo, hi = held[i]
                for x, mask in ((0, ~two), (1, two)):
                    n[x] += np.bincount(b[mask], minlength=total)
                    s[x] += np.bincount(b[mask], v[mask], minlength=total)
                np.minimum.at(lo, b, k)
                np.maximum.at(hi, b, k)
        for i, (h, f) in enumerate(zip(held, few)):
            if f:
                k, two = (np.concatenate(x) for x in zip(*f))
                b, at = np.unique(k, return_inverse=True)
                n = np.stack([np.bincount(at[mask], minlength=len(b)) for mask in (~two, two)])
                rows = b, n, n * to_values(b), b, b
            elif h is not None:
                n, s, lo, hi = h
                hit = np.nonzero(n.sum(axis=0))[0]
                rows = hit, n[:, hit], s[:, hit], lo[hit], hi[hit]
            else:
                continue
            b, n, s, lo, hi = rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), i, np.int32)), *map(pa.array, (b, n[0], n[1], s[0], s[1], lo, hi))],
                                             [x.split()[0] for x in BINS.split(", ")])

    sums = [F.sum(x).alias(x) for x in ("n1", "n2", "s1", "s2")]
    rows = frame.mapInArrow(run, BINS).groupBy("c", "b").agg(*sums, F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    out: dict[str, list[Bin]] = {c: [] for c in names}
    found = rows.toArrow()  # at most the bins of a pass
    for c, *of in zip(*(found[x].to_pylist() for x in ("c", "n1", "n2", "s1", "s2", "lo", "hi"))):
        out[names[c]].append(Bin(*of))
    return {c: sorted(bins, key=lambda b: b.lo) for c, bins in out.items()}


ALL = [(-int(_FLIP) - 1, int(_FLIP))]


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation between ranks; NULL and NaN
    are left out, None without a value."""
    asked: dict[str, list[tuple[int, int]]] = {c: ALL for c in cols}
    ranks: dict[str, dict[int, list]] = {}  # rank -> [interval, values before it]
    total: dict[str, int] = {}
    first = True
    while any(asked.values()):
        bins = _pass(df, cols, None, asked)
        for c, found in bins.items():
            if first:
                total[c] = n = sum(b.n1 for b in found)
                want = {r for p in probs for r in (int(np.floor((n - 1) * p)), int(np.ceil((n - 1) * p)))} if n else set()
                ranks[c] = {r: [ALL[0], 0] for r in want}
            for r, place in ranks[c].items():
                if place[0][0] == place[0][1]:
                    continue
                before = place[1]
                for b in found:
                    if place[0][0] <= b.lo and b.hi <= place[0][1]:
                        if r < before + b.n1:
                            place[:] = [(b.lo, b.hi), before]
                            break
                        before += b.n1
            asked[c] = sorted({place[0] for place in ranks[c].values() if place[0][0] < place[0][1]})
        first = False
    out: dict[str, list[float | None]] = {}
    for c in cols:
        n, at = total.get(c, 0), ranks.get(c, {})
        out[c] = []
        for p in probs:
            if not n:
                out[c].append(None)
                continue
            h = (n - 1) * p
            lo, hi = to_value(at[int(np.floor(h))][0][0]), to_value(at[int(np.ceil(h))][0][0])
            out[c].append(lo if lo == hi else float(lo + (h - np.floor(h)) * (hi - lo)))
    return out


def _range(df: DataFrame, cols: Sequence[str]) -> dict[str, list[tuple[int, int]]]:
    """From the least to the greatest value of each column that has one."""
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    ends = df.agg(*[f(v) for v in value.values() for f in (F.min, F.max)]).first()
    return {c: [tuple(int(k) for k in to_keys(np.array(ends[2 * i:2 * i + 2], float)))] for i, c in enumerate(cols) if ends[2 * i] is not None}


def _narrowed(df: DataFrame, cols: Sequence[str], sample: str, *tests: Callable) -> tuple[dict[str, list[Bin]], list[set[str]]]:
    """Bins of each column, cut until no test names one of several values, and
    for each test the columns of which it did not ask for too many.  A test
    gets what ``_gaps`` tells of a column's bins and gives places."""
    bins = _pass(df, cols, sample, _range(df, cols))
    state: dict[str, list[Bin]] = {c: bins.get(c, []) for c in cols}
    bounded = [set(cols) for _ in tests]
    while True:
        asked = {}
        for c, held in state.items():
            n1, n2 = sum(b.n1 for b in held), sum(b.n2 for b in held)
            cut = set()
            for test, fine in zip(tests, bounded) if n1 and n2 else ():
                if c in fine:
                    named = [i for i in test(*_gaps(held, n1, n2)) if held[i].lo < held[i].hi]
                    if len(named) > MOST_INTERVALS:
                        fine.discard(c)
                    else:
                        cut.update(named)
            if cut:
                asked[c] = sorted(cut)
        if not asked:
            return state, bounded
        single = {c for c, cut in asked.items() if sum(state[c][i].n1 + state[c][i].n2 for i in cut) <= SINGLE_VALUES}
        found = _pass(df, cols, sample, {c: [(state[c][i].lo, state[c][i].hi) for i in cut] for c, cut in asked.items()}, single)
        for c, cut in asked.items():
            gone = set(cut)
            state[c] = sorted([b for i, b in enumerate(state[c]) if i not in gone] + found[c], key=lambda b: b.lo)


def _gaps(bins: list[Bin], n1: int, n2: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """F1 - F2 in units of 1 / (n1 n2): before each bin, after it, and the
    least and greatest it can be inside."""
    kind = np.int64 if n1 * n2 < 1 << 61 else object
    one = np.array([b.n1 for b in bins], kind) * n2
    two = np.array([b.n2 for b in bins], kind) * n1
    after = np.cumsum(one - two)
    before = after - (one - two)
    return before, after, before - two, before + one


def _further(before, after, least, most) -> np.ndarray:
    """Bins inside which the gap may be wider than at any bin end."""
    return np.nonzero(np.maximum(most, -least) > np.abs(after).max())[0]


def _turning(before, after, least, most) -> np.ndarray:
    """Bins inside which the gap may change its sign."""
    return np.nonzero((least < 0) & (most > 0))[0]


def _widest(bins: list[Bin]) -> tuple[float | None, int, int]:
    n1, n2 = sum(b.n1 for b in bins), sum(b.n2 for b in bins)
    return int(np.abs(_gaps(bins, n1, n2)[1]).max()) / (n1 * n2) if n1 and n2 else None, n1, n2


def _area(bins: list[Bin]) -> float:
    n1, n2 = sum(b.n1 for b in bins), sum(b.n2 for b in bins)
    if not n1 or not n2:
        return 0.0
    before, after, _, _ = (x.tolist() for x in _gaps(bins, n1, n2))
    total = 0.0
    for i, b in enumerate(bins):
        u, w = to_value(b.lo), to_value(b.hi)
        if u < w:  # the sign is one, so the integral of the difference will do
            total += abs(before[i] / (n1 * n2) * (w - u) + (b.n1 * w - b.s1) / n1 - (b.n2 * w - b.s2) / n2)
        if i + 1 < len(bins):
            total += abs(after[i]) / (n1 * n2) * (to_value(bins[i + 1].lo) - w)
    return total


def ks(df: DataFrame, cols: Sequence[str], sample: str) -> dict[str, tuple[float | None, int, int] | None]:
    """(D, n1, n2) of each column; D is None if a sample is empty; None for a
    column that asks for too many intervals."""
    bins, (fine,) = _narrowed(df, cols, sample, _further)
    return {c: _widest(bins[c]) if c in fine else None for c in cols}


def wasserstein(df: DataFrame, cols: Sequence[str], sample: str) -> dict[str, float | None]:
    """Integral of |F1 - F2| of each column (0 if a sample is empty); None for
    a column that asks for too many intervals."""
    bins, (fine,) = _narrowed(df, cols, sample, _turning)
    return {c: _area(bins[c]) if c in fine else None for c in cols}


def ks_and_wasserstein(df: DataFrame, cols: Sequence[str], sample: str):
    """What ``ks`` and ``wasserstein`` give, from the same passes."""
    bins, (fine, smooth) = _narrowed(df, cols, sample, _further, _turning)
    return {c: _widest(bins[c]) if c in fine else None for c in cols}, {c: _area(bins[c]) if c in smooth else None for c in cols}

"""Exact quantiles by selection: value histograms, refined around the wanted ranks.

Spark's ``percentile``/``median`` keep one counter per distinct value and merge
them in one final task — fine for scores or word counts, unbounded for a
continuous column.  This finds the same exact, linearly interpolated quantiles
(the definition of ``describe`` and of SQL ``quantile_cont``) without a sort, a
cached frame or state that grows with the number of distinct values:

  1. one aggregate gives count, least and largest value of every column;
  2. one aggregate per round counts the values of each open range, of all columns
     together, in at most ``BINS`` bins, with the least and largest value of each bin;
  3. the bin that holds a wanted rank is the range of the next round; it is settled
     when its least and largest value are equal.

A range that spans signs or magnitudes is cut by magnitude, any other evenly, so
the rounds are bounded by the bits of a double: about nine for any input, two or
three for counts and scores.  A round's result, and what reaches the driver, is at
most ``BINS`` rows per open range, whatever the size of the table.  Every round reads
``df`` again, its own columns only; a frame that is dear to compute is best stored first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 512
INF = float("inf")


@dataclass
class _Range:
    """Values of one column between ``low`` and ``high``; ``ranks`` are the wanted ones, ``before`` counts the values below."""

    col: int
    low: float
    high: float
    before: int = 0
    ranks: set[int] = field(default_factory=set)

    def even(self) -> bool:
        """Whether the range is narrow enough to be cut evenly."""
        a, b = sorted((abs(self.low), abs(self.high)))
        return (self.low > 0) == (self.high > 0) and 0 < a and b <= 16 * a and b < INF

    def bin(self, v: Column) -> Column:
        """Number of the bin of a value of the range; never falls as the value grows."""
        if self.even():
            place, lo, hi = v, self.low, self.high
        else:
            place, lo, hi = _magnitude(v), *map(_magnitude_of, (self.low, self.high))
        return F.least(F.floor((place - F.lit(lo)) / F.lit(hi - lo) * BINS), F.lit(BINS - 1)).cast("int")


def _magnitude(v: Column) -> Column:
    """Signed logarithm that grows with the value over all doubles: zero in the middle, the infinities at the ends."""
    size = F.abs(v)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.signum(v) * F.when(size == INF, F.lit(3000.0)).otherwise(F.log2(size) + F.lit(1100.0)))


def _magnitude_of(v: float) -> float:
    if v == 0:
        return 0.0
    return math.copysign(3000.0 if abs(v) == INF else math.log2(abs(v)) + 1100.0, v)


def _value(name: str) -> Column:
    """The column as double; NaN counts as no value."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def _histograms(df: DataFrame, cols: list[str], ranges: list[_Range]) -> DataFrame:
    """(slot, bin, n, low, high) of the values inside each range: one pass over ``df`` for all of them."""
    values = df.select(*[_value(c).alias(f"v{i}") for i, c in enumerate(cols)])
    slots = []
    for s, r in enumerate(ranges):
        v = F.col(f"v{r.col}")
        inside = v.between(F.lit(r.low), F.lit(r.high))
        slots.append(F.when(inside, F.struct(F.lit(s).alias("slot"), r.bin(v).alias("bin"), v.alias("v"))))
    one = values.select(F.explode(F.array_compact(F.array(*slots))).alias("e"))
    return one.groupBy("e.slot", "e.bin").agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("low"), F.max("e.v").alias("high"))


def _select(df: DataFrame, cols: list[str], ranges: list[_Range]) -> dict[tuple[int, int], float]:
    """(column, rank) -> value."""
    found: dict[tuple[int, int], float] = {}
    while True:
        found.update({(r.col, k): r.low for r in ranges if r.low == r.high for k in r.ranks})
        ranges = [r for r in ranges if r.low != r.high and r.ranks]
        if not ranges:
            return found
        bins: dict[int, list] = {}
        for row in _histograms(df, cols, ranges).collect():  # at most BINS rows per range
            bins.setdefault(row.slot, []).append(row)
        narrower = []
        for s, r in enumerate(ranges):
            before = r.before
            for row in sorted(bins[s], key=lambda b: b.bin):
                ranks = {k for k in r.ranks if before <= k < before + row.n}
                if ranks:
                    narrower.append(_Range(r.col, row.low, row.high, before, ranks))
                before += row.n
        ranges = narrower


def exact_quantiles_of(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list]:
    """The exact quantiles of every column for ``probs`` as numbers (None where a
    column has no values); nulls and NaN are ignored.

    q = v[lo] + (pos - lo) * (v[hi] - v[lo]) with pos = p * (n - 1) over the
    sorted values (0-based), lo/hi its floor/ceil.
    """
    ends = []
    for i, c in enumerate(cols):
        v = _value(c)
        ends += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    e = df.agg(*ends).first()
    pos = {i: [p * (e[f"n{i}"] - 1) for p in probs] for i in range(len(cols)) if e[f"n{i}"]}
    ranges = [
        _Range(i, e[f"lo{i}"], e[f"hi{i}"], 0, {k for q in at for k in (math.floor(q), math.ceil(q))}) for i, at in pos.items()
    ]
    value = _select(df, cols, ranges)
    out: dict[str, list] = {c: [None] * len(probs) for c in cols}
    for i, at in pos.items():
        pairs = [(value[i, math.floor(q)], value[i, math.ceil(q)], q - math.floor(q)) for q in at]
        out[cols[i]] = [lo if part == 0 else lo + (hi - lo) * part for lo, hi, part in pairs]
    return out


def exact_quantile_values(df: DataFrame, col: str, probs: list[float]) -> list:
    """The exact quantiles of one column (see ``exact_quantiles_of``)."""
    return exact_quantiles_of(df, [col], probs)[col]


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """One row with ``q0, q1, ...`` (double) for ``probs`` (see ``exact_quantiles_of``)."""
    vals = exact_quantile_values(df, col, probs)
    schema = ", ".join(f"q{i} double" for i in range(len(probs)))
    return df.sparkSession.createDataFrame([tuple(vals)], schema)

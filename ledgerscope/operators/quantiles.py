"""Exact quantiles of many columns by distributed selection.

Every column keeps a range that holds the wanted value and the number of values below it. A round is two
jobs for all columns at once: quantile digests of the values in range give a narrower one around the
wanted rank, and counts tell where it lies. A digest of accuracy a leaves about 4 / a of the values, so
three rounds do for 10^10 rows. What has at most ``FEW`` values left is sorted. The driver sees a few
numbers a column, whatever the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: relative accuracy of the digests; values of a column that are sorted at last
ACCURACY, FEW = 1_000, 2_000


@dataclass
class _Range:
    column: str
    low: float
    high: float
    below: int
    inside: int
    rank: int  # of the wanted value among all, from 1

    def test(self) -> str:
        return f"`{self.column}` BETWEEN {self.low!r}D AND {self.high!r}D"

    @property
    def done(self) -> bool:
        return self.low == self.high


def exact_quantiles(df: DataFrame, columns: list[str], share: float = 0.5) -> dict[str, float | None]:
    """The value of rank ``ceil(share * n)`` (at least 1) of each column's n values; None of a column without values.

    Null and NaN are no values; infinite ones count.
    """
    values = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    aggs = [x for i, c in enumerate(columns) for x in (F.count(F.col(c)).alias(f"n{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}"))]
    row = values.agg(*aggs).first()
    found: dict[str, float | None] = dict.fromkeys(columns)
    open_ = []
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        if n:
            r = _Range(c, row[f"l{i}"], row[f"h{i}"], 0, n, max(1, math.ceil(share * n)))
            if math.isinf(r.low) or math.isinf(r.high):
                r = _without_infinite(values, r)
            open_.append(r)
    while open_:
        for r in [r for r in open_ if r.done]:
            found[r.column] = r.low
        open_ = [r for r in open_ if not r.done]
        few = [r for r in open_ if r.inside <= FEW]
        if few:
            got = values.agg(*[F.expr(f"sort_array(collect_list(CASE WHEN {r.test()} THEN `{r.column}` END))").alias(f"v{i}") for i, r in enumerate(few)]).first()
            for i, r in enumerate(few):
                found[r.column] = got[f"v{i}"][r.rank - r.below - 1]
            open_ = [r for r in open_ if r not in few]
        if open_:
            open_ = _narrowed(values, open_)
    return found


def _without_infinite(values: DataFrame, r: _Range) -> _Range:
    """The range without infinite ends, unless the wanted value is one."""
    c = f"`{r.column}`"
    lows, highs, low, high = values.agg(
        F.expr(f"count_if({c} = double('-infinity'))"), F.expr(f"count_if({c} = double('infinity'))"),
        F.expr(f"min(CASE WHEN {c} > double('-infinity') THEN {c} END)"), F.expr(f"max(CASE WHEN {c} < double('infinity') THEN {c} END)"),
    ).first()
    if r.rank <= lows:
        return _Range(r.column, -math.inf, -math.inf, 0, lows, r.rank)
    if r.rank > r.inside - highs:
        return _Range(r.column, math.inf, math.inf, r.inside - highs, highs, r.rank)
    return _Range(r.column, low, high, lows, r.inside - lows - highs, r.rank)


def _narrowed(values: DataFrame, ranges: list[_Range]) -> list[_Range]:
    shares = []
    for r in ranges:
        at = (r.rank - r.below) / r.inside
        shares.append((max(0.0, at - 2 / ACCURACY), min(1.0, at + 2 / ACCURACY)))
    digests = values.agg(
        *[
            F.expr(f"percentile_approx(CASE WHEN {r.test()} THEN `{r.column}` END, array({a!r}D, {b!r}D), {ACCURACY})").alias(f"q{i}")
            for i, (r, (a, b)) in enumerate(zip(ranges, shares, strict=True))
        ]
    ).first()
    counts = []
    for i, r in enumerate(ranges):
        a, b = digests[f"q{i}"]
        c = f"`{r.column}`"
        counts += [
            F.expr(f"count_if({r.test()} AND {c} < {a!r}D)").alias(f"b{i}"),
            F.expr(f"count_if({c} = {a!r}D)").alias(f"a{i}"),
            F.expr(f"count_if({c} > {a!r}D AND {c} < {b!r}D)").alias(f"m{i}"),
            F.expr(f"count_if({c} = {b!r}D)").alias(f"e{i}"),
        ]
    row = values.agg(*counts).first()
    return [_settled(r, *digests[f"q{i}"], row[f"b{i}"], row[f"a{i}"], row[f"m{i}"], row[f"e{i}"]) for i, r in enumerate(ranges)]


def _settled(r: _Range, a: float, b: float, under: int, at_a: int, between: int, at_b: int) -> _Range:
    """The part of the range that holds the rank; a and b are values, so every part is smaller, ties or not."""
    below, at_b = r.below + under, 0 if a == b else at_b
    if r.rank <= below:  # a digest may miss its bound; the counts don't
        return _Range(r.column, r.low, math.nextafter(a, -math.inf), r.below, under, r.rank)
    if r.rank <= below + at_a:
        return _Range(r.column, a, a, below, at_a, r.rank)
    below += at_a
    if r.rank <= below + between:
        return _Range(r.column, math.nextafter(a, math.inf), math.nextafter(b, -math.inf), below, between, r.rank)
    below += between
    if r.rank <= below + at_b:
        return _Range(r.column, b, b, below, at_b, r.rank)
    below += at_b
    return _Range(r.column, math.nextafter(b, math.inf), r.high, below, r.inside - (below - r.below), r.rank)

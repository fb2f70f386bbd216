"""Exact quantiles of any number of rows, by narrowing brackets.

A quantile sketch with a fixed rank error gives, for each wanted rank, a lower and an upper value that are sure
to enclose the answer. The next pass looks only at the values between them, a few ten-thousandths of the
rows, and so on until the two meet or so few values are left that a sketch of them is exact. Every pass is one
map-side aggregate for all columns together and returns one row. The answer is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = 5_000  # a sketch is off by at most one part in this many of its rows
EXACT_ROWS = 50_000  # up to so many rows a sketch of relative error 1 / FINE keeps every value
FINE = 1_000_000


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str | Column, float]]) -> dict[str, float | None]:
    """name -> (column, probability): the smallest value whose cumulative share reaches the probability.

    Null and NaN don't count; without values the answer is null.
    """
    source = {n: (F.col(c) if isinstance(c, str) else c).cast("double") for n, (c, _) in wanted.items()}
    source = {n: F.when(~F.isnan(x), x) for n, x in source.items()}
    if not wanted:
        return {}
    row = df.agg(*[F.count(source[n]).alias(n) for n in wanted]).first()
    rank = {n: max(1, math.ceil(p * row[n])) for n, (_, p) in wanted.items()}
    out: dict[str, float | None] = {n: None for n in wanted if not row[n]}
    left = {n: (row[n], 0) for n in wanted if row[n]}  # rows between the bounds, rows up to the lower one
    bounds: dict[str, tuple[float, float]] = {}
    while left:
        sketches = []
        for n, (rows, below) in left.items():
            x = source[n]
            x = F.when((x > bounds[n][0]) & (x < bounds[n][1]), x) if n in bounds else x
            at, slack = (rank[n] - below - 0.5) / rows, 2 / ERROR
            exact = rows <= EXACT_ROWS
            sketches.append(F.percentile_approx(x, [at] if exact else [max(0.0, at - slack), min(1.0, at + slack)], FINE if exact else ERROR).alias(n))
        row = df.agg(*sketches).first()
        met = {n: row[n][0] for n in left if row[n][0] == row[n][-1]}
        out |= met
        bounds = {n: (row[n][0], row[n][-1]) for n in left if n not in met}
        if not bounds:
            break
        counts = df.agg(*[c for n, (low, high) in bounds.items() for c in (
            F.count(F.when(source[n] <= low, 1)).alias(f"{n}_low"), F.count(F.when(source[n] < high, 1)).alias(f"{n}_high"))]).first()
        left = {}
        for n, (low, high) in bounds.items():
            upto, under = counts[f"{n}_low"], counts[f"{n}_high"]
            if rank[n] <= upto:
                out[n] = low
            elif rank[n] > under:
                out[n] = high
            else:
                left[n] = (under - upto, upto)
    return out

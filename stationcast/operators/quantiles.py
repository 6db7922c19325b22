"""Exact quantiles of weighted integers by distributed selection.

A value of rank r among all values, each counted as often as its weight says, is found in passes.  A pass cuts
the ranges that still hold a wanted rank into ``BINS`` equal bins and sums the weights of every bin: a hash
aggregate that is combined map-side and leaves at most ``BINS`` rows for each wanted rank.  The bin in which the running sum
passes the rank is the next range.  Each pass narrows a range by the factor ``BINS``, whatever the
distribution, so 64-bit values need six passes at most and counts up to 10^10 three; no task and no buffer ever holds
the distinct values.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def order_statistics(df: DataFrame, value: str, weight: str, ranks: list[int], low: int, high: int,
                     bins: int = BINS) -> dict[int, int]:
    """rank (0-based) -> value.  ``low`` and ``high`` bound the values; null values and weights are left out."""
    rows = df.select(F.col(value).cast("long").alias("v"), F.col(weight).cast("long").alias("w")).where("v is not null and w > 0")
    state = {r: (low, high, r) for r in ranks}          # range and rank inside it
    while ranges := sorted({(a, b) for a, b, _ in state.values() if a < b}):
        width = {(a, b): -(-(b - a + 1) // bins) for a, b in ranges}
        inside = [F.when(F.col("v").between(a, b), F.struct(F.lit(i).alias("i"), F.expr(f"(v - {a}L) div {width[a, b]}L").alias("b")))
                  for i, (a, b) in enumerate(ranges)]
        binned = rows.select("w", F.coalesce(*inside).alias("at")).where("at is not null")
        sums = binned.groupBy("at.i", "at.b").agg(F.sum("w").alias("n")).collect()      # bins x ranks rows at most
        bins_of: dict[int, list[tuple[int, int]]] = {}
        for s in sorted(sums, key=lambda s: (s["i"], s["b"])):
            bins_of.setdefault(s["i"], []).append((s["b"], s["n"]))
        for r, (a, b, left) in state.items():
            if a == b:
                continue
            for k, n in bins_of[ranges.index((a, b))]:
                if left < n:
                    start = a + k * width[a, b]
                    state[r] = (start, min(b, start + width[a, b] - 1), left)
                    break
                left -= n
    return {r: a for r, (a, _, _) in state.items()}


def weighted_quantiles(df: DataFrame, value: str, weight: str, shares: list[float]) -> tuple | None:
    """(least, quantiles, largest) of integers that each count ``weight`` times; a quantile between two values is
    interpolated linearly.  None without rows.  ``df`` is read once for each pass: give it as a table."""
    known = df.where(F.col(value).isNotNull() & (F.col(weight) > 0))
    least, largest, n = known.agg(F.min(F.col(value).cast("long")), F.max(F.col(value).cast("long")),
                                  F.sum(F.col(weight).cast("long"))).first()
    if not n:
        return None
    places = [share * (n - 1) for share in shares]
    wanted = sorted(reduce(set.union, ({math.floor(p), math.ceil(p)} for p in places), set()))
    at = order_statistics(df, value, weight, wanted, least, largest)
    out = []
    for p in places:
        lo, hi = math.floor(p), math.ceil(p)
        out.append(float(at[lo]) if at[lo] == at[hi] else (hi - p) * at[lo] + (p - lo) * at[hi])
    return least, out, largest

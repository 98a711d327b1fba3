"""Exact quantiles without one task seeing all values."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medley.operators.skew import running

ACCURACY = 10_000
FEW = 20_000
ROUNDS = 5
Bracket = tuple[Any, Any]


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """1-based ranks around the p-quantile by linear interpolation, and the weight of the upper one."""
    position = (n - 1) * p
    low = int(position)
    return low + 1, min(low + 2, n), position - low


def _inside(bracket: Bracket) -> Column:
    v, (low, high) = F.col("v"), bracket
    return (v >= F.lit(low)) & (v <= F.lit(high))


def _by_counts(values: DataFrame, ranks: Sequence[int]) -> dict[int, Any]:
    """Values at ranks from the counts of all values, summed up along them part by part."""
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    placed = running(counts, [], ["v"], {"upto": ("sum", "n")})
    asked = F.array(*[F.lit(r).cast("long") for r in ranks])
    inside = F.filter(asked, lambda r: (r <= F.col("upto")) & (r > F.col("upto") - F.col("n")))
    return {h["rank"]: h["v"] for h in placed.select("v", F.explode(inside).alias("rank")).collect()}


def _narrowed(values: DataFrame, ranks: Sequence[int], n: int, few: int) -> dict[int, Any]:
    """Values at ranks by brackets from a mergeable sketch; a rank whose bracket stays wide, for copies at its border, is left out."""
    width, found = 2.0 / ACCURACY, {}
    held: dict[int, tuple[Bracket | None, int, int]] = {r: (None, 0, n) for r in ranks}
    for _ in range(ROUNDS):
        asked = list(held)
        if all(held[r][2] <= few for r in asked):
            break
        sketches = []
        for r in asked:
            bracket, below, m = held[r]
            at = (r - below) / m
            own = F.col("v") if bracket is None else F.when(_inside(bracket), F.col("v"))
            sketches.append(F.percentile_approx(own, [max(0.0, at - width), min(1.0, at + width)], ACCURACY))
        brackets = [tuple(x) for x in values.agg(*sketches).first()]
        sums = [x for b in brackets for x in (F.count_if(F.col("v") < F.lit(b[0])), F.count_if(_inside(b)))]
        counted = values.agg(*sums).first()
        wide = {}
        for k, r in enumerate(asked):
            below, m = counted[2 * k : 2 * k + 2]
            if not below < r <= below + m or m > held[r][2]:
                return found
            if brackets[k][0] == brackets[k][1]:
                found[r] = brackets[k][0]
            else:
                wide[r] = (brackets[k], below, m)
        held = wide
        if not held:
            return found
    near = {r: x for r, x in held.items() if x[2] <= few}
    if not near:
        return found
    whole = any(b is None for b, _, _ in near.values())
    picked = values if whole else values.filter(_any([_inside(b) for b in {b for b, _, _ in near.values()}]))
    rows = sorted((tuple(x) for x in picked.groupBy("v").agg(F.count(F.lit(1))).collect()), key=lambda x: (x[0] != x[0], x[0]))  # NaN comes last
    for r, (bracket, below, _) in near.items():
        upto = below
        for v, times in rows:
            if bracket is None or bracket[0] <= v <= bracket[1]:
                upto += times
                if upto >= r:
                    found[r] = v
                    break
    return found


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float], few: int = FEW) -> list[float | None]:
    """[P22, A09] Exact interpolated quantiles of a column, any number at once; None for each if there is no value.

    A sketch of bounded size, merged over the tasks, brackets every asked rank by two values; a count shows that the rank is
    between them and how many rows are. Brackets are narrowed until they hold no more than `few` rows each, which are
    counted by value. Nothing is sorted or shuffled but sketches, counts and those rows. Ranks at the border of a value with
    very many copies may not narrow; they are looked up among the counts of all values.
    """
    values = df.select(F.col(column).alias("v")).filter("v is not null")
    total = values.count()
    if not total:
        return [None for _ in probabilities]
    asked = [_ranks(total, p) for p in probabilities]
    ranks = sorted({r for low, high, _ in asked for r in (low, high)})
    at = _narrowed(values, ranks, total, few)
    if rest := [r for r in ranks if r not in at]:
        at |= _by_counts(values, rest)
    return [at[low] + (at[high] - at[low]) * weight for low, high, weight in asked]

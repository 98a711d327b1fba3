"""Numeric and array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """[A15, X17] part / whole * 100, null if the divisor is 0."""
    return F.try_divide(part, whole) * 100


def reciprocal(col: Column) -> Column:
    """[X17] 1 / value, null for 0."""
    return F.try_divide(F.lit(1.0), col)


def linear(col: Column, factor: float, offset: float = 0.0) -> Column:
    """[X17] A unit change: value * factor + offset."""
    return col * factor + offset


def kelvin(col: Column) -> tuple[Column, Column]:
    """[X17] Kelvin as degrees Celsius and Fahrenheit."""
    celsius = linear(col, 1.0, -273.15)
    return celsius, linear(celsius, 9 / 5, 32.0)


def between_either(col: Column, a: Column, b: Column) -> Column:
    """[P09] Between two bounds given in either order."""
    return col.between(F.least(a, b), F.greatest(a, b))


def cap(col: Column, limit: float) -> Column:
    """[P19] Values above the limit set to the limit; null stays null."""
    return F.when(col > limit, F.lit(limit)).otherwise(col)


def lift(a: Column, b: Column, f: Callable[[Column, Column], Column]) -> Column:
    """[U07, X26] A binary expression applied element by element to two arrays."""
    return F.zip_with(a, b, f)


def array_ops(a: Column, b: Column) -> dict[str, Column]:
    """[X26] Elementwise sum, quotient and floor; sorted and joined arrays; first two elements."""
    return {
        "added": lift(a, b, lambda x, y: x + y),
        "divided": lift(a, b, F.try_divide),
        "floored": F.transform(a, lambda x: F.floor(x)),
        "ordered": F.array_sort(a),
        "joined": F.concat(a, b),
        "head": F.slice(a, 1, 2),
    }


def even_positions(arr: Column) -> Column:
    """[P25] Positions (from 0) of the even elements."""
    at = F.transform(arr, lambda x, i: F.when(x % 2 == 0, i))
    return F.filter(at, lambda i: i.isNotNull())


def even_values(arr: Column) -> Column:
    """[P25] The even elements."""
    return F.filter(arr, lambda x: x % 2 == 0)


def pair_map(keys: Column, values: Column) -> Column:
    """[X25] Two lists as a map."""
    return F.map_from_arrays(keys, values)


def pairs(keys: Column, values: Column) -> Column:
    """[X25] Two lists as an array of pairs."""
    return F.arrays_zip(keys.alias("key"), values.alias("value"))


def merge_maps(left: Column, right: Column) -> Column:
    """[X25] Two maps as one; the right value wins. Needs no session setting."""
    kept = F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def flat_sorted(nested: Column) -> Column:
    """[X25] An array of arrays flattened and sorted."""
    return F.array_sort(F.flatten(nested))

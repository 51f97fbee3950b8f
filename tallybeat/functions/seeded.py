"""Random-looking columns that depend on a seed and on the row's own key only.

A value is a function of ``md5(seed | parts)``. It is the same in any partitioning, on
any retry after a lost executor and in any engine with md5; ``rand()`` is none of these.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 1 << 32  # a draw is 32 bits of the digest


def digest(seed: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[part.cast("string") for part in parts]))


def draw(seed: str, *parts: Column) -> Column:
    """Whole number in [0, 2**32)."""
    return F.conv(F.substring(digest(seed, *parts), 1, 8), 16, 10).cast("bigint")


def long_draw(seed: str, *parts: Column) -> Column:
    """Whole number in [0, 2**60), for ranges that 32 bits do not cover."""
    return F.conv(F.substring(digest(seed, *parts), 1, 15), 16, 10).cast("bigint")


def whole(seed: str, low: int, high: int, *parts: Column) -> Column:
    """Whole number in [low, high]."""
    return F.lit(low) + F.pmod(draw(seed, *parts), F.lit(high - low + 1))


def uniform(seed: str, *parts: Column) -> Column:
    """Double in [0, 1)."""
    return draw(seed, *parts) / F.lit(float(WORD))


def choice(seed: str, values: list[str], *parts: Column) -> Column:
    """One of ``values``, all equally likely."""
    return F.element_at(_texts(values), whole(seed, 1, len(values), *parts).cast("int"))


def weighted_choice(seed: str, weights: dict[str, int], *parts: Column) -> Column:
    """One of the keys of ``weights``: each fills as many slots of an array as it weighs."""
    slots = [value for value, weight in weights.items() for _ in range(weight)]
    return choice(seed, slots, *parts)


def distinct_choices(seed: str, values: list[str], size: Column, *parts: Column) -> Column:
    """Array of ``size`` different values: the first ones in the order of their digest."""
    keyed = F.transform(
        _texts(values),
        lambda value: F.struct(digest(seed, *parts, value).alias("d"), value.alias("v")),
    )
    return F.transform(F.slice(F.array_sort(keyed), F.lit(1), size.cast("int")), lambda x: x["v"])


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def distinct_numbers(seed: str, size: Column, total: Column, *parts: Column) -> Column:
    """Array of ``size`` different numbers in [1, total], every such set equally likely; all if fewer.

    Floyd's sampling: number i of the draw lies in [1, total - size + i]; if it was drawn before, the
    upper bound, which cannot have been, takes its place. No other candidate is made, so the
    cost per row is that of the set, however large ``total`` is. ``size`` and each number are drawn
    once, bound to a variable: an expression named twice within a lambda is computed twice.
    """

    def numbers(wanted: Column) -> Column:
        below = total - wanted
        places = F.sequence(F.lit(1).cast("bigint"), wanted)
        drawn = F.transform(places, lambda i: F.pmod(long_draw(seed, *parts, i), below + i) + 1)

        def step(chosen: Column, x: Column) -> Column:
            return F.array_append(chosen, F.when(F.array_contains(chosen, x), below + F.size(chosen) + 1).otherwise(x))

        return F.when(wanted > 0, F.aggregate(drawn, none, step)).otherwise(none)

    none = F.array().cast("array<bigint>")
    return bound(F.least(size, total).cast("bigint"), numbers)


def day_between(seed: str, first: str, last: str, *parts: Column) -> Column:
    """Date in [first, last]."""
    begin = F.to_date(F.lit(first))
    span = F.datediff(F.to_date(F.lit(last)), begin) + 1
    return F.date_add(begin, F.pmod(draw(seed, *parts), span).cast("int"))


def seasonality(month: Column) -> Column:
    """Yearly wave around 1 with an amplitude of 0.3."""
    return F.lit(1.0) + F.lit(0.3) * F.sin(F.lit(2 * math.pi) * month / F.lit(12))


def pareto(seed: str, shape: float, *parts: Column) -> Column:
    """Pareto (Lomax) draw by its inverse distribution function."""
    return F.pow(F.lit(1.0) - uniform(seed, *parts), F.lit(-1.0 / shape)) - F.lit(1.0)


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])

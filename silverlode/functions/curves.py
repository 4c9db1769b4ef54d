"""Space-filling curves: one sort key that keeps rows near in several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def place(bounds: Sequence, value: Column) -> Column:
    """How many of the ascending ``bounds`` are at or below ``value``, by bisection; 0 for null."""
    if not len(bounds):
        return F.lit(0)
    steps = F.array(*[F.lit(b) for b in bounds])

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        upper = F.struct((middle + 1).alias("low"), at["high"].alias("high"))
        lower = F.struct(at["low"].alias("low"), middle.alias("high"))
        nearer = F.when(F.get(steps, middle) <= value, upper).otherwise(lower)
        return F.when(at["low"] < at["high"], nearer).otherwise(at)

    rounds = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high")), halve, lambda at: at["low"])


def interleaved(places: Sequence[Column], bits: int) -> Column:
    """The Z-curve's value: the places' bits in turn, the highest first.  ``bits`` times the places fit 62."""
    if bits * len(places) > 62:
        raise ValueError("too many bits for one number")
    value = F.lit(0).cast("long")
    for b in range(bits):
        for i, p in enumerate(places):
            bit = F.shiftright(p.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            value = value.bitwiseOR(F.shiftleft(bit, b * len(places) + len(places) - 1 - i))
    return value

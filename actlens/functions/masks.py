"""Distinct counts over small domains as bit masks: a long holds a bit per value,
partial masks are merged by ``bit_or``, and a plain hash aggregate does the rest."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values per long.
BITS = 63


def masks(column: str, domain: Sequence) -> dict[str, Column]:
    """Name and aggregate of each mask: which values of ``domain`` a group holds.  A value's
    code is its place in the domain; nulls and values outside the domain set no bit."""
    out = {}
    for start in range(0, len(domain), BITS):
        place = F.array_position(F.array(*[F.lit(v) for v in domain[start:start + BITS]]), F.col(column))
        bit = F.when(place > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int")))
        out[f"_mask{start // BITS}"] = F.bit_or(bit)
    return out


def count_bits(names: Iterable[str]) -> Column:
    """Distinct values in merged masks (0 for none)."""
    total = F.lit(0)
    for c in names:
        total = total + F.coalesce(F.bit_count(c), F.lit(0))
    return total.cast("long")

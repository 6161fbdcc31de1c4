"""Means of readings that do not depend on the order of the rows, hence not on partitioning or retried tasks.

A sum of doubles rounds at every step, so it changes with the order. Here each reading is cut into limbs, whole numbers of
31 or 32 bits, each limb is summed as an integer, and what the sums make together is rounded once, to the nearest double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridpulse.functions.expressions import let

# Finite readings below this size are summed exactly, down to multiples of 2**-96; a reading of 1e-13 or more has no finer
# bits, and finer bits of smaller ones are cut off. No meter sends as much as this: such readings, NaN and the infinities are
# added as doubles, so they act as they do in ``avg``.
LIMIT = float(2**62)
_LIMB = float(2**32)
_LOW_31 = 2**31 - 1
_LOW_32 = 2**32 - 1

#: Sums of a mean, by suffix: readings beyond LIMIT, limbs from 2**31 down to 2**-96, and the number of readings.
EXACT_PARTS = ("rest", "high", "low", "f1", "f2", "f3", "n")
#: Those of readings in whole units have no fraction.
FIXED_PARTS = ("rest", "high", "low", "n")


def parts_of(decimals: int | None) -> tuple[str, ...]:
    return EXACT_PARTS if decimals is None else FIXED_PARTS


def sums(x: Column, decimals: int | None = None) -> dict[str, Column]:
    """The aggregates that a mean of ``x`` is made of. ``decimals`` rounds readings to units of that many decimals first."""
    units = x if decimals is None else F.rint(x * F.lit(float(10**decimals)))
    small = F.abs(units) < F.lit(LIMIT)
    whole = F.when(small, units).cast("bigint")
    found = {
        "rest": F.sum(F.when(~small, x)),
        "high": F.sum(F.shiftright(whole, 31)),
        "low": F.sum(whole.bitwiseAND(F.lit(_LOW_31).cast("bigint"))),
    }
    left = F.when(small, units) - whole.cast("double")
    for name in ("f1", "f2", "f3") if decimals is None else ():
        left = left * F.lit(_LIMB)  # powers of two and what a cast cuts off are exact
        limb = left.cast("bigint")
        found[name] = F.sum(limb)
        left = left - limb.cast("double")
    return found | {"n": F.count(x)}


def _wide(x: Column | int) -> Column:
    return F.lit(Decimal(x)).cast("decimal(38,0)") if isinstance(x, int) else x.cast("decimal(38,0)")


def total(parts: dict[str, Column]) -> Column:
    """The double nearest to the sum of the limbs; null without readings."""

    def carried(limbs: Column) -> Column:
        """Fractions between 0 and 1, the whole number as a decimal."""
        f3 = limbs["f3"]
        f2 = limbs["f2"] + F.shiftright(f3, 32)
        f1 = limbs["f1"] + F.shiftright(f2, 32)
        low = _wide(limbs["low"]) + _wide(F.shiftright(f1, 32))
        bits = lambda f: _wide(f.bitwiseAND(F.lit(_LOW_32)))
        whole = _wide(limbs["high"]) * _wide(2**31) + low
        return F.struct(whole.cast("decimal(38,0)").alias("whole"), (bits(f1) * _wide(2**32) + bits(f2)).cast("decimal(38,0)").alias("f12"), bits(f3).alias("f3"))

    def rounded(s: Column) -> Column:
        """A last bit that only says whether anything follows is enough to round right, where more than 54 bits stand before it."""
        whole, f12, f3 = s["whole"], s["f12"], s["f3"]
        fine = (whole * _wide(2**64) + f12).cast("decimal(38,0)")
        more = lambda some: F.when(some, _wide(1)).otherwise(_wide(0))
        nearest = lambda d, exponent: d.cast("decimal(38,0)").cast("double") * F.lit(2.0**exponent)
        # Some of the products hold in one of the cases only, and are made there only.
        large = nearest(whole * _wide(2) + more((f12 > 0) | (f3 > 0)), -1)
        small = lambda n: F.when(F.abs(n) < _wide(2**56), nearest(n * _wide(2**32) + f3, -96)).otherwise(nearest(n * _wide(2) + more(f3 > 0), -65))
        return F.when(F.abs(whole) >= _wide(2**58), large).otherwise(let(fine, small))

    if "f1" in parts:
        limbs = F.struct(*(parts[p].alias(p) for p in ("high", "low", "f1", "f2", "f3")))
        exact = F.when(parts["high"].isNotNull(), let(let(limbs, carried), rounded))
    else:
        exact = (_wide(parts["high"]) * _wide(2**31) + _wide(parts["low"])).cast("decimal(38,0)").cast("double")
    return exact


def mean(parts: dict[str, Column], decimals: int | None = None) -> Column:
    """The mean from its summed parts; null without readings."""
    exact = total(parts)
    if decimals is not None:
        exact = exact / F.lit(float(10**decimals))
    return F.coalesce(parts["rest"] + F.coalesce(exact, F.lit(0.0)), exact) / parts["n"]


def exact_mean(x: Column) -> Column:
    """The sum of doubles, rounded once, by their number. Nulls are skipped."""
    return mean(sums(x))


def fixed_point_mean(x: Column, decimals: int) -> Column:
    """The same for readings that hold at most ``decimals`` decimals, whose decimal values are summed instead of the doubles nearest to them."""
    return mean(sums(x, decimals), decimals)

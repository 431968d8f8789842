"""Rounding, and means that do not depend on the order of summation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# half_up and half_even decide by the shortest decimal that reads as the double, half_even_binary by the
# double's own value: 2.675 is a little less than it is written, and so no tie.
ROUNDINGS = ("half_up", "half_even", "half_even_binary")

# Splits a double into two halves of its bits.
_SPLIT = 2.0**27 + 1


def round_to(value: Column, decimals: int, mode: str = "half_up") -> Column:
    if mode not in ROUNDINGS:
        raise ValueError(f"unknown rounding {mode!r}")
    if mode == "half_even_binary":
        return round_binary(value, decimals)
    return F.round(value, decimals) if mode == "half_up" else F.bround(value, decimals)


def round_binary(value: Column, decimals: int) -> Column:
    """Half-even on the exact value of a double, as double: the nearest double to the nearest decimal.

    The product with the power of ten is taken as the double nearest to it and the rest, which products of halves give
    exactly, so a tie is seen as one and nothing else is. From 2**53 units on a double is its own nearest decimal.
    NULL, NaN and infinities stay as they are.
    """
    if not 0 <= decimals <= 22:
        raise ValueError("rounding to 0 to 22 decimals only")
    unit = 10.0**decimals
    unit_high = unit * _SPLIT - (unit * _SPLIT - unit)
    unit_low = unit - unit_high
    size = F.abs(value.cast("double"))
    high = size * _SPLIT - (size * _SPLIT - size)
    low = size - high
    near = size * unit
    rest = ((high * unit_high - near) + high * unit_low + low * unit_high) + low * unit_low
    whole = F.floor(near).cast("double")
    beyond = near - whole
    odd = F.pmod(whole, F.lit(2.0)) == 1
    above = (beyond - 0.5) + rest
    up = (above > 0) | ((above == 0) & odd)
    down = (beyond + rest == -0.5) & odd
    rounded = F.when(up, whole + 1).when(down, whole - 1).otherwise(whole) / unit
    return F.when(near < 2.0**53, rounded * F.signum(value.cast("double"))).otherwise(value.cast("double"))


def whole_units(value: Column, scale: int) -> Column:
    """Sum of ``value`` as a whole number of 10**-scale units; exact, so any task order agrees."""
    total = F.sum(value.cast(f"decimal(18,{scale})"))
    return (total * F.lit(10**scale).cast("decimal(10,0)")).cast("decimal(38,0)")


def divide_units(units: Column, count: Column, scale: int, decimals: int, mode: str = "half_up") -> Column:
    """``units / count`` rounded to ``decimals`` places in integer arithmetic, as double.

    Rounding the exact quotient once avoids both the float summation order and double rounding.
    """
    if mode not in ("half_up", "half_even"):
        raise ValueError(f"unknown rounding of an exact quotient {mode!r}")
    if decimals > scale:
        raise ValueError("an exact mean cannot have more decimals than its input")
    step = (count * F.lit(10 ** (scale - decimals))).cast("decimal(28,0)")
    size = F.abs(units)
    quotient = F.call_function("div", size, step)
    twice_rest = (size - quotient.cast("decimal(28,0)") * step) * 2
    up = twice_rest >= step if mode == "half_up" else (
        (twice_rest > step) | ((twice_rest == step) & (quotient % 2 == 1))
    )
    rounded = quotient + F.when(up, 1).otherwise(0)
    signed = F.when(units < 0, -rounded).otherwise(rounded)
    return signed.cast("double") / F.lit(float(10**decimals))

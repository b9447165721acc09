"""Numeric coercion, clipping and variation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_TEXT = r"(?i)^\s*[+]?inf(inity)?\s*$"
MINUS_INFINITY_TEXT = r"(?i)^\s*-inf(inity)?\s*$"

INFINITY = float("inf")


def to_number(value: Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes null.

    A bare ``try_cast`` accepts ``10d``, hence the guard.
    """
    text = value.cast("string")
    return (
        F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))
        .when(text.rlike(INFINITY_TEXT), F.lit(INFINITY))
        .when(text.rlike(MINUS_INFINITY_TEXT), F.lit(-INFINITY))
    )


def money(value: Column) -> Column:
    """Exact cents for sums, so that the result does not depend on task order."""
    return value.cast("decimal(19,2)")


#: From here on a double has no cents left, and an exact sum of any number of rows would not fit.
EXACT_BELOW = 1e21


def exact(value: Column) -> Column:
    """A finite amount with six places; null for what :func:`beyond` holds."""
    return F.when(F.abs(value) < EXACT_BELOW, value.cast("decimal(28,6)"))


def beyond(value: Column) -> Column:
    """Infinite amounts and those too large for :func:`exact`; NaN counts as missing, as null does."""
    return F.when((F.abs(value) >= EXACT_BELOW) & ~F.isnan(value), value.cast("double"))


def total(exact_sum: Column, beyond_sum: Column) -> Column:
    """The two sums as one number; null if neither had a value."""
    number = exact_sum.cast("double")
    return F.when(beyond_sum.isNull(), number).otherwise(beyond_sum + F.coalesce(number, F.lit(0.0)))


def money_sum(value: Column) -> Column:
    """Sum that does not depend on task order, loses no part of a cent and keeps infinity."""
    return total(F.sum(exact(value)), F.sum(beyond(value)))


def missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def clip(value: Column, low: float, high: float) -> Column:
    """Null stays null; ``least``/``greatest`` on their own would skip it."""
    return F.when(~missing(value), F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value)))


def floor_value(value: Column, minimum: float) -> Column:
    return F.when(~missing(value), F.greatest(value, F.lit(float(minimum))))


def net_flow(inflow: Column, redemption: Column) -> Column:
    return inflow - redemption


def ratio_change(current: Column, previous: Column, scale: float = 1.0) -> Column:
    """``(current / previous - 1) * scale``; x/0 is infinite, 0/0 is null."""
    change = F.when(previous != 0, current / F.when(previous != 0, previous) - 1).otherwise(
        F.when(current > 0, F.lit(INFINITY)).when(current < 0, F.lit(-INFINITY))
    )
    scaled = change if scale == 1.0 else change * F.lit(float(scale))
    return F.when(current.isNotNull() & previous.isNotNull(), scaled)


def right_closed_band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bands ``(e0, e1], (e1, e2], ...``; outside them, and for null, the result is null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    band = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > float(low)) & (value <= float(high))
        band = F.when(inside, F.lit(label)) if band is None else band.when(inside, F.lit(label))
    return band


def left_closed_band(value: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[0] < cuts[0] <= labels[1] < cuts[1] <= ...``; null stays null."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cuts")
    band = F.when(missing(value), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        band = band.when(value < float(cut), F.lit(label))
    return band.otherwise(F.lit(labels[-1]))

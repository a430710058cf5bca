"""Numbers: the error function, and text to number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the rational approximations of the error
# function published by W. J. Cody, Math. Comp. 23 (1969), lowest power first.
ERF_NEAR_NUM = (3.20937758913846947e03, 3.77485237685302021e02, 1.13864154151050156e02,
                3.16112374387056560e00, 1.85777706184603153e-1)
ERF_NEAR_DEN = (2.84423683343917062e03, 1.28261652607737228e03, 2.44024637934444173e02,
                2.36012909523441209e01, 1.0)
ERF_MID_NUM = (1.23033935479799725e03, 2.05107837782607147e03, 1.71204761263407058e03,
               8.81952221241769090e02, 2.98635138197400131e02, 6.61191906371416295e01,
               8.88314979438837594e00, 5.64188496988670089e-1, 2.15311535474403846e-8)
ERF_MID_DEN = (1.23033935480374942e03, 3.43936767414372164e03, 4.36261909014324716e03,
               3.29079923573345963e03, 1.62138957456669019e03, 5.37181101862009858e02,
               1.17693950891312499e02, 1.57449261107098347e01, 1.0)

# Accepted spellings of a number. Engines differ on what else they take ('1d',
# '1_0', '0x10'), so the shape is checked before the cast.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"


def polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    """Value at ``x``; coefficients run from the lowest power up."""
    high, *rest = reversed(coefficients)
    return reduce(lambda acc, c: acc * x + F.lit(c), rest, F.lit(high))


def erf(x: Column) -> Column:
    """Error function as a plain expression, good to about 1e-16.

    Beyond |x| = 4 the distance to 1 is below 2e-8, and from 6 on it is not
    representable; the middle form still holds there to far more than the
    six decimals reported.
    """
    y = F.abs(x)
    square = x * x
    near = x * polynomial(square, ERF_NEAR_NUM) / polynomial(square, ERF_NEAR_DEN)
    tail = F.exp(-square) * polynomial(y, ERF_MID_NUM) / polynomial(y, ERF_MID_DEN)
    return (
        F.when(y <= 0.46875, near)
        .when(y < 6.0, F.signum(x) * (F.lit(1.0) - tail))
        .otherwise(F.signum(x))
    )


def normal_within(sigmas: Column) -> Column:
    """Standard normal mass on [-s, s]; negative for negative s."""
    return erf(sigmas / F.sqrt(F.lit(2.0)))


def missing_if_nan(x: Column) -> Column:
    """NaN -> NULL, so that max, first and comparisons skip it."""
    return F.nanvl(x, F.lit(None).cast("double"))


def to_number(text: Column) -> Column:
    """Text -> DOUBLE, NULL when it is not a number, or one too large to hold that does not say so."""
    value = text.try_cast("double")
    overflow = (F.abs(value) == float("inf")) & ~text.rlike("[nN]")
    return F.when(text.rlike(NUMBER) & ~F.coalesce(overflow, F.lit(False)), value)

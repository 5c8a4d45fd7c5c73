"""Interval, probability and rounding functions on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Two-sided 95 % normal quantile of the stand-alone analysis, and the rounder one of city configurations.
Z95 = 1.959963984540054
Z_CITY = 1.96


def cube(x: Column) -> Column:
    return x * x * x


def floor_round(x: Column, places: int) -> Column:
    """Round half up by floor, the same in every engine."""
    scale = 10.0**places
    return F.floor(x * scale + 0.5) / scale


#: Factor by which a double is split into halves of 26 bits, and from where on doubles are whole.
_SPLITTER, _WHOLE = 134_217_729.0, 2.0**52


def even_round(x: Column, places: int) -> Column:
    """Round as Python's round() does: the exact binary value to the nearest, ties to even; `places` from 0 to 15.

    The product with the power of ten is taken without error, as a double and what it lacks, so that 2.675 is seen to lie under its tie.
    """
    scale = 10.0**places
    high = _SPLITTER * scale - (_SPLITTER * scale - scale)
    low = scale - high

    def rounded(v: Column) -> Column:
        upper = v * _SPLITTER - (v * _SPLITTER - v)
        lower = v - upper
        product = v * scale
        missing = ((upper * high - product) + upper * low + lower * high) + lower * low
        floor = F.floor(product).cast("double")
        beyond = (product - floor - 0.5) + missing  # the sign is that of the exact value against the tie
        even = F.when(floor % 2 == 0, floor).otherwise(floor + 1)
        out = F.when(beyond > 0, floor + 1).when(beyond < 0, floor).otherwise(even) / scale
        return F.when(F.isnan(v) | (F.abs(product) >= _WHOLE), v).when(out == 0, v * 0.0).otherwise(out)

    return F.transform(F.array(x.cast("double")), rounded)[0]


def byar_low(n: Column, z: float = Z95) -> Column:
    """Lower end of Byar's interval for a Poisson mean; 0 for no event."""
    low = n * cube(1.0 - 1.0 / (9.0 * n) - z / (3.0 * F.sqrt(n)))
    return F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), low))


def byar_high(n: Column, z: float = Z95) -> Column:
    m = n + 1
    return m * cube(1.0 - 1.0 / (9.0 * m) + z / (3.0 * F.sqrt(m)))


def widened(n: Column, end: Column, phi: Column) -> Column:
    """An interval end moved away from n by the root of the dispersion, if that is above 1; not below 0."""
    return F.when(phi > 1, F.greatest(F.lit(0.0), n + (end - n) * F.sqrt(phi))).otherwise(end)


def rate(n: Column, exposure: Column, per: float = 1000.0) -> Column:
    """Events per `per` units of exposure; null without a positive exposure."""
    return F.when(exposure > 0, n * (per / exposure))


def rate_low(n: Column, exposure: Column, per: float = 1000.0, z: float = Z95, phi: Column | None = None) -> Column:
    low = byar_low(n, z)
    return F.when(exposure > 0, (low if phi is None else widened(n, low, phi)) * (per / exposure))


def rate_high(n: Column, exposure: Column, per: float = 1000.0, z: float = Z95, phi: Column | None = None) -> Column:
    high = byar_high(n, z)
    return F.when(exposure > 0, (high if phi is None else widened(n, high, phi)) * (per / exposure))


def wilson(hits: Column, trials: Column, z: float = Z95) -> tuple[Column, Column]:
    """Wilson score interval; (0, 0) without a trial."""
    p = hits / trials
    base = 1.0 + z * z / trials
    centre = (p + z * z / (2.0 * trials)) / base
    half = z * F.sqrt(p * (1.0 - p) / trials + z * z / (4.0 * trials * trials)) / base
    return (
        F.when(trials <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), centre - half)),
        F.when(trials <= 0, 0.0).otherwise(F.least(F.lit(1.0), centre + half)),
    )


#: Rational Chebyshev approximations of the error function by W. J. Cody (1969), greatest powers first:
#: x * A(x^2) / B(x^2) for erf up to 0.46875; exp(-x^2) * C(x) / D(x) for erfc up to 4; P and Q in 1 / x^2 beyond.
ERF_A = (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3)
ERF_B = (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3)
ERFC_C = (
    2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2,
    8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3,
)
ERFC_D = (
    1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
    3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3,
)
ERFC_P = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4)
ERFC_Q = (1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3)


def _horner(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, to double precision.

    The argument stands some forty times in the formula, so it is bound to a variable and worked out once.
    """
    return F.transform(F.array(x), _erfc)[0]


def _erfc(x: Column) -> Column:
    low = 1.0 - x * _horner(ERF_A, x * x) / _horner(ERF_B, x * x)
    # The square is taken in two parts, one of them exact, so that its error is not multiplied.
    near = F.floor(x * 16.0) / 16.0
    bell = F.exp(-near * near) * F.exp(-(x - near) * (x + near))
    z = 1.0 / (x * x)
    high = (1.0 / math.sqrt(math.pi) - z * _horner(ERFC_P, z) / _horner(ERFC_Q, z)) / x
    return F.when(x <= 0.46875, low).when(x <= 4.0, bell * _horner(ERFC_C, x) / _horner(ERFC_D, x)).otherwise(bell * high)


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p-value."""
    return erfc(F.abs(z) / 2**0.5)


def laplace_noise(u: Column, scale: float) -> Column:
    """Laplace noise from a uniform number in (-0.5, 0.5), by the inverse distribution function."""
    return -scale * F.signum(u) * F.log1p(-2.0 * F.abs(u))



"""Radiative quantities of one record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridframe.functions.arrays import _col, cast_to, level_diff

# Gravity (m s-2), specific heat of air (J kg-1 K-1), seconds per day.
GRAVITY = 9.80665
SPECIFIC_HEAT = 1004.0
DAY = 86400.0


def net_flux(down, up) -> Column:
    """Downward minus upward flux per half level."""
    return F.zip_with(_col(down), _col(up), lambda d, u: d - u)


def heating_rate(down, up, pressure) -> Column:
    """Kelvin per day of each layer; null where two half levels have the same pressure."""
    flux = level_diff(net_flux(cast_to(down, "double"), cast_to(up, "double")))
    step = level_diff(cast_to(pressure, "double"))
    scale = -GRAVITY / SPECIFIC_HEAT * DAY
    return F.zip_with(flux, step, lambda f, p: F.lit(scale) * F.try_divide(f, p))


def silu(value) -> Column:
    """v * sigmoid(v) of a scalar column."""
    value = _col(value)
    return value / (F.lit(1.0) + F.exp(-value))

"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From here on a double has no digit after the decimal point worth rounding.
_WHOLE = 1e15


def round_numeric(value: Column, digits: int) -> Column:
    """Round a double by way of decimal, half away from zero, as a numeric column would.

    The cast to 12 decimals also absorbs the noise that the order of a floating-point sum leaves.
    NaN and values too large for the decimal pass through unchanged.
    """
    value = value.cast("double")
    rounded = F.round(value.cast("decimal(38,12)"), digits).cast("double")
    return F.when(F.isnan(value) | (F.abs(value) >= _WHOLE), value).otherwise(rounded)

"""Numeric helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtally.schemas import PRICE


def ratio2(a: Column, b: Column) -> Column:
    """``a / b`` of two counts, two decimals, half up, exact; NULL when ``b`` is zero."""
    a, b = a.cast("bigint"), F.nullif(b.cast("bigint"), F.lit(0))
    hundredths = F.call_function("div", F.lit(200) * a + b, F.lit(2) * b)
    return hundredths.cast("double") / F.lit(100.0)


def price_or_zero(text: Column) -> Column:
    """Decimal price of a text; missing, blank or unreadable text is zero."""
    return F.coalesce(text.try_cast(PRICE), F.lit(0).cast(PRICE))


def int_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def log_density(x: Column, mean: Column, variance: Column) -> Column:
    """Logarithm of the Gaussian density; NULL when the variance is zero."""
    v = F.nullif(variance, F.lit(0.0))
    return -F.pow(x - mean, F.lit(2.0)) / (2 * v) - F.log(2 * math.pi * v) / 2

"""Calendar and seasonal columns of a date."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcast.constants import FOURIER_HARMONICS, FOURIER_PERIODS


def calendar_columns(date):
    """Monday-based weekday, ISO week, month, weekend flag and day of month."""
    return {
        "day_of_week": F.weekday(date),
        "week_of_year": F.weekofyear(date),
        "month": F.month(date),
        "is_weekend": (F.weekday(date) >= 5).cast("int"),
        "day_of_month": F.dayofmonth(date),
    }


def as_day(value):
    """A day given as a value or as a column."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def fourier_columns(day_number, periods=FOURIER_PERIODS, harmonics=FOURIER_HARMONICS):
    """Sine and cosine of each harmonic of each period, for a day count."""
    columns = {}
    for period in periods:
        for k in harmonics:
            angle = F.lit(2 * math.pi * k) * day_number / F.lit(float(period))
            columns[f"sin_{period}d_h{k}"] = F.sin(angle)
            columns[f"cos_{period}d_h{k}"] = F.cos(angle)
    return columns

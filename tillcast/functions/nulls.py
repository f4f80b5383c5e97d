"""Null, NaN and division rules as column expressions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.constants import MIN_DENOMINATOR


def _known(column):
    return F.when(~F.isnan(column), column)


def nan_to_null(df):
    """Turn NaN into NULL in floating columns and arrays, so that averages and sums skip it."""
    floats = (T.DoubleType, T.FloatType)
    changed = {f.name: _known(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, floats)}
    changed |= {f.name: F.transform(f.name, _known) for f in df.schema.fields
                if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, floats)}
    return df.withColumns(changed) if changed else df


def join_keys(left, right, keys, how="inner"):
    """Join on keys of which NULL equals NULL; ``right`` holds each key once. Keys come from ``left``."""
    names = {k: f"_right_{k}" for k in keys}
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(right.withColumnsRenamed(names), on, how).drop(*names.values())


def non_negative(column):
    """Clip below at zero; NULL stays NULL (``greatest`` alone would turn it into 0)."""
    return F.when(column.isNotNull(), F.greatest(column, F.lit(0.0)))


def ratio(numerator, denominator):
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def floored_ratio(numerator, denominator):
    """Division by a non-negative total that may be zero."""
    return numerator / F.greatest(denominator, F.lit(MIN_DENOMINATOR))


def correlation(x, y, where=None):
    """Pearson correlation as an aggregate; NULL where either side is constant.

    The built-in ``corr`` raises on zero variance in ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    if where is not None:
        both = both & where
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

"""Expressions over hour and history arrays; all run inside generated code."""

from pyspark.sql import functions as F

from tillcast.constants import CLOSE_HOUR, HOURS_PER_DAY, OPEN_HOUR, OPERATING_HOURS


def operating_slice(hours):
    """The operating hours of a 24-element array."""
    return F.slice(hours, OPEN_HOUR + 1, OPERATING_HOURS)


def mask_stockouts(sales, status):
    """Sales with NULL in the hours that were out of stock."""
    return F.zip_with(sales, status, lambda x, s: F.when(s == 1, F.lit(None)).otherwise(x))


def count_where(array, predicate):
    return F.size(F.filter(array, predicate))


def replace_operating(hours, operating):
    """A 24-element array whose operating hours come from ``operating``."""
    return F.concat(
        F.slice(hours, 1, OPEN_HOUR),
        operating,
        F.slice(hours, CLOSE_HOUR + 1, HOURS_PER_DAY - CLOSE_HOUR),
    )


def fill_stockouts(sales, status, imputed):
    """Observed sales in stock, the imputed value in stockout hours."""
    cells = F.arrays_zip(sales.alias("y"), status.alias("s"), imputed.alias("d"))
    return F.transform(cells, lambda c: F.when(c["s"] == 1, c["d"]).otherwise(c["y"]))


def array_sum(array):
    """Sum of the elements that are not NULL."""
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))


def array_mean(array):
    """Mean of a gap-free array; NULL when it is empty."""
    return F.try_divide(array_sum(array), F.size(array))


def _squared_deviations(array):
    """Sum of squared deviations; the mean rides in the state, so it is computed once."""
    state = F.struct(array_mean(array).alias("mean"), F.lit(0.0).alias("sum"))

    def add(a, x):
        gap = x - a["mean"]
        return F.struct(a["mean"].alias("mean"), (a["sum"] + gap * gap).alias("sum"))

    return F.aggregate(array, state, add, lambda a: a["sum"])


def array_std_pop(array):
    """Population standard deviation of a gap-free array."""
    return F.sqrt(F.try_divide(_squared_deviations(array), F.size(array)))


def array_std_samp(array):
    """Sample standard deviation of a gap-free array; NULL below two elements."""
    return F.sqrt(F.try_divide(_squared_deviations(array), F.size(array) - 1))


def last(array, n):
    """The last ``n`` elements, or the whole array if it is shorter."""
    return F.slice(array, F.greatest(F.size(array) - n, F.lit(0)) + 1, F.lit(n))


def pad_left(array, length, filler):
    """Put ``filler`` in front until the array has ``length`` elements."""
    return F.concat(F.array_repeat(filler, F.greatest(F.lit(length) - F.size(array), F.lit(0))), array)


def array_median(array):
    """Interpolating median of a gap-free array."""
    ordered, n = F.array_sort(array), F.size(array)
    low = F.element_at(ordered, F.floor((n + 1) / 2).cast("int"))
    high = F.element_at(ordered, F.floor((n + 2) / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)

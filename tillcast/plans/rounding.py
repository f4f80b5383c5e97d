"""Rounding of results, so that engines which add in another order agree."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_UNITS = 1e14   # scaled values up to here are whole numbers or halves far more finely than NEAR_TIE
NEAR_TIE = 0.05
WIDE = 8           # double columns from which on they are rounded together


def round_half_up(column, digits):
    """``F.round`` of a double, without its decimal arithmetic wherever a value lies clear of a tie.

    The scaled value is off by less than its own spacing, so away from a tie its nearest whole
    number is the one that decimal arithmetic finds; divided by a power of ten it is the double
    nearest to that decimal. Near ties, large numbers, NaN and NULL take ``F.round`` itself.
    """
    power = F.lit(float(10 ** digits))
    scaled = column * power
    whole = F.floor(scaled + F.lit(0.5))
    clear = (F.abs(scaled) < F.lit(MOST_UNITS)) & (F.abs(scaled - whole) < F.lit(0.5 - NEAR_TIE))
    return F.when(clear, whole / power).otherwise(F.round(column, digits))


def rounded(df, digits=6):
    """Round every double column; the sign of a zero is dropped.

    Many columns are rounded as one array: the generated code of a wide row then holds one
    such expression instead of one for each column, and stays small enough to be compiled.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if len(doubles) < WIDE:
        return df.select(*[(round_half_up(F.col(c), digits) + F.lit(0.0)).alias(c) if c in doubles else F.col(c) for c in df.columns])
    together = F.transform(F.array(*doubles), lambda x: round_half_up(x, digits) + F.lit(0.0))
    at = {c: i for i, c in enumerate(doubles)}
    rows = df.select(*[c for c in df.columns if c not in at], together.alias("_doubles"))
    return rows.select(*[F.get("_doubles", F.lit(at[c])).alias(c) if c in at else F.col(c) for c in df.columns])

import math

import pytest
from pyspark.sql import functions as F

from tillcast.plans.rounding import WIDE, round_half_up, rounded

VALUES = [0.0, -0.0, 0.0000005, -0.0000005, 1.0000005, 2.5, -2.5, 1e-9, -1e-9, 123456.7890125, -123456.7890125, 0.1 + 0.2, 1 / 3, 8.5e7 + 1 / 3,
          1e14 / 3, 1e300, 5e-324, math.nan, math.inf, -math.inf, None, *[n / 16 + 0.0000005 for n in range(40)], *[n / 7e5 for n in range(40)]]


@pytest.mark.parametrize("digits", [4, 6, 8])
def test_rounds_as_decimals_do(spark, digits):
    df = spark.createDataFrame([(v,) for v in VALUES], "x double")
    same = (F.round("x", digits) + F.lit(0.0)).eqNullSafe(round_half_up(F.col("x"), digits) + F.lit(0.0))
    assert df.filter(~same).collect() == []


def test_wide_rows_are_rounded_as_one_array(spark):
    names = [f"x{i}" for i in range(WIDE + 4)]
    df = spark.createDataFrame([(i, *[v] * len(names)) for i, v in enumerate(VALUES)], "id long, " + ", ".join(f"{n} double" for n in names))
    got = rounded(df)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    plain = df.select("id", *[(F.round(n, 6) + F.lit(0.0)).alias(n) for n in names])
    assert got.exceptAll(plain).count() == 0 and got.count() == len(VALUES)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("round(") < len(names)

"""Rolling-origin backtests with array forecasters."""

from pyspark.sql import functions as F

from tillcast.constants import BACKTEST_HORIZON, BACKTEST_INPUT, BACKTEST_STEP, BACKTEST_WINDOWS, DATE
from tillcast.functions.arrays import array_mean, array_median, last
from tillcast.functions.calendar import as_day


def forecaster_frame(df, target="sale_amount_pred", date=DATE):
    """Series name, day and value; missing values count as zero."""
    return df.select(F.col("series_id").alias("unique_id"), F.col(date).alias("ds"),
                     F.coalesce(F.col(target), F.lit(0.0)).alias("y"))


def rolling_inputs(frame, horizon=BACKTEST_HORIZON, windows=BACKTEST_WINDOWS, step=BACKTEST_STEP,
                   input_size=BACKTEST_INPUT, end=None):
    """Per series and cutoff the last ``input_size`` days up to the cutoff, oldest first.

    Days without a row are zero; a day has at most one row. The latest cutoff leaves
    ``horizon`` days before the panel's end, earlier ones follow every ``step`` days.
    Map-side aggregation keeps at most ``input_size`` entries per series and cutoff, so
    neither the shuffle nor a series' state grows with the length of the panel.
    """
    end = as_day(end) if end is not None else frame.select(F.max("ds")).scalar()
    dated = frame.withColumn("_end", end)
    entries = []
    for i in range(windows):
        cutoff = F.date_sub("_end", horizon + (windows - 1 - i) * step)
        age = F.datediff(cutoff, "ds")
        inside = (age >= 0) & (age < input_size)
        entries.append(F.struct(
            F.first(cutoff).alias("cutoff"),
            F.min("ds").alias("first_day"),
            F.collect_list(F.when(inside, F.struct((input_size - 1 - age).alias("slot"), "y"))).alias("known")))
    per_series = dated.groupBy("unique_id").agg(F.array(*entries).alias("_w"))
    rows = per_series.select("unique_id", F.inline("_w")).filter(F.col("first_day") <= F.col("cutoff"))
    known = F.map_from_entries("known")
    slots = F.sequence(F.lit(0), F.lit(input_size - 1))
    return rows.withColumn("_known", known).select("unique_id", "cutoff", F.transform(
        slots, lambda i: F.coalesce(F.col("_known")[i], F.lit(0.0))).alias("inputs"))


def robust_scaled(inputs):
    """(centre, spread) of an input array: median and median absolute deviation, at least 1e-9."""
    centre = array_median(inputs)
    spread = array_median(F.transform(inputs, lambda x: F.abs(x - centre)))
    return centre, F.when(spread > 1e-9, spread).otherwise(1.0)


def seasonal_naive(inputs, h, season=7):
    """The value of the same day in the last season."""
    return F.element_at(inputs, (-season + F.pmod(h - 1, F.lit(season))).cast("int"))


def moving_average(inputs, h, rows=None):
    """The mean of the inputs, or of the last ``rows`` of them."""
    return array_mean(last(inputs, rows) if rows else inputs)


def drift(inputs, h):
    """The line through the first and last input, continued."""
    final, first = F.element_at(inputs, -1), F.element_at(inputs, 1)
    return final + h * (final - first) / (F.size(inputs) - 1)


FORECASTERS = {"seasonal_naive": seasonal_naive, "moving_average": moving_average, "drift": drift}


def forecast(inputs, methods, horizon=BACKTEST_HORIZON, scaled=False):
    """One row per series, cutoff and day ahead, with a column per method.

    ``methods`` maps a name to ``f(inputs, h) -> column``. With ``scaled`` the inputs
    are centred and scaled robustly first, and forecasts scaled back.
    """
    frame, series = inputs, F.col("inputs")
    centre, spread = F.lit(0.0), F.lit(1.0)
    if scaled:
        c, s = robust_scaled(series)
        frame = frame.withColumns({"_c": c, "_s": s})
        centre, spread = F.col("_c"), F.col("_s")
        frame = frame.withColumn("inputs", F.transform("inputs", lambda x: (x - F.col("_c")) / F.col("_s")))
    ahead = frame.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    ahead = ahead.withColumn("ds", F.date_add("cutoff", F.col("h")))
    columns = [(f(series, F.col("h")) * spread + centre).alias(n) for n, f in methods.items()]
    return ahead.select("unique_id", "cutoff", "ds", "h", *columns)


def forecast_with(inputs, function, schema):
    """Forecasts of a pandas function over batches of series; each batch is independent."""
    return inputs.mapInPandas(function, schema)


def align(df, forecasts, names, series="series_id", date=DATE):
    """Bring forecasts to the panel rows of their series and day; others get NULL."""
    keyed = forecasts.select(F.col("unique_id").alias(series), F.col("ds").alias(date), *names)
    return df.join(keyed, [series, date], "left")

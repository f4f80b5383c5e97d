"""Series features: lags, rolling statistics, scale, calendar and seasonality.

Every window has the same partitioning and order, so the planner uses one exchange,
one sort and one window node for all of them. All frames end at the previous row.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.constants import (
    DATE, LAGS, RATIO_OFFSET, SCALE_MIN_ROWS, SCALE_WINDOW, SERIES_KEYS, WINDOWS,
)
from tillcast.functions.calendar import as_day, calendar_columns, fourier_columns
from tillcast.functions.nulls import join_keys


def lag_columns(window, target="y_eff", lags=LAGS):
    return {f"lag_{k}": F.lag(target, k).over(window) for k in lags}


def rolling_columns(window, target="y_eff", windows=WINDOWS):
    means = {f"rolling_mean_{w}": F.avg(target).over(window.rowsBetween(-w, -1)) for w in windows}
    stds = {f"rolling_std_{w}": F.stddev_samp(target).over(window.rowsBetween(-w, -1)) for w in windows}
    return {**means, **stds}


def stockout_columns(window, ratio="stockout_ratio", windows=WINDOWS):
    return {f"stockout_ratio_{w}d": F.avg(ratio).over(window.rowsBetween(-w, -1)) for w in windows}


def scale_column(window, target="y_eff", rows=SCALE_WINDOW, min_rows=SCALE_MIN_ROWS):
    frame = window.rowsBetween(-rows, -1)
    enough = F.count(target).over(frame) >= min_rows
    return {"series_scale": F.when(enough, F.avg(target).over(frame))}


def series_columns(window, target="y_eff"):
    """All columns that look back along a series."""
    return {
        **lag_columns(window, target), **rolling_columns(window, target),
        **stockout_columns(window), **scale_column(window, target),
    }


def calendar_series_columns(window, target="y_eff"):
    """The look-back columns by days instead of rows, for panels with gaps.

    ``window`` must be ordered by the number of the day. ``lag_7`` is the value seven days
    before, NULL if there is no row; a mean over 28 days covers the rows of those days.
    """
    between = lambda first, last: window.rangeBetween(-first, -last)
    lags = {f"lag_{k}": F.max(target).over(between(k, k)) for k in LAGS}
    means = {f"rolling_mean_{w}": F.avg(target).over(between(w, 1)) for w in WINDOWS}
    stds = {f"rolling_std_{w}": F.stddev_samp(target).over(between(w, 1)) for w in WINDOWS}
    ratios = {f"stockout_ratio_{w}d": F.avg("stockout_ratio").over(between(w, 1)) for w in WINDOWS}
    scale = between(SCALE_WINDOW, 1)
    enough = F.count(target).over(scale) >= SCALE_MIN_ROWS
    return {**lags, **means, **stds, **ratios, "series_scale": F.when(enough, F.avg(target).over(scale))}


def add_calendar_features(df, columns=calendar_series_columns, keys=SERIES_KEYS, date=DATE):
    """Look-back columns by calendar days; one row per series and day is expected."""
    window = Window.partitionBy(*keys).orderBy("_day")
    return df.withColumn("_day", F.unix_date(F.to_date(date))).withColumns(columns(window)).drop("_day")


def add_series_features(df, columns=series_columns, keys=SERIES_KEYS, date=DATE, chunk_rows=None):
    """Add look-back columns; ``columns`` maps a window to named expressions.

    A series is one window partition. That is fine for daily series, whose length the
    calendar bounds. ``chunk_rows`` splits longer series, see ``add_chunked``.
    """
    if chunk_rows:
        return add_chunked(df, columns, keys, date, chunk_rows)
    return df.withColumns(columns(Window.partitionBy(*keys).orderBy(date)))


def add_chunked(df, columns, keys, date, chunk_rows, lookback=SCALE_WINDOW, bucket_days=32):
    """The same columns when single series are too long for one task.

    Rows get their ordinal in the series from per-bucket counts; series are cut into
    chunks of ``chunk_rows`` ordinals, and each chunk also receives the ``lookback``
    rows before it. The frames reach back at most that far, so the result is exact.
    """
    if chunk_rows < lookback:
        raise ValueError("a chunk must be at least as long as the look-back")
    keys = list(keys)
    bucket = F.floor(F.unix_date(F.to_date(date)) / bucket_days)
    rows = df.withColumn("_bucket", bucket)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n")).select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(date)
    numbered = join_keys(rows, offsets, [*keys, "_bucket"]).withColumn(
        "_ordinal", F.col("_offset") + F.row_number().over(inside) - 1)
    chunk = F.floor(F.col("_ordinal") / chunk_rows)
    is_tail = F.col("_ordinal") % chunk_rows >= chunk_rows - lookback
    spread = numbered.withColumn("_home", chunk).withColumn(
        "_chunk", F.explode(F.when(is_tail, F.array(F.col("_home"), F.col("_home") + 1))
                            .otherwise(F.array("_home"))))
    window = Window.partitionBy(*keys, "_chunk").orderBy("_ordinal")
    helpers = ["_bucket", "_offset", "_ordinal", "_home", "_chunk"]
    return spread.withColumns(columns(window)).filter(F.col("_chunk") == F.col("_home")).drop(*helpers)


def add_calendar(df, date=DATE):
    return df.withColumns(calendar_columns(F.col(date)))


def add_fourier(df, anchor=None, date=DATE):
    """Seasonal terms of the days since ``anchor``, by default the first panel day."""
    start = as_day(anchor) if anchor is not None else df.select(F.min(date)).scalar()
    numbered = df.withColumn("_t", F.datediff(F.col(date), start))
    return numbered.withColumns(fourier_columns(F.col("_t"))).drop("_t")


def add_recovery_columns(df):
    """Recovered against observed demand; not model features."""
    return df.withColumns({
        "demand_ratio": F.col("sale_amount_pred") / (F.col("sale_amount") + F.lit(RATIO_OFFSET)),
        "demand_gap": F.col("sale_amount_pred") - F.col("sale_amount"),
    })


def build_features(df, anchor=None, chunk_rows=None):
    """All features except the target encodings, which need a fitted split.

    Calendar columns come after the window node, so they are not shuffled or sorted.
    """
    return add_fourier(add_calendar(add_series_features(df, chunk_rows=chunk_rows)), anchor)

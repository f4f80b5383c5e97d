"""Hourly vectors of the daily panel: masking, windows, covariates, sequences."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.constants import (
    COVARIATE_OFFSET, DATE, HOURLY_COVARIATES, OPERATING_HOURS, SERIES_KEYS, WINDOW_DAYS,
)
from tillcast.functions.arrays import count_where, mask_stockouts, operating_slice


def add_masked_hours(df):
    """Operating-hour sales (``open_sale``), status (``open_status``) and sales with
    stockout hours as NULL (``masked``), each an array of 16."""
    return df.withColumns({
        "open_sale": operating_slice(F.col("hours_sale")),
        "open_status": operating_slice(F.col("hours_stock_status")),
    }).withColumn("masked", mask_stockouts(F.col("open_sale"), F.col("open_status")))


def masked_share(df):
    """Masked cells, all cells and the percentage."""
    masked = F.sum(count_where(F.col("masked"), lambda x: x.isNull()))
    total = F.sum(F.size("masked"))
    return df.agg(masked.alias("n_masked"), total.alias("n_total"),
                  (F.try_divide(masked.cast("double"), total) * 100).alias("masked_pct"))


def add_window_index(df, window_days=WINDOW_DAYS, keys=SERIES_KEYS, date=DATE):
    """Number the windows of ``window_days`` rows of each series, and the days in them."""
    ordinal = F.row_number().over(Window.partitionBy(*keys).orderBy(date)) - 1
    return df.withColumn("_ordinal", ordinal).withColumns({
        "window_idx": F.floor(F.col("_ordinal") / window_days).cast("int"),
        "day_in_window": (F.col("_ordinal") % window_days).cast("int"),
    }).drop("_ordinal")


def normalize_covariates(df, columns=HOURLY_COVARIATES, keys=SERIES_KEYS):
    """Covariates relative to their largest value in the window.

    Runs on daily rows, before hours are exploded: a sixteenth of the rows, and the
    same partitioning as the window index.
    """
    window = Window.partitionBy(*keys, "window_idx")
    return df.withColumns({
        f"{c}_norm": F.col(c) / (F.max(c).over(window) + F.lit(COVARIATE_OFFSET)) for c in columns})


def hour_position(hour_idx):
    return hour_idx / F.lit(float(OPERATING_HOURS - 1))


def hourly_cells(df, columns=HOURLY_COVARIATES, keys=SERIES_KEYS, date=DATE, extra=()):
    """One row per operating hour with the masked sale, covariates and hour position."""
    covariates = [f"{c}_norm" for c in columns]
    cells = df.select(*keys, date, "window_idx", "day_in_window", *covariates, *extra,
                      F.posexplode("masked").alias("hour_idx", "sale"))
    return cells.withColumn("hour_pos", hour_position(F.col("hour_idx")))


def window_sequences(df, columns=HOURLY_COVARIATES, keys=SERIES_KEYS):
    """Per window the steps in time order, each an array (sale, covariates, hour position).

    A group holds one window, so at most ``window_days`` daily rows.
    """
    covariates = [F.col(f"{c}_norm").cast("double") for c in columns]
    day = F.transform("masked", lambda sale, h: F.array(sale, *covariates, hour_position(h)))
    days = F.array_sort(F.collect_list(F.struct("day_in_window", day.alias("steps"))))
    return df.groupBy(*keys, "window_idx").agg(days.alias("_days")).select(
        *keys, "window_idx", F.flatten(F.transform("_days", lambda d: d["steps"])).alias("steps"))

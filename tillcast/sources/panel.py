"""Reading the daily panel, its checks, and zero-filling."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.constants import DATE, HORIZON_DAYS, HOURS_PER_DAY, OPERATING_HOURS, SERIES_KEYS
from tillcast.functions.nulls import nan_to_null
from tillcast.schemas import PANEL, RECOVERED_PANEL, require_columns

DAYS_OF_BITS = 63


def ingest(df, date=DATE):
    """Day-typed date, NaN as NULL."""
    return nan_to_null(df).withColumn(date, F.to_date(date))


def conform(df, schema=PANEL):
    """The columns of ``schema`` in its types; columns beyond it follow as they are.

    Files may hold days as text or timestamps and flags in other integer types.
    """
    require_columns(df, schema.names)
    cast = {f.name: F.to_date(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name).cast(f.dataType)
            for f in schema.fields}
    return df.withColumns(cast).select(*schema.names, *[c for c in df.columns if c not in schema.names])


def read_panel(spark, path, schema=PANEL):
    """A parquet panel in the file's own types, cast to ``schema``."""
    return ingest(conform(spark.read.parquet(path), schema))


def read_first(spark, candidates, schema=None):
    """The first readable parquet path of an ordered list."""
    for path in candidates:
        try:
            found = spark.read.parquet(path)
            return ingest(conform(found, schema) if schema is not None else found)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    raise FileNotFoundError(f"none of {list(candidates)} holds a panel")


def read_recovered(spark, candidates):
    """The recovered panel from the first path that has one."""
    panel = read_first(spark, candidates)
    return require_columns(panel, ["sale_amount_pred"])


def read_splits(spark, base, schema=PANEL):
    """Training panel and evaluation panel (``eval``, else ``validation``, else None)."""
    train = read_panel(spark, f"{base}/train", schema)
    try:
        held_out = read_first(spark, [f"{base}/eval", f"{base}/validation"], schema)
    except FileNotFoundError:
        held_out = None
    return train, held_out


def with_series_columns(df, target="sale_amount_pred"):
    """Series name, stockout columns and the effective demand of a daily panel."""
    hours = F.col("stock_hour6_22_cnt")
    return df.withColumns({
        "series_id": F.concat_ws("__", *[F.col(k).cast("string") for k in SERIES_KEYS]),
        "is_stockout": (hours > 0).cast("int"),
        "stockout_ratio": hours / F.lit(float(OPERATING_HOURS)),
        "stockout_hours": hours,
        "y_eff": F.col(target),
    })


def series_density(df, keys=SERIES_KEYS, date=DATE, horizon=None):
    """Rows, first and last day, gaps and repeated days of each series.

    ``dense`` tells whether the days have no gap and no repeat and, if a horizon is
    given, whether there are exactly that many.
    """
    days = F.datediff("last_day", "first_day") + 1
    day = F.unix_date(F.col(date).cast("date"))
    # Days are counted as bits of numbers, one for each 63 days, so that no task keeps a series' days as rows.
    bits = df.groupBy(*keys, F.floor(day / F.lit(DAYS_OF_BITS)).alias("_span")).agg(
        F.count("*").alias("n_rows"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(DAYS_OF_BITS)))).alias("_bits"),
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
    )
    stats = bits.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).alias("n_days"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )
    dense = (F.col("n_rows") == F.col("n_days")) & (F.col("n_days") == days)
    if horizon is not None:
        dense = dense & (F.col("n_rows") == horizon)
    return stats.select(
        *keys, "n_rows", "first_day", "last_day",
        (days - F.col("n_days")).cast("long").alias("n_gaps"),
        (F.col("n_rows") - F.col("n_days")).alias("n_repeats"),
        dense.alias("dense"),
    )


def check_hour_arrays(df):
    """Rows whose hour arrays have a wrong length."""
    return df.filter(
        (F.size("hours_sale") != HOURS_PER_DAY) | (F.size("hours_stock_status") != HOURS_PER_DAY)
    )


def densify(df, attributes=(), keys=SERIES_KEYS, date=DATE, start=None, end=None, fill=0.0, values=("sale_amount",)):
    """One row per series and day of [start, end]; absent days get ``fill``.

    The bounds default to the panel's own. Each row brings the absent days between the
    row before it and itself, the last row of a series also those up to ``end``. So the
    grid is never shuffled, sorted or joined; only the panel's rows are, once by series.
    A series without rows in the bounds, or with a NULL key, which no row can equal, is
    nothing but filled days.
    """
    start = F.lit(start).cast("date") if start else df.select(F.min(date)).scalar()
    end = F.lit(end).cast("date") if end else df.select(F.max(date)).scalar()
    keys, attributes = list(keys), list(attributes)
    others = [c for c in df.columns if c not in (*keys, date, *attributes)]
    first, last = F.unix_date(start), F.unix_date(end)
    day = F.unix_date(F.col(date).cast("date"))
    fits = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, day.between(first, last))
    series = Window.partitionBy(*keys)
    along = series.orderBy("_day")
    marked = df.withColumn("_day", F.when(fits, day)).withColumns({
        "_before": F.lag("_day").over(along), "_last": F.lead(F.lit(1)).over(along).isNull(),
        **{a: F.first(a, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
           for a in attributes}})
    none = F.array().cast("array<int>")
    span = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(none)
    gap = F.when(F.col("_day").isNotNull(), F.concat(span(F.coalesce(F.col("_before") + 1, first), F.col("_day") - 1), F.array("_day"))) \
        .otherwise(none)
    rest = F.when(F.col("_last"), span(F.coalesce(F.col("_day") + 1, first), last)).otherwise(none)
    own = F.col("_grid") == F.col("_day")
    grid = marked.withColumn("_grid", F.explode(F.concat(gap, rest)))
    filled = {c: F.when(own, F.col(c)) for c in others}
    filled |= {v: F.coalesce(F.when(own, F.col(v)), F.lit(fill)) for v in values}
    return grid.select(*keys, F.date_from_unix_date("_grid").alias(date), *attributes, *[filled[c].alias(c) for c in others])


def union_all(frames):
    """Append frames by column name; a column absent from one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def assert_dense(df, horizon=HORIZON_DAYS):
    """Raise when a series is not ``horizon`` gap-free days (one small result)."""
    bad = series_density(df, horizon=horizon).filter(~F.col("dense")).limit(5).collect()
    if bad:
        raise ValueError(f"series without {horizon} consecutive days, for example {bad}")
    return df


__all__ = [
    "RECOVERED_PANEL", "assert_dense", "check_hour_arrays", "conform", "densify", "ingest", "read_first",
    "read_panel", "read_recovered", "read_splits", "series_density", "union_all", "with_series_columns",
]

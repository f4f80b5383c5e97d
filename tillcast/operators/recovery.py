"""Demand recovery: imputers for stockout hours, their ensemble, and the daily sum.

Imputed hours are arrays of 16 in the daily row; nothing here explodes to hourly rows.
"""

from pyspark.sql import functions as F

from tillcast.constants import DATE, HOURLY_COVARIATES, OPERATING_HOURS, SERIES_KEYS
from tillcast.functions.arrays import array_sum, fill_stockouts, replace_operating
from tillcast.functions.nulls import floored_ratio, join_keys, non_negative
from tillcast.operators.hourly import hour_position

HOURS = range(OPERATING_HOURS)


def _sums(array, name):
    """Element-wise sum over the rows of a group."""
    return F.array(*[F.sum(F.get(array, F.lit(h))) for h in HOURS]).alias(name)


def _counts(array, name):
    """Element-wise count of values over the rows of a group."""
    return F.array(*[F.count(F.get(array, F.lit(h))) for h in HOURS]).alias(name)


def _mean(totals, counts):
    return F.zip_with(totals, counts, lambda t, n: F.try_divide(t, n))


def _first_known(preferred, fallback):
    """Hour by hour the preferred value, or the fallback where there is none."""
    return F.zip_with(preferred, fallback, lambda p, f: F.coalesce(p, f))


def add_profile_imputations(df, keys=SERIES_KEYS, date=DATE, masked="masked"):
    """Two imputations per row from mean sales profiles of the observed hours.

    ``imputed_weekday`` takes the series' mean for that weekday and hour, and where none
    was observed the series' hour, the store's hour, the hour overall. ``imputed_hour``
    starts at the series' hour. All levels roll up from one aggregation, whose map side
    reduces a series to at most seven rows before the shuffle. The daily rows themselves
    move at most once, to meet the profile of their series.
    """
    keys, store = list(keys), keys[0]
    rows = df.withColumn("_dow", F.weekday(date))
    weekday = rows.groupBy(*keys, "_dow").agg(_sums(masked, "t"), _counts(masked, "n"))
    series = weekday.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_dow", _mean("t", "n")))).alias("_weekdays"),
        _sums("t", "t"), _sums("n", "n"))
    stores = series.groupBy(store).agg(_sums("t", "store_t"), _sums("n", "store_n"))
    overall = stores.agg(_sums("store_t", "t"), _sums("store_n", "n")).select(_mean("t", "n")).scalar()
    none_known = F.array_repeat(F.lit(0.0), OPERATING_HOURS)
    profiles = (
        join_keys(series, stores, [store]).withColumn("_all", overall)
        .withColumn("_store", _first_known(_mean("store_t", "store_n"), _first_known("_all", none_known)))
        .select(*keys, "_weekdays", _first_known(_mean("t", "n"), "_store").alias("imputed_hour"))
    )
    joined = join_keys(rows, profiles, keys)
    weekday_mean = F.col("_weekdays")[F.col("_dow")]
    return joined.withColumn("imputed_weekday", _first_known(weekday_mean, "imputed_hour")).drop(
        "_dow", "_weekdays")


def clip_imputed(imputed):
    """Negative imputed sales become zero."""
    return F.transform(imputed, non_negative)


def recover(df, imputed="imputed_weekday", mode="masked", output="sale_amount_pred"):
    """Daily recovered demand from imputed operating hours.

    ``masked`` replaces stockout hours only; ``direct`` replaces every operating hour.
    """
    values = clip_imputed(F.col(imputed))
    if mode == "masked":
        values = fill_stockouts(F.col("open_sale"), F.col("open_status"), values)
    elif mode != "direct":
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn(output, array_sum(replace_operating(F.col("hours_sale"), values)))


def holdout_fold(date, hour_idx, folds):
    """Fold of a cell from its day and hour."""
    return F.pmod(F.unix_date(date) + hour_idx, F.lit(folds))


def hide_fold(df, folds=5, fold=0, date=DATE):
    """Move the cells of one fold from ``masked`` to ``held`` (NULL elsewhere)."""
    mine = lambda h: holdout_fold(F.col(date), h, folds) == fold
    return df.withColumns({
        "held": F.transform("masked", lambda x, h: F.when(mine(h), x)),
        "masked": F.transform("masked", lambda x, h: F.when(~mine(h), x)),
    })


def _cell_errors(held, imputed):
    return F.zip_with(held, imputed, lambda y, d: d - y)


def holdout_metrics(df, imputed, held="held"):
    """Error of each imputed column on the held-out cells, one row per imputer."""
    h = F.col(held)
    aggs = []
    for name in imputed:
        e = _cell_errors(h, F.col(name))
        aggs.append(F.struct(
            F.lit(name).alias("imputer"),
            F.sum(F.size(F.filter(h, lambda x: x.isNotNull()))).alias("n"),
            (floored_ratio(F.sum(array_sum(F.transform(e, F.abs))), F.sum(array_sum(F.transform(h, F.abs)))) * 100)
            .alias("wape"),
            F.sqrt(F.try_divide(F.sum(array_sum(F.transform(e, lambda x: x * x))),
                                F.sum(F.size(F.filter(e, lambda x: x.isNotNull()))))).alias("rmse"),
            (floored_ratio(F.sum(array_sum(e)), F.sum(array_sum(F.transform(h, F.abs)))) * 100).alias("wpe"),
        ))
    return df.agg(F.array(*aggs).alias("rows")).select(F.inline("rows"))


def ensemble_weights(df, imputed=("imputed_weekday", "imputed_hour"), folds=5):
    """Weights of two imputers from a held-out fold: the smaller error weighs more."""
    scored = holdout_metrics(add_profile_imputations(hide_fold(df, folds)), imputed)
    row = scored.agg(*[
        F.max(F.when(F.col("imputer") == i, F.col("wape"))).alias(i) for i in imputed])
    first, second = F.col(imputed[0]), F.col(imputed[1])
    share = F.coalesce(F.try_divide(second, first + second), F.lit(0.5))
    return row.select(share.alias("w_first"), (1 - share).alias("w_second"),
                      first.alias("wape_first"), second.alias("wape_second"))


def add_ensemble(df, weights, imputed=("imputed_weekday", "imputed_hour"), output="imputed_ensemble"):
    """Weighted mean of two imputations; ``weights`` is the one-row frame from above."""
    first, second = weights.select("w_first", "w_second").first()
    return df.withColumn(output, F.zip_with(
        imputed[0], imputed[1], lambda a, b: a * F.lit(first) + b * F.lit(second)))


def average_draws(df, cell, value="imputed"):
    """Mean over repeated imputations of a cell."""
    return df.groupBy(*cell).agg(F.avg(value).alias(value))


def regression_moments(df, columns=HOURLY_COVARIATES, masked="masked"):
    """Sums of products of (1, covariates, hour position, sale) over the observed cells, as a list of rows.

    Covariates do not change within a day, so a day's cells enter by their number and by
    sums of sales and hours; no hour becomes a row.
    """
    y = F.col(masked)
    marked = F.transform(y, lambda x, h: F.when(x.isNotNull(), hour_position(h)))
    products = F.zip_with(y, marked, lambda x, h: x * h)
    rows = df.select(*[F.col(f"{c}_norm").cast("double").alias(f"c{i}") for i, c in enumerate(columns)],
                     F.size(F.filter(y, lambda x: x.isNotNull())).cast("double").alias("n"), array_sum(y).alias("y"),
                     array_sum(F.transform(y, lambda x: x * x)).alias("yy"), array_sum(marked).alias("h"),
                     array_sum(F.transform(marked, lambda h: h * h)).alias("hh"), array_sum(products).alias("hy"))
    whole = ["one", *[f"c{i}" for i in range(len(columns))], "h", "y"]
    rows = rows.withColumn("one", F.lit(1.0))
    inner = {("h", "h"): "hh", ("h", "y"): "hy", ("y", "y"): "yy"}

    def product(a, b):
        if (a, b) in inner:
            return F.col(inner[a, b])
        if b in ("h", "y"):
            return F.col(a) * F.col(b)
        return F.col(a) * F.col(b) * F.col("n")

    pairs = [(i, j) for i in range(len(whole)) for j in range(i, len(whole))]
    sums = rows.agg(*[F.sum(product(whole[i], whole[j])).alias(f"s{i}_{j}") for i, j in pairs]).first()
    return [[sums[f"s{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(len(whole))] for i in range(len(whole))]


def sweep(moments, least=1e-9):
    """(coefficients, intercept) of least squares on sums of products of (1, inputs, target).

    Inputs are swept in order; one that earlier ones explain (all but ``least`` of its
    spread) gets the coefficient 0.
    """
    size, n = len(moments), moments[0][0]
    if not n:
        return [0.0] * (size - 2), 0.0
    a = [[moments[i][j] - moments[0][i] * moments[0][j] / n for j in range(1, size)] for i in range(1, size)]
    spread, used = [a[k][k] for k in range(size - 2)], []
    for k in range(size - 2):
        pivot = a[k][k]
        if spread[k] <= 0 or pivot <= least * spread[k] or pivot <= least * moments[k + 1][k + 1]:
            continue
        used.append(k)
        row = [x / pivot for x in a[k]]
        a = [[row[j] if i == k else a[i][j] - a[i][k] * row[j] for j in range(size - 1)] for i in range(size - 1)]
    beta = [a[k][-1] if k in used else 0.0 for k in range(size - 2)]
    return beta, (moments[0][-1] - sum(b * moments[0][k + 1] for k, b in enumerate(beta))) / n


def fit_regression(df, columns=HOURLY_COVARIATES):
    """Regression imputer on the observed hourly cells, covariates and hour position: (coefficients, intercept)."""
    return sweep(regression_moments(df, columns))


def add_regression_imputation(df, model, columns=HOURLY_COVARIATES, output="imputed_regression"):
    """Score a linear imputer for every hour of the row, as an array expression."""
    weights, intercept = model
    daily = sum((F.col(f"{c}_norm") * F.lit(w) for c, w in zip(columns, weights)), F.lit(float(intercept)))
    return df.withColumn("_daily", daily).withColumn(output, F.array(*[
        F.col("_daily") + F.lit(weights[-1] * h / (OPERATING_HOURS - 1)) for h in HOURS])).drop("_daily")


def imputation_sequences(df, imputed, keys=SERIES_KEYS):
    """The raw imputation per window as one array in time order."""
    days = F.array_sort(F.collect_list(F.struct("day_in_window", F.col(imputed).alias("hours"))))
    return df.groupBy(*keys, "window_idx").agg(days.alias("_days")).select(
        *keys, "window_idx", F.flatten(F.transform("_days", lambda d: d["hours"])).alias("imputation"))

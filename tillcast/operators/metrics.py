"""Forecast and recovery metrics as plain aggregates."""

from pyspark.sql import functions as F

from tillcast.constants import (
    BASELINE_WAPE, CHANGED_TOLERANCE, MIN_STOCKOUT_LEVELS, NEAR_WAPE, SERIES_KEYS,
)
from tillcast.functions.nulls import correlation, floored_ratio, ratio


def unpivot_predictions(df, models, target="sale_amount", extra=()):
    """One row per (row, model); ``models`` maps a name to its prediction column."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("pred"))
        for name, c in models.items()])
    return df.select(*extra, F.col(target).alias("y"), "is_stockout", F.inline(pairs))


def metric_columns(mask_stockout=True, rho_masked=False):
    """The metric aggregates over columns ``y``, ``pred`` and ``is_stockout``.

    Errors count on rows in stock (``mask_stockout``), since sales on stockout days are
    cut short. ``rho_ds``, the link between errors and stockouts, needs both kinds of
    rows and therefore uses all of them, unless ``rho_masked`` asks for the masked set.
    """
    y, p = F.col("y"), F.col("pred")
    both = y.isNotNull() & p.isNotNull()
    scored = both & (F.col("is_stockout") == 0) if mask_stockout else both
    ys, ps = F.when(scored, y), F.when(scored, p)
    error = ys - ps
    n = F.count(error)
    total = F.sum(F.abs(ys))
    spread = F.var_pop(ys) * n
    rho = correlation(F.abs(y - p), F.col("is_stockout"), scored if rho_masked else both)
    return [
        n.alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - floored_ratio(F.sum(error * error), spread)).alias("r2"),
        (floored_ratio(F.sum(F.abs(error)), total) * 100).alias("wape"),
        (floored_ratio(F.sum(ps) - F.sum(ys), total) * 100).alias("wpe"),
        F.when(n > 0, F.coalesce(rho, F.lit(0.0))).alias("rho_ds"),
    ]


def score_models(df, models, by=(), target="sale_amount", mask_stockout=True, rho_masked=False):
    """Metrics of every model, optionally per group, from one scan of the predictions."""
    long = unpivot_predictions(df, models, target, extra=by)
    return long.groupBy(*by, "model").agg(*metric_columns(mask_stockout, rho_masked))


def score_groups_of_best(df, models, by, target="sale_amount", mask_stockout=True):
    """Metrics per group of the model that is best over all rows, from one aggregation.

    Grouping sets give the models' metrics over all rows beside those of each group.
    """
    by = list(by)
    long = unpivot_predictions(df, models, target, extra=by)
    both = long.groupingSets([[F.col("model")], [F.col("model"), *map(F.col, by)]], F.col("model"), *map(F.col, by)).agg(
        F.grouping_id().alias("_set"), *metric_columns(mask_stockout))
    whole = F.col("_set") > 0
    best = best_model(both.where(whole)).select(F.col("model").alias("_best"))
    return both.where(~whole).drop("_set").join(best, F.col("model") == F.col("_best"), "left_semi")


def best_model(metrics):
    """The model with the smallest WAPE (name order breaks ties)."""
    scored = metrics.filter((F.col("n") > 0) & F.col("wape").isNotNull())
    return scored.orderBy("wape", "model").limit(1)


def verdict(metrics, baseline=BASELINE_WAPE, near=NEAR_WAPE):
    """How each model's WAPE compares with a published baseline."""
    wape = F.col("wape")
    label = F.when(wape < baseline, "beats baseline").when(wape < near, "near baseline")
    return metrics.withColumn("verdict", F.when(wape.isNotNull(), label.otherwise("below baseline")))


def ablation_deltas(metrics, comparisons):
    """WAPE of two models side by side; ``comparisons`` maps a name to (base, variant)."""
    wapes = F.map_from_entries(F.collect_list(F.struct("model", "wape")))
    names = F.array(*[
        F.struct(F.lit(k).alias("ablation"), F.lit(a).alias("base"), F.lit(b).alias("variant"))
        for k, (a, b) in comparisons.items()])
    used = {m for pair in comparisons.values() for m in pair}
    table = metrics.filter(F.col("model").isin(*used)).agg(wapes.alias("wapes"))
    rows = table.select("wapes", F.inline(names))
    base, variant = F.col("wapes")[F.col("base")], F.col("wapes")[F.col("variant")]
    return rows.select("ablation", "base", "variant", base.alias("base_wape"), variant.alias("variant_wape"),
                       (variant - base).alias("delta_wape"))


def recovery_changes(df, observed="sale_amount", recovered="sale_amount_pred"):
    """How many rows the recovery changed."""
    changed = F.count_if(F.abs(F.col(recovered) - F.col(observed)) > CHANGED_TOLERANCE)
    return df.agg(changed.alias("changed"), F.count("*").alias("n"),
                  (ratio(changed.cast("double"), F.count("*")) * 100).alias("changed_pct"))


def recovery_metrics(df, observed="sale_amount", recovered="sale_amount_pred"):
    """Error on days in stock (expected to be zero), overall bias, means by stockout."""
    y, d = F.col(observed), F.col(recovered)
    in_stock = F.col("stock_hour6_22_cnt") == 0
    gap = F.when(in_stock, F.abs(d - y))
    stock_y, stock_d = F.when(in_stock, y), F.when(in_stock, d)
    return df.agg(
        F.avg(gap).alias("in_stock_mean_gap"),
        (floored_ratio(F.sum(gap), F.sum(F.abs(stock_y))) * 100).alias("in_stock_wape"),
        (floored_ratio(F.sum(stock_d) - F.sum(stock_y), F.sum(F.abs(stock_y))) * 100).alias("in_stock_wpe"),
        (floored_ratio(F.sum(d) - F.sum(y), F.sum(F.abs(y))) * 100).alias("overall_wpe"),
        F.avg(stock_y).alias("in_stock_mean_observed"), F.avg(stock_d).alias("in_stock_mean_recovered"),
        F.avg(F.when(~in_stock, y)).alias("stockout_mean_observed"),
        F.avg(F.when(~in_stock, d)).alias("stockout_mean_recovered"),
    )


def stockout_correlations(df, columns=("sale_amount", "sale_amount_pred"), keys=SERIES_KEYS):
    """Per (series, holiday flag): correlation of stockout hours with each column.

    The number of distinct stockout hours comes from a bit set of the hours (0..24), so
    the whole result needs one partial aggregation and one shuffle.
    """
    hours = F.col("stock_hour6_22_cnt")
    levels = F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), hours)))
    return df.filter(hours > 0).groupBy(*keys, "holiday_flag").agg(
        levels.cast("int").alias("levels"),
        *[correlation(hours, F.col(c)).alias(f"corr_{c}") for c in columns])


def series_in_stock_mean(df, observed="sale_amount", keys=SERIES_KEYS):
    """Mean observed sales of each series on days in stock."""
    return df.filter(F.col("stock_hour6_22_cnt") == 0).groupBy(*keys).agg(F.avg(observed).alias("mu"))


def decoupling_score(df, columns=("sale_amount", "sale_amount_pred"), keys=SERIES_KEYS,
                     min_levels=MIN_STOCKOUT_LEVELS):
    """Sales-weighted mean correlation of stockout hours with each column.

    Lower means less censoring left. Groups with few distinct stockout levels drop out;
    a constant group adds to the weights only.
    """
    groups = stockout_correlations(df, columns, keys).filter(F.col("levels") > min_levels)
    joined = groups.join(series_in_stock_mean(df, columns[0], keys), list(keys))
    weights = F.sum("mu")
    scores = [
        ratio(F.coalesce(F.sum(F.col(f"corr_{c}") * F.col("mu")), F.lit(0.0)), weights).alias(c)
        for c in columns]
    return joined.agg(*scores).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("method"), F.col(c).alias("decoupling_score")) for c in columns])))

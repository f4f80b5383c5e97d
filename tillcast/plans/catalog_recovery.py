"""Queries over the hourly panel: masks, windows, covariates, recovery and its scores."""

from pyspark.sql import functions as F

from tillcast.constants import SERIES_KEYS
from tillcast.operators import hourly, metrics, recovery
from tillcast.plans.rounding import rounded
from tillcast.sources.tables import hourly_panel

KEYS = [*SERIES_KEYS, "dt"]
WINDOW = 10


def masked_panel(spark, base):
    return hourly.add_masked_hours(hourly_panel(spark, base))


def windowed_panel(spark, base):
    return hourly.normalize_covariates(hourly.add_window_index(masked_panel(spark, base), WINDOW))


def imputed_panel(spark, base):
    return recovery.add_profile_imputations(masked_panel(spark, base))


def recovered_panel(spark, base):
    return recovery.recover(imputed_panel(spark, base))


def hourly_panel_daily(spark, base):
    panel = hourly_panel(spark, base)
    truth = F.aggregate("truth_hours", F.lit(0.0), lambda a, x: a + x)
    return rounded(panel.select(*KEYS, "sale_amount", truth.alias("truth"), "stock_hour6_22_cnt",
                                F.size("hours_sale").alias("n_hours"), "discount", "holiday_flag"))


def hourly_mask(spark, base):
    return rounded(hourly.masked_share(masked_panel(spark, base)))


def window_chunks(spark, base):
    panel = hourly.add_window_index(masked_panel(spark, base), WINDOW)
    return panel.select(*KEYS, "window_idx", "day_in_window")


def covariate_norm(spark, base):
    panel = windowed_panel(spark, base)
    return rounded(panel.select(*KEYS, "window_idx", *[c for c in panel.columns if c.endswith("_norm")]))


def hourly_cells(spark, base):
    return rounded(hourly.hourly_cells(windowed_panel(spark, base)))


def hourly_sequence(spark, base):
    """The steps of each window in time order, numbered."""
    steps = hourly.window_sequences(windowed_panel(spark, base))
    long = steps.select(*SERIES_KEYS, "window_idx", F.posexplode("steps").alias("step", "x"))
    names = ["sale", "discount", "holiday_flag", "precpt", "avg_temperature", "hour_pos"]
    return rounded(long.select(*SERIES_KEYS, "window_idx", "step",
                               *[F.col("x")[i].alias(n) for i, n in enumerate(names)]))


def impute_profiles(spark, base):
    """Both profile imputations of every operating hour."""
    both = imputed_panel(spark, base).select(
        *KEYS, F.posexplode(F.arrays_zip("imputed_weekday", "imputed_hour")).alias("hour_idx", "d"))
    return rounded(both.select(*KEYS, "hour_idx", "d.imputed_weekday", "d.imputed_hour"))


def imputation_draws(spark, base):
    """The two imputations taken as draws, averaged per cell."""
    draws = imputed_panel(spark, base).select(*KEYS, F.explode(F.array("imputed_weekday", "imputed_hour")).alias("d"))
    cells = draws.select(*KEYS, F.posexplode("d").alias("hour_idx", "imputed"))
    return rounded(recovery.average_draws(cells, [*KEYS, "hour_idx"]), 8)


def recover_profile(spark, base):
    return rounded(recovered_panel(spark, base).select(*KEYS, "sale_amount", "sale_amount_pred"))


def recover_direct(spark, base):
    panel = recovery.recover(imputed_panel(spark, base), mode="direct")
    return rounded(panel.select(*KEYS, "sale_amount", "sale_amount_pred"))


def recover_ensemble(spark, base):
    masked = masked_panel(spark, base)
    weights = recovery.ensemble_weights(masked)
    panel = recovery.add_ensemble(recovery.add_profile_imputations(masked), weights)
    return rounded(recovery.recover(panel, "imputed_ensemble").select(*KEYS, "sale_amount_pred"))


def recover_ensemble_weights(spark, base):
    return rounded(recovery.ensemble_weights(masked_panel(spark, base)))


def recover_holdout(spark, base):
    hidden = recovery.add_profile_imputations(recovery.hide_fold(masked_panel(spark, base)))
    return rounded(recovery.holdout_metrics(hidden, ["imputed_weekday", "imputed_hour"]))


def recover_regression(spark, base):
    panel = windowed_panel(spark, base)
    imputed = recovery.add_regression_imputation(panel, recovery.fit_regression(panel))
    return rounded(recovery.recover(imputed, "imputed_regression").select(*KEYS, "sale_amount", "sale_amount_pred"))


def imputation_tensor(spark, base):
    """Sum and length of the raw imputation of each window."""
    panel = recovery.add_profile_imputations(windowed_panel(spark, base))
    windows = recovery.imputation_sequences(panel, "imputed_weekday")
    total = F.aggregate("imputation", F.lit(0.0), lambda a, x: a + x)
    return rounded(windows.select(*SERIES_KEYS, "window_idx", F.size("imputation").alias("n_steps"),
                                  total.alias("total")))


def recovery_changed(spark, base):
    return rounded(metrics.recovery_changes(recovered_panel(spark, base)))


def recovery_metrics(spark, base):
    return rounded(metrics.recovery_metrics(recovered_panel(spark, base)))


def stockout_correlation(spark, base):
    return rounded(metrics.stockout_correlations(recovered_panel(spark, base)))


def in_stock_mean(spark, base):
    return rounded(metrics.series_in_stock_mean(recovered_panel(spark, base)))


def decoupling_score(spark, base):
    return rounded(metrics.decoupling_score(recovered_panel(spark, base)))


QUERIES = {f.__name__: f for f in (
    hourly_panel_daily, hourly_mask, window_chunks, covariate_norm, hourly_cells, hourly_sequence,
    impute_profiles, imputation_draws, recover_profile, recover_direct, recover_ensemble,
    recover_ensemble_weights, recover_holdout, recover_regression, imputation_tensor, recovery_changed,
    recovery_metrics, stockout_correlation, in_stock_mean, decoupling_score,
)}

"""Queries over the daily sales panel: panel, features, split, encoding, profile."""

from pyspark.sql import functions as F

from tillcast.constants import FEATURES, LAGS, SERIES_KEYS, WINDOWS
from tillcast.operators import encoding, features, quantiles, split
from tillcast.plans.rounding import rounded
from tillcast.session import materialize
from tillcast.sources.panel import densify, series_density
from tillcast.sources.tables import sales_panel, sales_span

KEYS = [*SERIES_KEYS, "dt"]
FILLED = ["lag_1", "lag_7", "lag_28", "rolling_std_7", "series_scale"]
PROFILED = ["sale_amount", "sale_amount_pred", "discount", "stockout_ratio"]


def parted(spark, base, panel):
    """The panel with its split; the last day comes from the order lines alone."""
    return split.add_split(panel, max_date=sales_span(spark, base)[1])


def looked_back(spark, base, names):
    panel = features.add_series_features(sales_panel(spark, base))
    return rounded(panel.select(*KEYS, *names))


def panel_daily(spark, base):
    return rounded(features.add_recovery_columns(sales_panel(spark, base)))


def panel_density(spark, base):
    return series_density(materialize(sales_panel(spark, base).select(*KEYS), "panel"))


def panel_densified(spark, base):
    """Totals of each zero-filled series; the grid has every day of the panel, which is written once."""
    panel = materialize(sales_panel(spark, base).select(*KEYS, "city_id", "sale_amount"), "panel")
    dense = densify(panel, attributes=["city_id"])
    return rounded(dense.groupBy(*SERIES_KEYS, "city_id").agg(
        F.count("*").alias("n_days"), F.count_if(F.col("sale_amount") > 0).alias("n_selling"),
        F.sum("sale_amount").alias("total"), F.stddev_samp("sale_amount").alias("spread")))


def feat_lags(spark, base):
    return looked_back(spark, base, [f"lag_{k}" for k in LAGS])


def feat_rolling(spark, base):
    return looked_back(spark, base, [f"rolling_{s}_{w}" for s in ("mean", "std") for w in WINDOWS])


def feat_stockout_rolling(spark, base):
    return looked_back(spark, base, [f"stockout_ratio_{w}d" for w in WINDOWS])


def feat_series_scale(spark, base):
    return looked_back(spark, base, ["series_scale"])


def feat_calendar(spark, base):
    panel = features.add_calendar(sales_panel(spark, base))
    return panel.select(*KEYS, "day_of_week", "week_of_year", "month", "is_weekend", "day_of_month")


def feat_fourier(spark, base):
    panel = features.add_fourier(sales_panel(spark, base), sales_span(spark, base)[0])
    return rounded(panel.select(*KEYS, *[f for f in FEATURES if f.startswith(("sin_", "cos_"))]))


def split_weights(spark, base):
    panel = split.add_weights(parted(spark, base, sales_panel(spark, base)), max_date=sales_span(spark, base)[1])
    return panel.select(*KEYS, "split", "days_ago", "sample_weight")


def eval_target_mask(spark, base):
    panel = split.add_eval_target(parted(spark, base, sales_panel(spark, base)))
    return panel.select(*KEYS, "split", "eval_target")


def split_panel(spark, base):
    return parted(spark, base, features.add_calendar(sales_panel(spark, base)))


def target_encoding(spark, base):
    panel = split_panel(spark, base)
    encoded = encoding.TargetEncoder.fit(split.part(panel, "train")).transform(panel)
    return rounded(encoded.select(*KEYS, "split", "first_category_id_te", "city_id_te"))


def encoding_lookup(spark, base):
    train = split.part(split_panel(spark, base), "train")
    return rounded(encoding.encoding_lookup(encoding.encoding_cells(train, ["city_id"]), "city_id"))


def column_profile(spark, base):
    return rounded(encoding.column_profile(sales_panel(spark, base), PROFILED))


def filled_from(spark, base):
    """Written once, since the medians need several passes."""
    panel = parted(spark, base, features.add_series_features(sales_panel(spark, base)))
    return materialize(panel.select(*KEYS, "split", *FILLED), "looked")


def column_medians(spark, base):
    medians = quantiles.exact_medians(split.part(filled_from(spark, base), "train"), FILLED)
    return rounded(encoding.as_frame(spark, medians, value="median"))


def median_fill(spark, base):
    panel = filled_from(spark, base)
    fill = encoding.MedianFill.fit(split.part(panel, "train"), FILLED)
    return rounded(fill.transform(panel).select(*KEYS, *FILLED))


def standardize(spark, base):
    panel = parted(spark, base, sales_panel(spark, base))
    columns = ["sale_amount", "discount", "avg_temperature", "stockout_ratio"]
    scaler = encoding.Standardizer.fit(split.part(panel, "train"), columns)
    return rounded(scaler.transform(panel, "_z").select(*KEYS, *[f"{c}_z" for c in columns]))


def feature_table(spark, base):
    """All registry features of every row, encoded on the training rows."""
    rows = materialize(sales_panel(spark, base), "panel")
    first, last = rows.agg(F.min("dt"), F.max("dt")).first()
    train = split.part(split.add_split(features.add_calendar(rows), max_date=last), "train")
    encoder = encoding.TargetEncoder.fit(train)
    panel = split.add_split(features.build_features(rows, anchor=first), max_date=last)
    return rounded(encoder.transform(panel).select(*KEYS, "split", *FEATURES))


def min_group_guard(spark, base):
    """Cities with enough training rows and targets for a model of their own."""
    from tillcast.constants import GROUP_MIN_ROWS, GROUP_MIN_TARGETS
    from tillcast.operators.per_group import groups_to_fit

    train = split.part(parted(spark, base, sales_panel(spark, base)), "train")
    return groups_to_fit(train, "city_id", "sale_amount_pred", GROUP_MIN_ROWS, GROUP_MIN_TARGETS)


def valid_rows(spark, base):
    """Rows left per split when every look-back column must have a value."""
    panel = parted(spark, base, features.add_series_features(sales_panel(spark, base)))
    kept = split.valid_rows(panel, ["sale_amount_pred", *FILLED])
    return kept.groupBy("split").agg(F.count("*").alias("n"), F.min("dt").alias("first_day"))


QUERIES = {f.__name__: f for f in (
    panel_daily, panel_density, panel_densified, feat_lags, feat_rolling, feat_stockout_rolling,
    feat_series_scale, feat_calendar, feat_fourier, feature_table, split_weights, eval_target_mask,
    target_encoding, encoding_lookup, column_profile, column_medians, median_fill, standardize,
    min_group_guard, valid_rows,
)}

"""Queries over forecasts: metrics, closed-form and tree models, backtests, report."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.constants import FEATURES, SERIES_KEYS
from tillcast.operators import (
    backtest, encoding, features, importance, metrics, neighbors, report, ridge, split, stacking,
)
from tillcast.operators.attribution import importance_frame, mean_attribution, tree_attributions
from tillcast.operators.boosting import score_groups
from tillcast.operators.per_group import ridge_per_group, score_per_group
from tillcast.operators.trees import score
from tillcast.plans import training
from tillcast.plans.recovering import recover_panel
from tillcast.plans.rounding import rounded
from tillcast.schemas import METRICS, require_columns
from tillcast.session import materialize, shared_path
from tillcast.sources import sinks
from tillcast.sources.models import inventory, load_models, save_models
from tillcast.sources.panel import union_all, with_series_columns
from tillcast.sources.tables import hourly_panel, sales_panel, sales_span

KEYS = [*SERIES_KEYS, "dt"]
SIMPLE = {"last week": "lag_7", "mean of 28": "rolling_mean_28", "series mean": "series_scale"}
ABLATED = {"recent against long mean": ("series mean", "mean of 28"), "week against mean": ("mean of 28", "last week")}
LINEAR = ["lag_1", "rolling_mean_28", "series_scale"]
NEAR = ["lag_1", "rolling_mean_28", "series_scale", "discount"]
BASES = {"xgboost": "lag_7", "lightgbm": "rolling_mean_28", "random_forest": "series_scale"}
SHORT = training.Sizes().within(30)


def looked_panel(spark, base):
    last = sales_span(spark, base)[1]
    looked = features.add_series_features(sales_panel(spark, base))
    return split.add_weights(split.add_split(looked, max_date=last), max_date=last)


def test_rows(spark, base):
    return split.part(looked_panel(spark, base), "test")


def filled_panel(spark, base, columns):
    """Written once, since fitting and scoring read it several times, without the look-back columns that are not asked for."""
    looked = looked_panel(spark, base)
    unasked = [c for c in features.series_columns(Window.partitionBy(*SERIES_KEYS).orderBy("dt")) if c not in columns]
    panel = materialize(looked.drop(*unasked), "looked")
    fill = encoding.MedianFill.fit(split.part(panel, "train").select(*columns), columns)
    return fill.transform(panel)


def metrics_models(spark, base):
    return rounded(metrics.score_models(test_rows(spark, base), SIMPLE))


def metrics_all_days(spark, base):
    """The same without hiding stockout days."""
    return rounded(metrics.score_models(test_rows(spark, base), SIMPLE, mask_stockout=False))


def metrics_per_city(spark, base):
    """The best model of the test week, in each city."""
    return rounded(metrics.score_groups_of_best(test_rows(spark, base), SIMPLE, ["city_id"]))


def feat_calendar_windows(spark, base):
    """Look-back columns by calendar days on a panel with gaps."""
    looked = features.add_calendar_features(sales_panel(spark, base))
    return rounded(looked.select(*KEYS, "lag_1", "lag_7", "lag_28", "rolling_mean_28", "rolling_std_28",
                                 "stockout_ratio_28d", "series_scale"))


def metrics_validation(spark, base):
    """Parts of the blend on the validation week."""
    val = split.part(looked_panel(spark, base), "val").withColumn(
        "blend", stacking.blend("rolling_mean_7", "rolling_mean_28"))
    names = {"part one": "rolling_mean_7", "part two": "rolling_mean_28", "blend": "blend"}
    return rounded(metrics.score_models(val, names).select("model", "n", "wape", "wpe"))


def best_model(spark, base):
    return rounded(metrics.best_model(metrics.score_models(test_rows(spark, base), SIMPLE)).select("model", "n", "wape"))


def model_verdict(spark, base):
    scored = metrics.verdict(metrics.score_models(test_rows(spark, base), SIMPLE), baseline=100.0, near=110.0)
    return rounded(scored.select("model", "wape", "verdict"))


def ablation_delta(spark, base):
    return rounded(metrics.ablation_deltas(metrics.score_models(test_rows(spark, base), SIMPLE), ABLATED))


def metrics_union(spark, base):
    """Records of main models and of an ablation arm that has no rho_ds."""
    main = metrics.score_models(test_rows(spark, base), SIMPLE)
    arm = metrics.score_models(test_rows(spark, base), {"mean of 7": "rolling_mean_7"}).drop("rho_ds")
    return rounded(union_all([main, arm]))


def blend_70_30(spark, base):
    return rounded(test_rows(spark, base).select(*KEYS, stacking.blend("rolling_mean_7", "rolling_mean_28").alias("blend")))


def ridge_closed_form(spark, base):
    """Standardised, weighted ridge on three features, scored on every row."""
    panel = filled_panel(spark, base, LINEAR)
    model = ridge.ridge_pipeline(split.part(panel, "train"), LINEAR, "sale_amount_pred", weight="sample_weight")
    return rounded(score(model, panel).select(*KEYS, "prediction"))


def based_panel(spark, base):
    return looked_panel(spark, base).withColumns({n: F.col(c) for n, c in BASES.items()})


def stacking_ridge(spark, base):
    rows = materialize(based_panel(spark, base).filter("split <> 'train'"), "bases")
    stack = stacking.fit_stack(split.part(rows, "val"), BASES, "sale_amount_pred", "lightgbm")
    return rounded(stack.transform(split.part(rows, "test")).select(*KEYS, "stacking"))


def stacking_folds(spark, base):
    rows = materialize(split.part(based_panel(spark, base), "val"), "bases")
    scores = stacking.cross_validate_stack(rows, BASES, "sale_amount_pred")
    return rounded(spark.createDataFrame(scores, "fold int, n long, rmse double"))


def stacking_summary(spark, base):
    return rounded(stacking.fold_summary(stacking_folds(spark, base)))


def knn_panel(spark, base):
    panel = filled_panel(spark, base, NEAR)
    scaler = encoding.Standardizer.fit(split.part(panel, "train"), NEAR)
    scaled = scaler.transform(panel)
    return materialize(scaled.select("series_id", "dt", "split", "sale_amount_pred", *NEAR, F.concat_ws(
        "@", "series_id", F.col("dt").cast("string")).alias("row_id")), "scaled")


def knn_brute(spark, base):
    panel = knn_panel(spark, base)
    found = neighbors.knn_neighbors(split.part(panel, "train"), split.part(panel, "test"), NEAR,
                                    "sale_amount_pred", "row_id")
    return rounded(neighbors.knn_predictions(found))


def held_out_features(spark, base):
    """A separate evaluation panel without weather: look-back into the training panel, fitted fills."""
    panel = materialize(sales_panel(spark, base), "panel")
    end = panel.agg(F.max("dt")).first()[0]
    held = panel.filter(F.datediff(F.lit(end), "dt") < 14).withColumn("precpt", F.lit(None).cast("double"))
    early = panel.filter(F.datediff(F.lit(end), "dt") >= 14)
    columns = ["lag_1", "rolling_mean_28", "series_scale", "precpt"]
    data = training.prepare(early, inputs=columns)
    return rounded(training.prepare_held_out(early, held, data).select(*KEYS, *columns))


def sink_panel(spark, base):
    """The panel written by city and read back."""
    path = shared_path(spark, "sink")
    sinks.write_panel(sales_panel(spark, base), path, partition_by="city_id")
    return rounded(spark.read.parquet(path).select(*KEYS, "city_id", "sale_amount"))


def sink_metrics(spark, base):
    """Metric records written as JSON and read back."""
    path = shared_path(spark, "sink")
    sinks.write_metrics(metrics.score_models(test_rows(spark, base), SIMPLE), path)
    return rounded(spark.read.schema(METRICS).json(path))


def sink_importance(spark, base):
    """Importances written as CSV and read back."""
    path = shared_path(spark, "sink")
    sinks.write_importance(linear_attribution(spark, base), path, "mean_abs")
    return spark.read.schema("feature string, mean_abs double").option("header", True).csv(path)


def sink_report(spark, base):
    """The report written as text and read back."""
    path = shared_path(spark, "sink")
    sinks.write_report(report_markdown(spark, base), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def sink_forecasts(spark, base):
    """Plain forecasts written and read back."""
    path = shared_path(spark, "sink")
    sinks.write_forecasts(backtest_ma(spark, base), path)
    return spark.read.parquet(path)


def forecaster_input(spark, base):
    return rounded(backtest.forecaster_frame(sales_panel(spark, base)))


def city_list(spark, base):
    return sales_panel(spark, base).select("city_id").distinct().orderBy("city_id")


def recovered_forecast(spark, base):
    """Recover the hourly panel, hand it over as a table, and score forecasts on it."""
    recovered = with_series_columns(recover_panel(hourly_panel(spark, base), imputer="weekday"))
    demand = require_columns(materialize(recovered, "demand"), ["sale_amount_pred"])
    looked = split.add_split(features.add_series_features(demand))
    names = {"last week": "lag_7", "mean of 7": "rolling_mean_7"}
    return rounded(metrics.score_models(split.part(looked, "test"), names))


def forecasts(spark, base, method):
    inputs = backtest.rolling_inputs(backtest.forecaster_frame(sales_panel(spark, base)), end=sales_span(spark, base)[1])
    return backtest.forecast(inputs, {"y_hat": backtest.FORECASTERS[method]})


def backtest_naive(spark, base):
    return rounded(forecasts(spark, base, "seasonal_naive"))


def backtest_ma(spark, base):
    return rounded(forecasts(spark, base, "moving_average"))


def backtest_drift(spark, base):
    return rounded(forecasts(spark, base, "drift"))


def backtest_aligned(spark, base):
    """Rows and matched forecasts of the held-out weeks."""
    panel = split.add_split(sales_panel(spark, base), max_date=sales_span(spark, base)[1])
    joined = backtest.align(
        panel.filter(F.col("split") != "train"), forecasts(spark, base, "moving_average"), ["y_hat"])
    return rounded(joined.groupBy("split").agg(
        F.count("*").alias("n"), F.count("y_hat").alias("n_matched"), F.sum("y_hat").alias("total")))


def fitted_linear(panel):
    return ridge.ridge_from_moments(split.part(panel, "train"), LINEAR, "sale_amount_pred", 10.0, "sample_weight")


def linear_attribution(spark, base):
    panel = filled_panel(spark, base, LINEAR)
    return rounded(importance.linear_attribution(split.part(panel, "train"), fitted_linear(panel)))


def top_features(spark, base):
    return importance.ranked(linear_attribution(spark, base), "mean_abs", top=2)


def report_markdown(spark, base):
    scored = materialize(metrics.score_models(test_rows(spark, base), SIMPLE), "metrics")
    return report.benchmark_report(spark, scored, metrics.ablation_deltas(scored, ABLATED), metrics.best_model(scored))


def prepared(spark, base):
    return training.prepare(sales_panel(spark, base))


def held_out(data):
    return data.frame.filter(F.col("split") != "train")


def gbt_forecast(spark, base):
    data = prepared(spark, base)
    model = data.fit({"m": "sale_amount_pred"}, SHORT.boosted)["m"]
    return score(model, held_out(data)).select(*KEYS, "split", "prediction")


def gbt_full_forecast(spark, base):
    """The boosted model at its full size: 5000 rounds unless patience is used up before."""
    data = prepared(spark, base)
    model = data.fit({"m": "sale_amount_pred"}, training.BOOSTED)["m"]
    return score(model, held_out(data)).select(*KEYS, "split", "prediction")


def gbt_fine_forecast(spark, base):
    """The leaf-wise boosted model for both targets, and their blend."""
    data = prepared(spark, base)
    out = held_out(data)
    for name, model in data.fit({"observed": "sale_amount", "recovered": "sale_amount_pred"}, SHORT.fine).items():
        out = score(model, out, name)
    return out.select(*KEYS, "split", "observed", "recovered", stacking.blend("observed", "recovered").alias("blend"))


def gbt_one_tree(spark, base):
    """A tree without penalties: leaves that are not their rows' weighted mean, and the mean prediction of the training rows."""
    data = prepared(spark, base)
    settings = training.BOOSTED_FINE.sized(trees=1, step=1.0, rows=1.0, columns="all", patience=0)
    scored = score(data.fit({"m": "sale_amount_pred"}, settings, held="split <> 'train'")["m"], data.split("train"))
    total = lambda c: F.sum(F.col("sample_weight") * F.col(c))
    leaves = scored.filter("sale_amount_pred is not null").groupBy("prediction").agg(
        F.count("*").alias("n"), total("sale_amount_pred").alias("y"), total("prediction").alias("p"), F.sum("sample_weight").alias("w"))
    wrong = F.sum((F.abs(F.col("y") - F.col("p")) > 1e-6 * F.col("w")).cast("long"))
    return rounded(leaves.agg(F.sum("n").alias("n"), wrong.alias("wrong_leaves"), (F.sum("p") / F.sum("w")).alias("mean_prediction")), 6)


def rf_forecast(spark, base):
    data = prepared(spark, base)
    model = data.fit({"m": "sale_amount_pred"}, SHORT.forest)["m"]
    return score(model, held_out(data)).select(*KEYS, "split", "prediction")


def ridge_forecast(spark, base):
    """Ridge on all features."""
    data = prepared(spark, base)
    model = ridge.ridge_pipeline(data.split("train"), FEATURES, "sale_amount_pred", weight="sample_weight")
    return rounded(score(model, held_out(data)).select(*KEYS, "split", "prediction"), 4)


def per_city_models(spark, base):
    """A boosted model per city at its full size."""
    data = prepared(spark, base)
    test = data.split("test").select(*KEYS, "city_id", *[c for c in FEATURES if c != "city_id"])
    return score_groups(test, training.fit_cities(data, training.BOOSTED_GROUP), "city_id", FEATURES).select(*KEYS, "city_id", "prediction")


def per_city_ridge(spark, base):
    """A linear model per city from one pass, on standardised features."""
    panel = filled_panel(spark, base, LINEAR)
    scaler = encoding.Standardizer.fit(split.part(panel, "train"), LINEAR)
    scaled = scaler.transform(panel)
    models = ridge_per_group(split.part(scaled, "train"), "city_id", LINEAR, "sale_amount_pred", 10.0, "sample_weight")
    return rounded(score_per_group(split.part(scaled, "test"), models, "city_id", LINEAR).select(
        *KEYS, "city_id", "prediction"))


def benchmark_run(spark, base):
    """Every forecaster, blend and stack on the test week."""
    scored, _ = training.run_benchmark(prepared(spark, base), SHORT, knn_inputs=FEATURES)
    return training.benchmark_metrics(scored)


def ablation_run(spark, base):
    """The ablation arms at full size."""
    data = prepared(spark, base)
    scored = training.run_ablations(data, training.Sizes())
    return metrics.ablation_deltas(scored, training.ABLATIONS)


def permutation_importance(spark, base):
    data = prepared(spark, base)
    model = data.fit({"m": "sale_amount_pred"}, SHORT.boosted)["m"]
    grown = importance.permutation_importance(data.split("train"), model, FEATURES, "sale_amount_pred")
    return importance.ranked(grown.join(importance_frame(spark, model), "feature"), "wape_growth")


def attributed(spark, base):
    """Attributions of a sample of the training rows, with their predictions."""
    data = prepared(spark, base)
    model = data.fit({"m": "sale_amount_pred"}, SHORT.boosted)["m"]
    sample = materialize(score(model, importance.sample_rows(data.split("train"))), "sample")
    return materialize(tree_attributions(sample, model, [*KEYS, "prediction"]), "attributions")


def tree_attribution_sums(spark, base):
    """Sampled rows, and those whose attributions do not add up to the prediction less the mean."""
    gap = F.aggregate("values", F.col("base"), lambda a, x: a + x) - F.col("prediction")
    return attributed(spark, base).agg(F.count("*").alias("n"), F.sum((F.abs(gap) > 1e-6).cast("long")).alias("wrong"))


def tree_attribution_top(spark, base):
    """The twenty inputs with the largest mean absolute attribution, written and read back."""
    path = shared_path(spark, "sink")
    top = importance.ranked(mean_attribution(attributed(spark, base), FEATURES), "mean_abs", 20)
    sinks.write_importance(top, path, "mean_abs")
    return spark.read.schema("feature string, mean_abs double").option("header", True).csv(path)


def sampled_rows(spark, base):
    return rounded(importance.sample_rows(sales_panel(spark, base)).select(*KEYS, "sale_amount"))


def model_inventory(spark, base):
    """Models saved and loaded again; absent names are reported as such."""
    panel = filled_panel(spark, base, LINEAR)
    model = ridge.ridge_pipeline(split.part(panel, "train"), LINEAR, "sale_amount_pred", weight="sample_weight")
    path = shared_path(spark, "models")
    save_models({"ridge": model}, path)
    return inventory(spark, load_models(path))


QUERIES = {f.__name__: f for f in (
    feat_calendar_windows, metrics_models, metrics_all_days, metrics_per_city, metrics_validation, best_model, model_verdict,
    ablation_delta, metrics_union, blend_70_30, ridge_closed_form, stacking_ridge, stacking_folds,
    stacking_summary, knn_brute, forecaster_input, city_list, recovered_forecast, backtest_naive, backtest_ma, backtest_drift, backtest_aligned,
    linear_attribution, top_features, report_markdown, gbt_forecast, gbt_fine_forecast, gbt_one_tree, gbt_full_forecast, rf_forecast,
    ridge_forecast, per_city_models, per_city_ridge, benchmark_run, ablation_run, permutation_importance, tree_attribution_sums, tree_attribution_top,
    sampled_rows, model_inventory, held_out_features, sink_panel, sink_metrics, sink_importance, sink_report,
    sink_forecasts,
)}

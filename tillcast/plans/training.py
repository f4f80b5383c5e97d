"""From a recovered daily panel to fitted models, predictions, metrics and ablations."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from tillcast.constants import (
    FEATURES, FOURIER_PREFIXES, NEIGHBOURS, SERIES_KEYS, features_without,
)
from tillcast.operators import metrics
from tillcast.operators.backtest import FORECASTERS, align, forecast, forecaster_frame, rolling_inputs
from tillcast.operators.encoding import MedianFill, Standardizer, TargetEncoder
from tillcast.operators.features import add_calendar, build_features
from tillcast.operators.neighbors import knn_forecast
from tillcast.operators.per_group import groups_to_fit
from tillcast.operators.ridge import ridge_pipeline
from tillcast.operators.split import add_split, add_weights, part
from tillcast.operators.stacking import blend, fit_stack
from tillcast.operators.boosting import fit_lanes, fit_models, lane_rows, score_groups
from tillcast.operators.bins import bin_rows
from tillcast.operators.trees import BOOSTED, BOOSTED_ABLATION, BOOSTED_FINE, BOOSTED_GROUP, FOREST, score
from tillcast.session import materialize

OBSERVED, RECOVERED, WEIGHT = "sale_amount", "sale_amount_pred", "sample_weight"
KEYS = (*SERIES_KEYS, "dt")
HELD = "split = 'val'"
MOST_STEP = 0.3


@dataclass(frozen=True)
class Sizes:
    """How large the tree ensembles are; the defaults are the full-size settings."""

    boosted: object = BOOSTED
    fine: object = BOOSTED_FINE
    forest: object = FOREST
    ablation: object = BOOSTED_ABLATION
    group: object = BOOSTED_GROUP

    def scaled(self, trees, depth):
        """The same settings with fewer and shallower trees, and a patience to match, for trial runs."""
        change = lambda s: s.sized(
            trees=min(s.trees, trees), depth=min(s.depth, depth), patience=min(s.patience, max(2, trees // 5)))
        return Sizes(*map(change, (self.boosted, self.fine, self.forest, self.ablation, self.group)))

    def within(self, rounds):
        """The same settings cut to ``rounds`` trees, with steps that grow by as much (up to ``MOST_STEP``).

        Depth, leaves, sampling and penalties stay; patience shrinks with the rounds.
        """
        change = lambda s: s if s.trees <= rounds else s.sized(
            trees=rounds, step=min(MOST_STEP, s.step * s.trees / rounds), patience=min(s.patience, max(3, rounds // 6)))
        return Sizes(*map(change, (self.boosted, self.fine, self.forest, self.ablation, self.group)))


@dataclass
class Prepared:
    """Features of all rows, written once and filled where they are read, with the fitted encoder and medians."""

    frame: object
    encoder: TargetEncoder
    fill: MedianFill
    anchor: object
    inputs: list = field(default_factory=lambda: list(FEATURES))
    _binned: object = None

    def split(self, name):
        return part(self.frame, name)

    def binned(self):
        """Bins of the training and validation rows, worked out once; edges come from the training rows."""
        if self._binned is None:
            known = self.frame.filter(F.col("split") != "test")
            keep = [*KEYS, "split", "city_id", OBSERVED, RECOVERED, WEIGHT]
            self._binned = bin_rows(known, self.inputs, [c for c in keep if c in known.columns], WEIGHT, self.split("train"))
        return self._binned

    def fit(self, targets, settings, inputs=None, held=HELD, weight=WEIGHT):
        """Tree models by name, for names with their target columns, fitted together."""
        return fit_models(self.binned(), targets, settings, KEYS, held, weight, inputs)


def prepare(panel, fit_scope="train", inputs=FEATURES, chunk_rows=None):
    """Features, split, weights, encodings and median fills.

    Medians come from the training rows, or from ``all`` rows; the target is never
    filled. The panel is written once before its days are looked up, and the features once
    for the medians and every model to read: encodings need no look-back and are fitted
    before, fills are filled in where rows are read. ``chunk_rows`` cuts series too long for
    one task into chunks. Medians are fitted for every input, also for those without gaps in
    this panel, so that later panels can be filled.
    """
    panel = materialize(panel, "panel")
    first, last = panel.agg(F.min("dt"), F.max("dt")).first()
    encoder = TargetEncoder.fit(part(add_split(add_calendar(panel), max_date=last), "train"))
    built = encoder.transform(build_features(panel, anchor=first, chunk_rows=chunk_rows))
    base = materialize(add_weights(add_split(built, max_date=last), max_date=last), "features")
    scope = part(base, "train") if fit_scope == "train" else base
    numeric = [f for f in inputs if not f.endswith("_te")]
    fill = MedianFill.fit(scope, numeric)
    return Prepared(fill.transform(base), encoder, fill, first, list(inputs))


def prepare_held_out(panel, held, data, chunk_rows=None):
    """Features of a separate evaluation panel that continues the training panel.

    Look-back columns reach into the training panel; encodings, medians and the seasonal
    anchor are the fitted ones. Returns the held-out rows only.
    """
    joined = panel.withColumn("_held", F.lit(False)).unionByName(
        held.withColumn("_held", F.lit(True)), allowMissingColumns=True)
    built = build_features(joined, anchor=data.anchor, chunk_rows=chunk_rows).filter("_held").drop("_held")
    return data.fill.transform(data.encoder.transform(built))


def fit_base_models(data, sizes, target=RECOVERED):
    """The forecasters of the benchmark except kNN, which has no fitted state; fits run side by side."""
    data.binned()
    fits = (
        lambda: data.fit({"xgboost": target}, sizes.boosted),
        lambda: data.fit({"lgb_observed": OBSERVED, "lgb_recovered": RECOVERED}, sizes.fine),
        lambda: data.fit({"random_forest": target}, sizes.forest),
        lambda: {"ridge": ridge_pipeline(data.split("train"), data.inputs, target, weight=WEIGHT)},
    )
    with ThreadPoolExecutor(len(fits)) as pool:
        return {name: model for found in pool.map(lambda fit: fit(), fits) for name, model in found.items()}


def fit_cities(data, settings, target=RECOVERED, group="city_id"):
    """Nodes of one boosted model per group with enough rows, all grown together; validation rows are not used."""
    binned, train = data.binned(), "split = 'train'"
    enough = groups_to_fit(binned.frame.where(train), group, target).select(F.col(group).cast("string").alias("lane"))
    rows = lane_rows(binned, group, target, KEYS, f"not ({train})").where("not held")
    return fit_lanes(rows.join(enough, "lane", "left_semi"), binned.edges, settings)


def predict(frame, models):
    """A prediction column per model on one keyed frame; no positional joins."""
    for name, model in models.items():
        frame = score(model, frame, name)
    return frame


def add_knn(data, scored, inputs, k=NEIGHBOURS, target=RECOVERED):
    """kNN predictions on standardised inputs, as column ``knn``."""
    row_id = F.concat_ws("@", "series_id", F.col("dt").cast("string"))
    scaler = Standardizer.fit(data.split("train"), inputs)
    train = scaler.transform(data.split("train")).withColumn("_id", row_id)
    asked = scaler.transform(scored).withColumn("_id", row_id).select("_id", *inputs)
    found = knn_forecast(train, asked, inputs, target, "_id", k=k).select("_id", "knn")
    return scored.withColumn("_id", row_id).join(found, "_id", "left").drop("_id")


def add_backtests(data, scored, names=tuple(FORECASTERS)):
    """Rolling-origin forecasts of the panel's series, as a column per forecaster."""
    inputs = rolling_inputs(forecaster_frame(data.frame))
    return align(scored, forecast(inputs, {n: FORECASTERS[n] for n in names}), list(names))


def run_benchmark(data, sizes, knn_inputs=(), backtests=tuple(FORECASTERS)):
    """Validation and test rows with every model's prediction, and the models."""
    models = fit_base_models(data, sizes)
    held = data.frame.filter(F.col("split") != "train")
    scored = predict(held, models).withColumn("lightgbm", blend("lgb_observed", "lgb_recovered"))
    if knn_inputs:
        scored = add_knn(data, scored, list(knn_inputs))
    if backtests:
        scored = add_backtests(data, scored, backtests)
    scored = materialize(scored, "predictions")
    stack = fit_stack(part(scored, "val"), ["xgboost", "lightgbm", "random_forest"], RECOVERED, "lightgbm")
    return stack.transform(scored, "stacking"), {**models, "stacking": stack}


# Report names of the prediction columns.
REPORT_NAMES = {
    "XGBoost (global)": "xgboost", "LGB-MSE (global)": "lgb_observed",
    "LGB-Recovered (global)": "lgb_recovered", "LGB Blend 70/30": "lightgbm",
    "Random Forest (global)": "random_forest", "Ridge Regression": "ridge",
    "kNN (k=15)": "knn", "Stacking Ensemble": "stacking",
    "Seasonal naive": "seasonal_naive", "Moving average": "moving_average", "Drift": "drift",
}


def benchmark_metrics(scored, by=(), split="test"):
    """Metrics of every model that has a prediction column."""
    names = {n: c for n, c in REPORT_NAMES.items() if c in scored.columns}
    return metrics.score_models(part(scored, split), names, by=by)


def run_ablations(data, sizes):
    """Metrics of the ablation arms on the test rows.

    Each arm names its target and inputs: observed against recovered target, one model
    against one per city, with and without seasonal terms.
    """
    test = data.split("test")
    keys = [*SERIES_KEYS, "dt"]
    arms = {
        "observed target": (data.inputs, OBSERVED),
        "recovered target": (data.inputs, RECOVERED),
        "no Fourier": ([f for f in features_without(FOURIER_PREFIXES) if f in data.inputs], RECOVERED),
    }
    data.binned()
    whole = {name: target for name, (inputs, target) in arms.items() if inputs == data.inputs}
    fits = [lambda: data.fit(whole, sizes.ablation, held="false", weight=None)]
    fits += [lambda i=inputs, n=name, t=target: data.fit({n: t}, sizes.ablation, i, "false", None)
             for name, (inputs, target) in arms.items() if name not in whole]
    with ThreadPoolExecutor(len(fits) + 1) as pool:
        cities = pool.submit(lambda: fit_cities(data, sizes.group))
        models = {name: model for found in pool.map(lambda fit: fit(), fits) for name, model in found.items()}
    scored = predict(test, models)
    per_city = score_groups(test.select(*keys, "city_id", *[c for c in data.inputs if c != "city_id"]), cities.result(), "city_id",
                            data.inputs, "per city")
    scored = scored.join(per_city.select(*keys, "per city"), keys, "left")
    return metrics.score_models(scored, {n: n for n in (*arms, "per city")})


def stacking_value(scored):
    """The best single model against the stack, as one more ablation of ``benchmark_metrics``."""
    table = benchmark_metrics(scored)
    stack = "Stacking Ensemble"
    best = metrics.best_model(table.filter(F.col("model") != stack)).first()
    return metrics.ablation_deltas(table, {"Stacking value": (best["model"], stack)})


# Ablations as (base arm, variant arm).
ABLATIONS = {
    "Recovery impact": ("observed target", "recovered target"),
    "Global vs per-city": ("recovered target", "per city"),
    "Fourier features": ("no Fourier", "recovered target"),
}

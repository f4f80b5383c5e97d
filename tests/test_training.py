import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillcast.constants import FEATURES
from tillcast.operators.metrics import score_models
from tillcast.plans import catalog_models, training
from tillcast.sources.panel import with_series_columns

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(6)
    rows = []
    for store in range(20):
        level = 5 + store
        for i in range(80):
            day = START + dt.timedelta(days=i)
            y = max(0.0, level + 3 * (day.weekday() >= 5) + rng.gauss(0, 1))
            cnt = rng.choice([0, 0, 0, 4, 8])
            rows.append((store, 1, store % 3, store % 4, day, y * (1 - cnt / 32), cnt, 0.1, 0, 0, 0.5, 20.0, 60.0, 2.0, y))
    return with_series_columns(spark.createDataFrame(
        rows, "store_id long, product_id long, city_id int, first_category_id int, dt date, sale_amount double,"
              "stock_hour6_22_cnt int, discount double, holiday_flag int, activity_flag int, precpt double,"
              "avg_temperature double, avg_humidity double, avg_wind_level double, sale_amount_pred double"))


@pytest.fixture(scope="module")
def data(panel):
    return training.prepare(panel)


def test_prepared_rows_are_complete(data, panel):
    assert data.frame.count() == panel.count()
    assert data.frame.dropna(subset=FEATURES).count() == panel.count()
    counts = {r["split"]: r["count"] for r in data.frame.groupBy("split").count().collect()}
    assert counts == {"train": 20 * 66, "val": 140, "test": 140}


def test_features_are_written_once(panel, monkeypatch):
    written, own = [], training.materialize
    monkeypatch.setattr(training, "materialize", lambda df, name: written.append(name) or own(df, name))
    again = training.prepare(panel)
    assert written == ["panel", "features"]  # a filled copy of all features before
    encoder = training.TargetEncoder.fit(again.split("train"))
    for a, b in zip(*(sorted(f.select("store_id", "dt", "city_id_te", "first_category_id_te").collect())
                      for f in (again.frame, encoder.transform(again.frame)))):
        assert tuple(a)[:2] == tuple(b)[:2]
        assert tuple(a)[2:] == pytest.approx(tuple(b)[2:])


def test_a_long_series_is_cut_without_changing_features(panel, data):
    with pytest.raises(ValueError):
        training.prepare(panel, chunk_rows=79)  # a chunk must cover the longest look-back
    cut = training.prepare(panel, chunk_rows=90)
    names = ["lag_28", "rolling_std_28", "series_scale"]
    key = lambda r: (r["store_id"], r["dt"])
    for a, b in zip(sorted(cut.frame.collect(), key=key), sorted(data.frame.collect(), key=key)):
        assert [a[n] for n in names] == pytest.approx([b[n] for n in names])


def test_benchmark_and_models_beat_the_naive_forecast(data):
    sizes = training.Sizes().scaled(trees=25, depth=4)
    sizes = training.Sizes(sizes.boosted.sized(step=0.3, min_rows=3), sizes.fine.sized(step=0.3, min_rows=3),
                           sizes.forest.sized(min_rows=3), sizes.ablation, sizes.group)
    scored, models = training.run_benchmark(data, sizes, knn_inputs=["rolling_mean_28", "is_weekend"])
    table = {r["model"]: r for r in training.benchmark_metrics(scored).collect()}
    assert set(table) == set(training.REPORT_NAMES)
    naive = score_models(data.split("test"), {"naive": "lag_7"}).first()
    for name in ("XGBoost (global)", "Random Forest (global)", "Ridge Regression", "Stacking Ensemble"):
        assert table[name]["wape"] < naive["wape"], name
    assert models["stacking"].model is not None
    assert len({r["n"] for n, r in table.items() if n not in ("Seasonal naive", "Moving average", "Drift")}) == 1
    value = training.stacking_value(scored).collect()
    assert [r["ablation"] for r in value] == ["Stacking value"] and value[0]["variant_wape"] == table["Stacking Ensemble"]["wape"]


def test_gaps_in_a_held_out_panel_are_filled(panel, data):
    assert data.fill.medians["precpt"] is not None     # the fitting panel has no gap there
    held = panel.filter(F.col("dt") >= F.lit(START + dt.timedelta(days=75))).withColumn("precpt", F.lit(None).cast("double"))
    early = panel.filter(F.col("dt") < F.lit(START + dt.timedelta(days=75)))
    filled = training.prepare_held_out(early, held, data)
    assert filled.count() == held.count() and filled.filter("precpt is null").count() == 0


def test_held_out_panel_continues_the_training_panel(panel, data):
    cut = F.lit(START + dt.timedelta(days=70))
    early = training.prepare(panel.filter(F.col("dt") < cut))
    held = training.prepare_held_out(panel.filter(F.col("dt") < cut), panel.filter(F.col("dt") >= cut), early)
    names = ["store_id", "dt", "lag_1", "rolling_mean_28", "sin_7d_h1", "series_scale"]
    whole = data.frame.filter(F.col("dt") >= cut).select(names)
    assert held.count() == 200
    pairs = zip(held.select(names).orderBy("store_id", "dt").collect(), whole.orderBy("store_id", "dt").collect())
    for a, b in pairs:
        assert tuple(a)[:2] == tuple(b)[:2] and tuple(a)[2:] == pytest.approx(tuple(b)[2:])


def test_ablations(data):
    scored = training.run_ablations(data, training.Sizes().scaled(trees=3, depth=3))
    assert {r["model"] for r in scored.collect()} == {"observed target", "recovered target", "no Fourier", "per city"}


def test_ablations_and_city_models_are_asked_for_at_full_size(spark, data, monkeypatch):
    class Asked(Exception):
        pass

    def asked(_, settings):
        raise Asked(settings)

    monkeypatch.setattr(catalog_models, "prepared", lambda *_: data)
    for name in ("run_ablations", "fit_cities"):
        monkeypatch.setattr(training, name, asked)
    with pytest.raises(Asked) as arms:
        catalog_models.ablation_run(spark, "")
    sizes = arms.value.args[0]
    assert (sizes.ablation.trees, sizes.ablation.step, sizes.group.trees) == (2000, 0.03, 2000)  # 30 rounds of step 0.3 before
    with pytest.raises(Asked) as cities:
        catalog_models.per_city_models(spark, "")
    assert (cities.value.args[0].trees, cities.value.args[0].step) == (2000, 0.03)

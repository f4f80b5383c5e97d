import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tillcast.operators import backtest, importance, neighbors, per_group, report, ridge, stacking, trees
from tillcast.session import shared_path
from tillcast.sources import models as store
from tillcast.sources import sinks

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        a, b, c = rng.gauss(0, 2), rng.random(), rng.choice([0.0, 1.0])
        # City 1 holds most rows.
        rows.append((i, rng.choice([1, 1, 1, 2, 3]), a, b, c, 3 * a - b + 2 * c + rng.gauss(0, 0.1),
                     rng.choice([0.25, 0.5, 1.0])))
    return spark.createDataFrame(
        rows, "store_id long, city_id int, a double, b double, c double, y double, w double").withColumns({
            "product_id": F.lit(1), "dt": F.date_add(F.lit(START), F.col("store_id").cast("int")),
            "is_stockout": F.lit(0)})


INPUTS = ["a", "b", "c"]


def closed_form(x, y, w, alpha):
    mx, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    xc = x - mx
    beta = np.linalg.solve(xc.T @ (xc * w[:, None]) + alpha * np.eye(x.shape[1]), xc.T @ (w * (y - my)))
    return beta, my - beta @ mx


def arrays(df):
    p = df.toPandas()
    return p[INPUTS].to_numpy(), p["y"].to_numpy(), p["w"].to_numpy()


def test_ridge_pipeline_is_the_closed_form(train):
    x, y, w = arrays(train)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    beta, intercept = closed_form(z, y, w, 10.0)
    expected = z @ beta + intercept
    model = ridge.ridge_pipeline(train, INPUTS, "y", 10.0, "w")
    got = trees.score(model, train, "p").toPandas().sort_values("store_id")["p"].to_numpy()
    order = np.argsort(train.toPandas()["store_id"].to_numpy())
    np.testing.assert_allclose(got, expected[order], rtol=1e-9, atol=1e-9)
    linear = ridge.linear_terms(model, INPUTS).transform(train, "q")
    np.testing.assert_allclose(linear.toPandas().sort_values("store_id")["q"], expected[order], rtol=1e-9, atol=1e-9)


def test_ridge_does_not_depend_on_partitioning(train):
    one = ridge.ridge_from_moments(train.repartition(1), INPUTS, "y", 1.0, "w")
    many = ridge.ridge_from_moments(train.repartition(13), INPUTS, "y", 1.0, "w")
    x, y, w = arrays(train)
    beta, intercept = closed_form(x, y, w, 1.0)
    for model in (one, many):
        np.testing.assert_allclose(list(model.coefficients.values()), beta, rtol=1e-9)
        assert model.intercept == pytest.approx(intercept)


def test_ridge_per_group_equals_a_fit_per_group(train):
    models = per_group.ridge_per_group(train, "city_id", INPUTS, "y", 2.0, "w")
    rows = {r["city_id"]: r for r in models.collect()}
    assert set(rows) == {1, 2, 3}
    for city, row in rows.items():
        beta, intercept = closed_form(*arrays(train.filter(F.col("city_id") == city)), 2.0)
        np.testing.assert_allclose(row["coefficients"], beta, rtol=1e-8)
        assert row["intercept"] == pytest.approx(intercept)


def brute_force(points, targets, ids, query, k):
    d = np.sqrt(((points - query) ** 2).sum(axis=1))
    best = sorted(range(len(d)), key=lambda i: (d[i], ids[i]))[:k]
    d, t = d[best], targets[best]
    return t[d == 0].mean() if (d == 0).any() else (t / d).sum() / (1 / d).sum()


@pytest.mark.parametrize("blocks", [(50_000, 20_000), (40, 16)])
def test_knn_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(200, 12)).round(3)
    points[50:120] = points[50]  # a third of the rows are copies
    targets = rng.random(200)
    queries = np.vstack([rng.normal(size=(30, 12)).round(3), points[50:52], points[3:4]])
    cols = [f"x{i}" for i in range(12)]
    schema = "id string, y double, " + ", ".join(f"{c} double" for c in cols)
    ids = [f"t{i:03d}" for i in range(200)]
    t = spark.createDataFrame([(ids[i], float(targets[i]), *map(float, p)) for i, p in enumerate(points)], schema)
    q = spark.createDataFrame([(f"q{i:03d}", 0.0, *map(float, p)) for i, p in enumerate(queries)], schema)
    got = neighbors.knn_forecast(t, q, cols, "y", "id", k=15, train_block=blocks[0], query_block=blocks[1])
    rows = {r["id"]: r["knn"] for r in got.collect()}
    for i, p in enumerate(queries):
        assert rows[f"q{i:03d}"] == pytest.approx(brute_force(points, targets, ids, p, 15))


def test_far_cells_are_not_visited(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(8, 3)) * 100
    points = np.vstack([m + rng.normal(size=(40, 3)) for m in middles])
    queries = middles + 0.1
    to_rows = lambda x, p: [(f"{p}{i:03d}", float(i), *map(float, v)) for i, v in enumerate(x)]
    schema = "id string, y double, a double, b double, c double"
    t, q = spark.createDataFrame(to_rows(points, "t"), schema), spark.createDataFrame(to_rows(queries, "q"), schema)
    visited, search = [], neighbors._search_cells

    def counted(asked, *args):
        visited.append(asked.count())
        return search(asked, *args)

    neighbors._search_cells = counted
    try:
        got = neighbors.knn_forecast(t, q, ["a", "b", "c"], "y", "id", k=5, train_block=10).collect()
    finally:
        neighbors._search_cells = search
    assert visited[0] == 8 and sum(visited[1:]) < 8 * 31 / 2    # 32 cells
    for r in got:
        far = np.sqrt(((points - [r["a"], r["b"], r["c"]]) ** 2).sum(axis=1))
        near = np.argsort(far)[:5]
        assert r["knn"] == pytest.approx((near / far[near]).sum() / (1 / far[near]).sum())


def test_knn_with_fewer_points_than_neighbours(spark):
    t = spark.createDataFrame([("a", 1.0, 4.0), ("b", 3.0, 8.0)], "id string, x double, y double")
    q = spark.createDataFrame([("q", 2.0, 0.0)], "id string, x double, y double")
    assert neighbors.knn_forecast(t, q, ["x"], "y", "id").first()["knn"] == pytest.approx(6.0)


def stack_frame(spark, n):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        y = rng.random() * 10
        rows.append((f"s{i % 9}", START + dt.timedelta(days=i // 9), y, y + rng.gauss(0, 1), y * 0.9, None if i == 5 else y + 1))
    return spark.createDataFrame(rows, "series_id string, dt date, y double, xgb double, lgb double, rf double")


def test_stack_fits_or_falls_back(spark):
    df = stack_frame(spark, 300)
    stack = stacking.fit_stack(df, ["xgb", "lgb", "rf"], "y", "lgb")
    assert stack.inputs == ["lgb", "rf", "xgb"] and stack.model is not None
    assert stack.transform(df).filter(F.col("stacking").isNull()).count() == 1
    small = stacking.fit_stack(df.limit(100), ["xgb", "lgb", "rf"], "y", "lgb")
    assert small.model is None
    assert small.transform(df).filter(F.col("stacking") != F.col("lgb")).count() == 0


def test_time_ordinal_and_folds(spark):
    df = stack_frame(spark, 103)
    numbered = stacking.add_time_ordinal(df).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in numbered] == list(range(103))
    assert all(a["dt"] <= b["dt"] for a, b in zip(numbered, numbered[1:]))
    frame = spark.range(11).withColumnRenamed("id", "ordinal")
    blocks = [r["block"] for r in stacking.expanding_folds(frame, 11).orderBy("ordinal").collect()]
    assert blocks == [0] * 5 + [1, 1, 2, 2, 3, 3]


def test_cross_validation_matches_direct_fits(spark):
    df = stack_frame(spark, 203)
    scores = stacking.cross_validate_stack(df, ["xgb", "lgb", "rf"], "y")
    data = stacking.add_time_ordinal(df.dropna()).toPandas().sort_values("ordinal")
    x, y = data[["lgb", "rf", "xgb"]].to_numpy(), data["y"].to_numpy()
    size = len(data) // 4
    for fold, n, rmse in scores:
        start = len(data) - (4 - fold) * size
        beta, intercept = closed_form(x[:start], y[:start], np.ones(start), 1.0)
        error = y[start:start + size] - x[start:start + size] @ beta - intercept
        assert n == size and rmse == pytest.approx(np.sqrt((error ** 2).mean()))


def test_best_round_waits_for_patience():
    assert trees.best_round([5, 4, 4.5, 3, 3.5, 3.6, 2], 2) == 4
    assert trees.best_round([5, 4, 4.5, 3, 3.5, 3.6, 2], 5) == 7
    assert trees.best_round([], 3) == 0


SMALL = trees.BOOSTED.sized(trees=12, depth=3, step=0.3, patience=3)


def test_trees_save_load_reuse_and_importance(spark, train):
    model = trees.fit_trees(train, INPUTS, "y", SMALL, "w", validation=train.filter("store_id % 4 = 0"))
    path = shared_path(spark, "test-models")
    store.save_models({"xgboost": model}, path)
    loaded = store.load_models(path)
    assert list(loaded) == ["xgboost"]
    one = trees.score(model, train).orderBy("store_id").collect()
    two = trees.score(loaded["xgboost"], train).orderBy("store_id").collect()
    assert [r["prediction"] for r in one] == [r["prediction"] for r in two]
    flags = {r["model"]: r["loaded"] for r in store.inventory(spark, loaded).collect()}
    assert flags["xgboost"] and not flags["ridge"]
    again = store.fit_or_load(path, "xgboost", lambda: pytest.fail("must not fit"))
    assert again is not None
    assert store.fit_or_load(path, "ridge", lambda: ridge.ridge_pipeline(train, INPUTS, "y")) is not None
    top = importance.ranked(trees.split_importance(spark, model, INPUTS), "importance", 1).first()
    assert top["feature"] == "a"
    few = importance.sample_rows(train, 5).collect()
    assert [r["store_id"] for r in few] == [r["store_id"] for r in importance.sample_rows(train, 80).limit(5).collect()]
    sample = importance.sample_rows(train, 100)
    assert sample.count() == 100
    same = importance.sample_rows(train.repartition(7), 100)
    assert {r["store_id"] for r in sample.collect()} == {r["store_id"] for r in same.collect()}
    grown = importance.permutation_importance(sample, model, INPUTS, "y").collect()
    assert max(grown, key=lambda r: r["wape_growth"])["feature"] == "a" and len(grown) == 3


def test_models_per_group_skip_small_groups(train):
    scored, models = per_group.fit_trees_per_group(
        train, train, "city_id", INPUTS, "y", trees.BOOSTED_GROUP.sized(trees=2, depth=2))
    assert set(models) == {1}
    rows = scored.groupBy("city_id").agg(F.count("prediction").alias("n"), F.count("*").alias("all")).collect()
    assert sum(r["all"] for r in rows) == 300
    assert {r["city_id"]: r["n"] > 0 for r in rows} == {1: True, 2: False, 3: False}


def series(spark, values, name="s"):
    rows = [(name, START + dt.timedelta(days=i), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def test_backtest_windows_and_methods(spark):
    values = [float(i % 7) for i in range(60)]
    values[40] = None  # a missing day counts as zero
    inputs = backtest.rolling_inputs(series(spark, values))
    rows = {r["cutoff"]: r["inputs"] for r in inputs.collect()}
    assert set(rows) == {START + dt.timedelta(days=45), START + dt.timedelta(days=52)}
    expected = [0.0 if i == 40 else float(i % 7) for i in range(23, 53)]
    assert rows[START + dt.timedelta(days=52)] == expected
    got = backtest.forecast(inputs, backtest.FORECASTERS).filter(
        F.col("cutoff") == START + dt.timedelta(days=52)).orderBy("h").collect()
    assert [r["seasonal_naive"] for r in got] == [float((53 + i) % 7) for i in range(7)]
    assert got[0]["moving_average"] == pytest.approx(sum(expected) / 30)
    assert got[2]["drift"] == pytest.approx(expected[-1] + 3 * (expected[-1] - expected[0]) / 29)


def test_robust_scaling_keeps_equivariant_forecasts(spark):
    rng = random.Random(2)
    inputs = backtest.rolling_inputs(series(spark, [rng.random() * 20 for _ in range(60)]))
    plain = backtest.forecast(inputs, backtest.FORECASTERS).orderBy("ds").collect()
    scaled = backtest.forecast(inputs, backtest.FORECASTERS, scaled=True).orderBy("ds").collect()
    for a, b in zip(plain, scaled):
        for name in backtest.FORECASTERS:
            assert a[name] == pytest.approx(b[name])


def test_a_pandas_forecaster_plugs_in(spark):
    inputs = backtest.rolling_inputs(series(spark, [float(i) for i in range(60)]))

    def last_value(batches):
        for b in batches:
            yield b.assign(y_hat=[x[-1] for x in b["inputs"]])[["unique_id", "cutoff", "y_hat"]]

    rows = backtest.forecast_with(inputs, last_value, "unique_id string, cutoff date, y_hat double").collect()
    assert sorted(r["y_hat"] for r in rows) == [45.0, 52.0]


def test_report_and_sinks(spark):
    from tillcast.operators import metrics

    table = spark.createDataFrame([("m1", 1234567, 1.0, 0.5, 0.9, 20.0, -1.0, 0.1), ("m2", 0, None, None, None, None, None, None),
                                   ("m3", 10, 1.0, 0.5, 0.9, 10.0, 1.0, None)],
                                  "model string, n long, rmse double, mae double, r2 double, wape double, wpe double, rho_ds double")
    lines = report.benchmark_report(spark, table, metrics.ablation_deltas(table, {"x": ("m1", "m3"), "y": ("m1", "m2")}),
                                    metrics.best_model(table), spark.createDataFrame(
                                        [(38.471, None, 0.5047, 0.4953, 1444, 32.1)],
                                        "wape double, rmse double, w_first double, w_second double, changed long, changed_pct double"))
    path = shared_path(spark, "report")
    sinks.write_report(lines, path)
    text = [r["value"] for r in spark.read.text(path).collect()]
    assert "| m1 | 1,234,567 | 1.0000 | 0.5000 | 0.9000 | 20.00 | -1.00 | 0.100 |" in text
    assert "| m3 | 10 | 1.0000 | 0.5000 | 0.9000 | 10.00 | 1.00 | N/A |" in text
    assert "**Best model:** m3 (WAPE=10.00%)" in text
    assert "| x | m1 vs m3 | 20.00 vs 10.00 | -10.00 |" in text
    assert "| y | m1 vs m2 | 20.00 vs N/A | N/A |" in text
    assert text[-5:] == ["| Ensemble WAPE | 38.47% |", "| Ensemble RMSE | N/A |", "| First imputer weight | 0.505 |",
                         "| Second imputer weight | 0.495 |", "| Records recovered | 1,444 (32.1%) |"]
    sinks.write_metrics(table, f"{path}-json")
    assert spark.read.json(f"{path}-json").count() == 3
    importances = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "feature string, v double")
    sinks.write_importance(importances, f"{path}-csv", "v")
    assert [r["feature"] for r in spark.read.option("header", True).csv(f"{path}-csv").collect()] == ["b", "a"]


def test_a_whole_run_is_saved_and_scores_the_same_from_disk(spark, train):
    from tillcast.operators.encoding import MedianFill, Standardizer, TargetEncoder
    from tillcast.operators.requests import add_base_predictions, add_ensemble, over_predictions
    from tillcast.operators.ridge import ridge_from_moments
    from tillcast.operators.stacking import Stack, fit_stack
    from tillcast.plans.training import Prepared

    bases = {n: ridge_from_moments(train, INPUTS, "y", alpha) for n, alpha in
             (("xgboost", 1.0), ("lgb_observed", 50.0), ("lgb_recovered", 200.0), ("random_forest", 9.0), ("ridge", 2.0))}
    scored = add_base_predictions(train, bases)
    stack = fit_stack(scored, ["pred_xgboost", "pred_lightgbm", "pred_random_forest"], "y", "pred_lightgbm")
    encoder = TargetEncoder.fit(train.withColumns({"month": F.lit(1), "y_eff": F.col("y")}), ["city_id"])
    data = Prepared(train, encoder, MedianFill.fit(train, INPUTS), START)
    path = shared_path(spark, "run")
    store.save_run(spark, data, {**bases, "stacking": stack}, path)
    models, parts = store.load_run(spark, path)
    assert set(models) == {*bases, "stacking"} and set(parts) == {"encoder", "fill"}
    assert parts["fill"].medians == data.fill.medians and parts["encoder"].overall == encoder.overall
    one = add_ensemble(scored, stack).select("pred_ridge", "pred_ensemble").collect()
    two = add_ensemble(add_base_predictions(train, models), models["stacking"]).select("pred_ridge", "pred_ensemble").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in two]
    assert Stack(["a"], None, "xgboost") and scored.select(over_predictions(Stack(["a"], None, "xgboost"))).columns == ["pred_xgboost"]
    scaler = Standardizer.fit(train, INPUTS)
    store.save_models({"scaler": scaler}, path)
    assert store.load_models(path, ["scaler"])["scaler"] == scaler


def test_a_run_that_fails_half_way_is_never_loaded(spark, train, monkeypatch):
    from tillcast.operators.encoding import MedianFill, TargetEncoder
    from tillcast.operators.ridge import ridge_from_moments
    from tillcast.plans.training import Prepared

    encoder = TargetEncoder.fit(train.withColumns({"month": F.lit(1), "y_eff": F.col("y")}), ["city_id"])
    data = Prepared(train, encoder, MedianFill.fit(train, INPUTS), START)
    model = lambda alpha: ridge_from_moments(train, INPUTS, "y", alpha)
    path = shared_path(spark, "runs")
    with pytest.raises(FileNotFoundError):
        store.load_run(spark, path)
    first = store.save_run(spark, data, {"ridge": model(1.0), "xgboost": model(2.0)}, path)
    real, written = store.save_part, []

    def fails(spark, part, at):
        if len(written) == 2:
            raise OSError("disk full")
        written.append(at)
        real(spark, part, at)

    monkeypatch.setattr(store, "save_part", fails)
    with pytest.raises(OSError):
        store.save_run(spark, data, {"ridge": model(50.0), "xgboost": model(60.0)}, path)
    monkeypatch.undo()
    models, _ = store.load_run(spark, path)
    assert models["ridge"].coefficients == model(1.0).coefficients
    second = store.save_run(spark, data, {"ridge": model(50.0)}, path)
    assert [v for v, _ in store.versions(spark, path)] == [first, second]
    assert store.load_run(spark, path)[0]["ridge"].coefficients == model(50.0).coefficients
    assert set(store.load_run(spark, path, first)[0]) == {"ridge", "xgboost"}


def test_rounds_are_cut_off_without_a_second_fit(train):
    settings = trees.BOOSTED.sized(trees=12, depth=2, min_rows=1, step=0.3, rows=1.0, columns="all", patience=0)
    full = trees.fit_trees(train, INPUTS, "y", settings)
    short = trees.fit_trees(train, INPUTS, "y", settings.sized(trees=5))
    cut = PipelineModel(stages=[full.stages[0], trees.first_rounds(full.stages[1], 5)])
    key = ["store_id", "prediction"]
    one = [tuple(r) for r in trees.score(cut, train).select(key).orderBy("store_id").collect()]
    assert one == [tuple(r) for r in trees.score(short, train).select(key).orderBy("store_id").collect()]
    assert len(one) == train.count()


def test_boosting_stops_by_patience(spark, train):
    noise = train.withColumn("y", F.rand(3))
    model = trees.fit_trees(noise, INPUTS, "y", trees.BOOSTED.sized(trees=30, depth=4, min_rows=1, step=0.5, patience=3),
                            validation=train.withColumn("y", F.rand(5)))
    assert 0 < model.stages[-1].getNumTrees < 30


@pytest.mark.parametrize("features", [3, 30])
def test_a_block_is_searched_box_by_box(monkeypatch, features):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(4000, features)).round(2)
    points[:900] = points[0]
    queries = np.vstack([rng.normal(size=(40, features)).round(2), points[:1]])
    ids, targets = np.array([f"t{i:04d}" for i in rng.permutation(4000)]), rng.random(4000)
    measured, plain = [], neighbors._distances
    monkeypatch.setattr(neighbors, "_distances", lambda q, p: measured.append(len(p)) or plain(q, p))
    query, distance, found, _ = neighbors.nearest_in_block(queries, np.arange(41), points, ids, targets, 15)
    monkeypatch.undo()
    for i, q in enumerate(queries):
        far = neighbors._distances(q, points)
        best = np.lexsort((ids, far))[:15]
        assert [n for n, o in zip(found, query) if o == i] == list(ids[best])
        assert [d for d, o in zip(distance, query) if o == i] == list(far[best])
    near = neighbors.nearest_in_block(queries, np.arange(41), points, ids, targets, 15, np.full(41, 0.5))
    kept = {(q, n) for q, n, d in zip(near[0], near[2], near[1]) if d <= 0.5}
    assert kept == {(q, n) for q, n, d in zip(query, found, distance) if d <= 0.5}
    if features == 3:
        assert sum(measured) < 41 * 4000 / 2


@pytest.mark.parametrize("train_block", [10, 1000])
def test_queries_of_one_id_count_each_pair_once(spark, train_block):
    points = [float(i) for i in range(60)]
    asked = [("q", 20.4), ("q", 41.3), ("r", 7.0)]
    t = spark.createDataFrame([(f"t{i:02d}", x, x) for i, x in enumerate(points)], "id string, x double, y double")
    q = spark.createDataFrame(asked, "id string, x double")
    found = neighbors.knn_neighbors(t, q, ["x"], "y", "id", k=15, train_block=train_block).collect()
    for name in ("q", "r"):
        pairs = sorted((abs(x - p), f"t{i:02d}") for n, x in asked if n == name for i, p in enumerate(points))
        assert sorted((r["distance"], r["neighbor"]) for r in found if r["query"] == name) == pairs[:15]


def test_filled_panel_keeps_only_the_look_back_columns_asked_for(spark):
    from tillcast.plans.catalog_models import filled_panel

    panel = filled_panel(spark, "/root/testdata/sf0.001", ["lag_1", "series_scale"])
    assert {"lag_1", "series_scale", "split", "sample_weight", "y_eff", "city_id", "discount"} <= set(panel.columns)
    assert not [c for c in panel.columns if c.startswith(("rolling_", "stockout_ratio_", "lag_7", "lag_14"))]
    assert panel.filter("lag_1 is null").count() == 0

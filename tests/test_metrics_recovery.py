import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillcast.operators import hourly, metrics, recovery
from tillcast.plans.recovering import recover_panel

START = dt.date(2024, 1, 1)


def scored(spark, rows):
    return spark.createDataFrame(rows, "sale_amount double, p double, is_stockout int")


def test_metrics_by_hand(spark):
    df = scored(spark, [(10.0, 8.0, 0), (20.0, 25.0, 0), (5.0, 50.0, 1), (7.0, None, 0), (None, 1.0, 0)])
    row = metrics.score_models(df, {"m": "p"}).first()
    assert row["n"] == 2
    assert row["mae"] == pytest.approx(3.5)
    assert row["rmse"] == pytest.approx((29 / 2) ** 0.5)
    assert row["wape"] == pytest.approx(7 / 30 * 100)
    assert row["wpe"] == pytest.approx(3 / 30 * 100)
    assert row["r2"] == pytest.approx(1 - 29 / 50)
    assert row["rho_ds"] > 0.9  # the stockout day has the large error


def test_rho_is_zero_without_stockouts_and_with_the_masked_scope(spark):
    df = scored(spark, [(10.0, 8.0, 0), (20.0, 25.0, 0), (5.0, 50.0, 1)])
    assert metrics.score_models(df.filter("is_stockout = 0"), {"m": "p"}).first()["rho_ds"] == 0.0
    assert metrics.score_models(df, {"m": "p"}, rho_masked=True).first()["rho_ds"] == 0.0


def test_metrics_without_any_prediction_and_of_constant_sales(spark):
    row = metrics.score_models(scored(spark, [(1.0, None, 0)]), {"m": "p"}).first()
    assert row["n"] == 0 and row["wape"] is None and row["rho_ds"] is None
    row = metrics.score_models(scored(spark, [(0.0, 0.0, 0), (0.0, 0.0, 1)]), {"m": "p"}).first()
    assert row["wape"] == 0.0 and row["r2"] == 1.0


def test_group_sizes_add_up_and_wape_bounds_wpe(spark):
    rng = random.Random(5)
    rows = [(rng.random() * 9, rng.random() * 9, rng.choice([0, 0, 1]), rng.choice([1, 1, 1, 2, 3])) for _ in range(400)]
    df = spark.createDataFrame(rows, "sale_amount double, p double, is_stockout int, city_id int")
    total = metrics.score_models(df, {"m": "p"}).first()
    cities = metrics.score_models(df, {"m": "p"}, by=["city_id"]).collect()
    assert sum(r["n"] for r in cities) == total["n"]
    assert all(r["wape"] >= abs(r["wpe"]) - 1e-9 for r in cities)


def test_best_verdict_and_deltas(spark):
    table = spark.createDataFrame([("a", 5, 27.0), ("b", 5, 29.0), ("c", 5, 40.0), ("d", 0, None)],
                                  "model string, n long, wape double")
    assert metrics.best_model(table).first()["model"] == "a"
    verdicts = {r["model"]: r["verdict"] for r in metrics.verdict(table).collect()}
    assert verdicts == {"a": "beats baseline", "b": "near baseline", "c": "below baseline", "d": None}
    deltas = metrics.ablation_deltas(table, {"x": ("a", "c"), "y": ("a", "missing")}).orderBy("ablation").collect()
    assert deltas[0]["delta_wape"] == pytest.approx(13.0) and deltas[1]["delta_wape"] is None


def test_decoupling_score_by_hand(spark):
    rows = [(1, 1, 0, h, s, p) for h, s, p in
            [(0, 10.0, 10.0), (0, 12.0, 12.0), (1, 8.0, 11.0), (2, 6.0, 11.0), (3, 4.0, 11.0), (4, 2.0, 11.0)]]
    rows += [(2, 1, 0, h, 5.0, 5.0) for h in (1, 2, 3, 4)]          # no day in stock: dropped
    rows += [(3, 1, 0, h, 9.0 - h, 9.0 + h) for h in (0, 1, 2, 3)]  # three levels only: dropped
    df = spark.createDataFrame(rows, "store_id long, product_id long, holiday_flag int, stock_hour6_22_cnt int,"
                                     "sale_amount double, sale_amount_pred double")
    scores = {r["method"]: r["decoupling_score"] for r in metrics.decoupling_score(df).collect()}
    assert scores["sale_amount"] == pytest.approx(-1.0)
    assert scores["sale_amount_pred"] == 0.0  # constant: only the weight counts


def hourly_frame(spark, days=40, seed=2):
    rng = random.Random(seed)
    rows = []
    for store in (1, 2):
        for day in range(days):
            date = START + dt.timedelta(days=day)
            sales = [round(rng.random() * 5, 2) for _ in range(24)]
            status = [1 if 6 <= h < 22 and day % 3 == 0 and rng.random() < 0.4 else 0 for h in range(24)]
            seen = [0.0 if s else x for x, s in zip(sales, status)]
            rows.append((store, 9, date, seen, status, sum(seen), sum(status[6:22]),
                         0.1 * (day % 4), int(day % 15 == 0), 0.5, 20.0))
    return spark.createDataFrame(
        rows, "store_id long, product_id long, dt date, hours_sale array<double>, hours_stock_status array<int>,"
              "sale_amount double, stock_hour6_22_cnt int, discount double, holiday_flag int, precpt double,"
              "avg_temperature double")


@pytest.mark.parametrize("imputer", ["weekday", "hour", "ensemble", "regression"])
def test_masked_recovery_changes_stockout_days_only(spark, imputer):
    out = recover_panel(hourly_frame(spark), imputer=imputer, window_days=10)
    rows = out.select("sale_amount", "sale_amount_pred", "stock_hour6_22_cnt").collect()
    assert len(rows) == 80
    for r in rows:
        if r["stock_hour6_22_cnt"] == 0:
            assert r["sale_amount_pred"] == pytest.approx(r["sale_amount"])
        else:
            assert r["sale_amount_pred"] >= r["sale_amount"] - 1e-9
    assert metrics.recovery_metrics(out).first()["in_stock_wape"] == pytest.approx(0.0, abs=1e-9)


def test_direct_recovery_keeps_closed_hours(spark):
    frame = hourly_frame(spark, 10)
    masked = recovery.add_profile_imputations(hourly.add_masked_hours(frame))
    row = recovery.recover(masked, "imputed_hour", "direct").filter("store_id = 1").orderBy("dt").first()
    closed = sum(row["hours_sale"][:6]) + sum(row["hours_sale"][22:])
    assert row["sale_amount_pred"] == pytest.approx(closed + sum(row["imputed_hour"]))
    with pytest.raises(ValueError):
        recovery.recover(masked, "imputed_hour", "other")


def test_an_hour_nobody_observed_is_imputed_as_zero(spark):
    status = [0] * 24
    status[10] = 1
    frame = spark.createDataFrame(
        [(1, 1, START, [1.0] * 24, status), (1, 2, START, [3.0] * 24, status)],
        "store_id long, product_id long, dt date, hours_sale array<double>, hours_stock_status array<int>")
    rows = recovery.add_profile_imputations(hourly.add_masked_hours(frame)).collect()
    for r in rows:
        assert r["imputed_weekday"][4] == 0.0 and r["imputed_weekday"][3] == r["hours_sale"][0]


def test_negative_imputations_are_clipped(spark):
    df = spark.createDataFrame([([-1.0, 2.0],)], "x array<double>")
    assert df.select(recovery.clip_imputed(F.col("x")).alias("x")).first()["x"] == [0.0, 2.0]


def test_window_sequence_is_in_time_order(spark):
    frame = hourly.normalize_covariates(hourly.add_window_index(hourly.add_masked_hours(hourly_frame(spark)), 10))
    row = hourly.window_sequences(frame).filter("store_id = 1 and window_idx = 1").first()
    assert len(row["steps"]) == 160 and all(len(s) == 6 for s in row["steps"])
    day = frame.filter("store_id = 1 and window_idx = 1 and day_in_window = 3").first()
    assert [s[0] for s in row["steps"][48:64]] == day["masked"]
    assert row["steps"][63][5] == 1.0


def test_holdout_hides_one_fold_and_weights_add_up(spark):
    masked = hourly.add_masked_hours(hourly_frame(spark))
    hidden = recovery.hide_fold(masked, folds=5)
    seen = lambda c: F.sum(F.size(F.filter(c, lambda x: x.isNotNull())))
    whole = masked.agg(seen("masked").alias("n")).first()["n"]
    parts = hidden.agg(seen("masked").alias("m"), seen("held").alias("h")).first()
    assert parts["m"] + parts["h"] == whole and 0.15 < parts["h"] / whole < 0.25
    w = recovery.ensemble_weights(masked).first()
    assert w["w_first"] + w["w_second"] == pytest.approx(1.0)
    assert w["w_first"] == pytest.approx(w["wape_second"] / (w["wape_first"] + w["wape_second"]))


def test_draws_are_averaged(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0)], "cell int, imputed double")
    assert {r["cell"]: r["imputed"] for r in recovery.average_draws(df, ["cell"]).collect()} == {1: 3.0, 2: 5.0}

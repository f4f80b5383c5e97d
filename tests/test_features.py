import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillcast.constants import FEATURES, known_at_forecast, features_without
from tillcast.operators import encoding, features, split
from tillcast.schemas import MissingColumns, require_columns
from tillcast.sources.panel import assert_dense, densify, ingest, series_density, with_series_columns

START = dt.date(2024, 1, 1)


def make_panel(spark, lengths, seed=1, gaps=0.0):
    rng = random.Random(seed)
    rows = []
    for s, n in enumerate(lengths):
        for i in range(n):
            if rng.random() >= gaps:
                y = round(rng.random() * 10, 2)
                rows.append((s, 7, s % 2, s % 3, START + dt.timedelta(days=i), y, rng.choice([0, 0, 4, 16]), y * 1.2))
    panel = spark.createDataFrame(
        rows, "store_id long, product_id long, city_id int, first_category_id int, dt date, sale_amount double,"
              "stock_hour6_22_cnt int, sale_amount_pred double")
    return with_series_columns(panel)


def by_pandas(panel):
    frame = panel.toPandas().sort_values(["store_id", "dt"])
    out = []
    for _, g in frame.groupby("store_id"):
        y, r = g["y_eff"], g["stockout_ratio"].shift(1)
        p = y.shift(1)
        g = g.assign(lag_7=y.shift(7), rolling_mean_14=p.rolling(14, min_periods=1).mean(),
                     rolling_std_7=p.rolling(7, min_periods=1).std(),
                     stockout_ratio_28d=r.rolling(28, min_periods=1).mean(),
                     series_scale=p.rolling(90, min_periods=7).mean())
        out.append(g)
    return pd.concat(out)


COLUMNS = ["lag_7", "rolling_mean_14", "rolling_std_7", "stockout_ratio_28d", "series_scale"]


def assert_same(a, b, columns):
    a, b = a.reset_index(drop=True), b.reset_index(drop=True)
    assert len(a) == len(b)
    for c in columns:
        pd.testing.assert_series_equal(a[c].astype(float), b[c].astype(float), check_names=False, rtol=1e-9, atol=1e-9)


def test_series_features_match_pandas(spark):
    panel = make_panel(spark, [120, 40, 1], gaps=0.2)
    got = features.add_series_features(panel).orderBy("store_id", "dt").toPandas()
    assert_same(got, by_pandas(panel), COLUMNS)


@pytest.mark.parametrize("chunk_rows", [90, 97, 400])
def test_chunked_series_give_the_same_result(spark, chunk_rows):
    panel = make_panel(spark, [900, 300, 90, 5], gaps=0.3)
    names = list(features.series_columns(_window()))
    whole = features.add_series_features(panel).orderBy("store_id", "dt").toPandas()
    cut = features.add_series_features(panel, chunk_rows=chunk_rows)
    assert sorted(cut.columns) == sorted(whole.columns)
    assert_same(cut.orderBy("store_id", "dt").toPandas(), whole, names)


def _window():
    from pyspark.sql import Window

    return Window.partitionBy("store_id").orderBy("dt")


def test_features_never_see_their_own_or_later_days(spark):
    panel = make_panel(spark, [60])
    cut = F.lit(START + dt.timedelta(days=40))
    changed = panel.withColumn("y_eff", F.when(F.col("dt") >= cut, 999.0).otherwise(F.col("y_eff")))
    before = features.add_series_features(panel).filter(F.col("dt") <= cut).orderBy("dt").toPandas()
    after = features.add_series_features(changed).filter(F.col("dt") <= cut).orderBy("dt").toPandas()
    assert_same(before, after, COLUMNS)


def test_all_windows_share_one_exchange(spark):
    plan = features.add_series_features(make_panel(spark, [30]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1


def test_rows_with_null_keys_survive_chunks(spark):
    panel = make_panel(spark, [120, 120]).withColumn("store_id", F.when(F.col("store_id") == 0, F.col("store_id")))
    plain = features.add_series_features(panel).orderBy("store_id", "dt")
    cut = features.add_series_features(panel, chunk_rows=95).orderBy("store_id", "dt")
    names = ["store_id", "dt", "lag_7", "rolling_mean_28", "series_scale"]
    assert plain.count() == 240
    assert [tuple(r) for r in cut.select(names).collect()] == [tuple(r) for r in plain.select(names).collect()]


def test_calendar_windows_equal_row_windows_on_a_dense_panel_and_skip_gaps(spark):
    dense = make_panel(spark, [60, 40])
    names = ["store_id", "dt", "lag_7", "rolling_mean_14", "rolling_std_7", "stockout_ratio_28d", "series_scale"]
    by_rows = features.add_series_features(dense).select(names).orderBy("store_id", "dt").collect()
    by_days = features.add_calendar_features(dense).select(names).orderBy("store_id", "dt").collect()
    for a, b in zip(by_rows, by_days):
        assert tuple(a)[:2] == tuple(b)[:2] and tuple(a)[2:] == pytest.approx(tuple(b)[2:])
    gap = features.add_calendar_features(dense.filter(F.dayofmonth("dt") != 5)).filter(
        (F.col("store_id") == 0) & (F.col("dt") == START + dt.timedelta(days=11))).first()
    assert gap["lag_7"] is None
    plan = features.add_calendar_features(dense)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1


def test_calendar_and_fourier(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 12, 29),)], "dt date")
    rows = features.add_fourier(features.add_calendar(df)).orderBy("dt").collect()
    assert [r["day_of_week"] for r in rows] == [6, 0]
    assert [r["is_weekend"] for r in rows] == [1, 0]
    assert [r["week_of_year"] for r in rows] == [52, 1]
    assert rows[1]["sin_7d_h2"] == pytest.approx(math.sin(2 * math.pi * 2 / 7))


def test_split_and_weights(spark):
    panel = split.add_weights(split.add_split(make_panel(spark, [90])))
    counts = {r["split"]: r["count"] for r in panel.groupBy("split").count().collect()}
    assert counts == {"train": 76, "val": 7, "test": 7}
    weights = {r["days_ago"]: r["sample_weight"] for r in panel.collect()}
    assert (weights[30], weights[31], weights[60], weights[61]) == (1.0, 0.5, 0.5, 0.25)


def test_target_encoding_uses_training_rows_and_defaults_to_their_mean(spark):
    rows = [(1, 1, 10.0, "train"), (1, 1, 20.0, "train"), (2, 1, 40.0, "train"), (3, 1, 9.0, "test"),
            (1, 1, 999.0, "test"), (None, 1, 5.0, "test")]
    df = spark.createDataFrame(rows, "city_id int, month int, y_eff double, split string")
    fitted = encoding.TargetEncoder.fit(df.filter("split = 'train'"), ["city_id"])
    got = [(r["city_id"], r["city_id_te"]) for r in fitted.transform(df).filter("split = 'test'").collect()]
    mean = 70 / 3
    assert dict(got) == {3: pytest.approx(mean), None: pytest.approx(mean),
                         1: pytest.approx((30 + mean * 100) / 102)}


def test_median_fill_and_standardizer(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (10.0, None)], "a double, b double")
    fill = encoding.MedianFill.fit(df, ["a", "b"])
    filled = fill.transform(df)
    assert [r["a"] for r in filled.collect()] == [1.0, 2.0, 2.0, 10.0]
    scaled = encoding.Standardizer.fit(filled, ["a", "b"]).transform(filled).collect()
    assert [r["b"] for r in scaled] == [0.0] * 4


def test_ingest_turns_nan_in_hours_into_null(spark):
    df = spark.createDataFrame([([1.0, float("nan")], "2024-01-01")], "h array<double>, dt string")
    assert ingest(df).first()["h"] == [1.0, None]


def test_ingest_turns_nan_into_null(spark):
    df = spark.createDataFrame([(float("nan"), "2024-01-01")], "x double, dt string")
    row = ingest(df).first()
    assert row["x"] is None and row["dt"] == START


def test_density_and_densify(spark):
    panel = make_panel(spark, [10, 10], gaps=0.3)
    assert {r["dense"] for r in series_density(panel).collect()} != {True}
    dense = densify(panel.select("store_id", "product_id", "dt", "sale_amount"), start="2024-01-01", end="2024-01-10")
    assert {r["dense"] for r in series_density(dense, horizon=10).collect()} == {True}
    total = lambda d: d.agg(F.sum("sale_amount")).first()[0]
    assert total(dense) == pytest.approx(total(panel))
    assert_dense(dense, 10)
    with pytest.raises(ValueError):
        assert_dense(panel, 10)


def test_registry():
    assert len(FEATURES) == len(set(FEATURES)) == 45
    assert len(features_without(("sin_", "cos_"))) == 33
    assert len(known_at_forecast()) == 42


def test_require_columns(spark):
    with pytest.raises(MissingColumns):
        require_columns(spark.range(1), ["sale_amount_pred"])


def test_densify_shuffles_the_panel_and_not_its_grid(spark):
    day = lambda n: START + dt.timedelta(days=n)
    rows = [(1, 1, day(2), 5, 2.0), (1, 1, day(4), 5, 3.0), (1, 1, day(4), 5, 4.0), (2, 1, None, 6, 9.0), (None, 1, day(3), 7, 8.0),
            (3, 1, day(0), 8, None), (3, 1, day(9), 8, 1.0), (4, 1, day(30), 9, 1.0)]
    panel = spark.createDataFrame(rows, "store_id long, product_id long, dt date, city_id int, sale_amount double")
    dense = densify(panel, ["city_id"], start="2024-01-01", end="2024-01-10")
    got = {}
    for r in dense.collect():
        got.setdefault((r["store_id"], r["city_id"]), []).append(((r["dt"] - START).days, r["sale_amount"]))
    zero = {n: [0.0] for n in range(10)}
    for key, known in {(1, 5): {2: [2.0], 4: [3.0, 4.0]}, (2, 6): {}, (None, 7): {}, (3, 8): {9: [1.0]}, (4, 9): {}}.items():
        expected = sorted((n, x) for n, xs in {**zero, **known}.items() for x in xs)
        assert sorted(got.pop(key)) == expected
    assert not got
    totals = dense.groupBy("store_id", "product_id", "city_id").agg(F.sum("sale_amount"))
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_density_counts_days_without_keeping_them_as_rows(spark):
    rows = [(1, 1, START + dt.timedelta(days=n)) for n in (0, 1, 62, 63, 64, 64, 200)] + [(2, 1, None), (None, 1, START), (3, 1, dt.date(1969, 12, 31)), (3, 1, dt.date(1970, 1, 1))]
    found = series_density(spark.createDataFrame(rows, "store_id long, product_id long, dt date"))
    got = {r["store_id"]: (r["n_rows"], r["n_gaps"], r["n_repeats"], r["dense"]) for r in found.collect()}
    assert got == {1: (7, 195, 1, False), 2: (1, None, 1, False), None: (1, 0, 0, True), 3: (2, 0, 0, True)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in plan and "Expand" not in plan

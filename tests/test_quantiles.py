import random
import statistics

import pytest

from tillcast.operators.quantiles import exact_medians


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = [(
        rng.gauss(0, 1), float(rng.choice([0, 0, 0, 0, 7])), float(i % 2), None,
        rng.random() if i % 3 else None, float(i)) for i in range(4000)]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double")


@pytest.mark.parametrize("max_rows", [1_000_000, 50, 1])
def test_medians_are_exact_however_small_the_final_step_must_be(frame, max_rows):
    rows, df = frame
    got = exact_medians(df, df.columns, max_rows)
    for i, name in enumerate(df.columns):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[name] == (statistics.median(values) if values else None), name


def test_two_tied_halves(spark):
    df = spark.createDataFrame([(1.0,)] * 500 + [(2.0,)] * 500, "x double")
    assert exact_medians(df, ["x"], max_rows=1) == {"x": 1.5}


@pytest.mark.parametrize("low, high, between", [
    (500, 500, 41), (500, 460, 41), (460, 500, 41), (520, 500, 20), (500, 520, 20), (520, 500, 19), (500, 501, 0), (400, 400, 1)])
def test_many_values_between_two_frequent_ones(spark, low, high, between):
    values = [0.0] * low + [100.0] * high + [10 + i / 7 for i in range(between)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert exact_medians(df, ["x"], max_rows=5) == {"x": pytest.approx(statistics.median(values))}


def test_single_row_and_no_rows(spark):
    df = spark.createDataFrame([(4.0,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": 4.0}
    assert exact_medians(df.limit(0), ["x"]) == {"x": None}


def test_values_are_sketched_and_counted_as_arrays_in_two_passes(spark, monkeypatch):
    from tillcast.operators import quantiles

    passes = []
    for name in ("_sketch", "_count"):
        own = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *a, own=own, name=name: passes.append((name, own(*a))) or passes[-1][1])
    rng = random.Random(5)
    rows = [(rng.gauss(0, 1), float(i % 3), None if i % 2 else rng.random()) for i in range(60_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    got = exact_medians(df, df.columns)
    assert got == {c: statistics.median([r[i] for r in rows if r[i] is not None]) for i, c in enumerate("abc")}
    assert [name for name, _ in passes] == ["_sketch", "_count"]
    counts, inside = passes[1][1]
    assert counts["a"][2] < 600 and inside.where("name = 'b'").groupBy("value").count().count() == 1


def test_nan_lies_above_all_numbers_and_zeros_are_one_value(spark):
    nan = float("nan")
    rows = [(nan, 1.0, -0.0 if i % 2 else 0.0, float("inf"), nan if i else 2.0) for i in range(3)] + [(None, nan, 0.0, 1.0, 5.0)]
    got = exact_medians(spark.createDataFrame(rows, "a double, b double, c double, d double, e double"), list("abcde"), max_rows=1)
    assert got["a"] != got["a"] and got["e"] != got["e"]
    assert (got["b"], got["c"], got["d"]) == (1.0, 0.0, float("inf"))

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillcast.operators import bins, boosting
from tillcast.operators.trees import TreeSettings

INPUTS = ["a", "b", "c"]
PLAIN = TreeSettings("boosted", trees=1, depth=3, min_rows=5, columns="all", rows=1.0, step=1.0)


def frame(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[:, 2] = rng.integers(0, 3, n)
    y = np.where(x[:, 0] > 0.3, 3.0, -1.0) + x[:, 1] ** 2 + x[:, 2] + rng.normal(size=n) / 10
    found = pd.DataFrame(x, columns=INPUTS).assign(id=np.arange(n), y=y, z=-y, w=rng.choice([0.5, 1.0, 2.0], n), city=rng.integers(0, 3, n))
    return spark.createDataFrame(found).repartition(4), found


def binned(spark_frame, weight="w", **options):
    return bins.bin_rows(spark_frame, INPUTS, ["id", "y", "z", "w", "city"], weight, **options)


def predictions(model, found):
    return model.predict(found[INPUTS].to_numpy())


def test_thinned_summaries_keep_ranks():
    rng = np.random.default_rng(2)
    values, weights = rng.lognormal(size=200_000), rng.choice([0.25, 1.0, 4.0], 200_000)
    parts = [bins.Summary(256) for _ in range(7)]
    for i, part in enumerate(parts):
        for at in np.array_split(np.arange(i, len(values), 7), 9):
            part.add(values[at], weights[at])
    whole = bins.Summary(256)
    for part in parts:
        for p in part.parts():
            whole.merge(*p)
    assert sum(len(p[1]) for p in whole.parts()) <= 256 * (len(whole.levels) + 4)
    order = np.argsort(values)
    ranks = np.cumsum(weights[order]) / weights.sum()
    edges = whole.edges(32)
    at = ranks[np.searchsorted(values[order], edges, side="right") - 1]
    assert len(edges) == 31 and np.abs(at - np.arange(1, 32) / 32).max() <= (max(whole.levels) + 2) / 256


def test_bins_hold_few_values_apart_and_nulls_last(spark):
    rows = [(i, float(i % 4), None if i % 5 == 0 else float(i), 7.0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(3)
    found = bins.bin_rows(df, ["a", "b", "c"], ["id"], bins=16)
    assert found.edges[0].tolist() == [0.0, 1.0, 2.0] and not len(found.edges[2])
    out = {r.id: list(r.bins) for r in found.frame.collect()}
    for i, a, b, _ in rows:
        assert out[i][0] == int(a) and out[i][2] == 0
        assert out[i][1] == (len(found.edges[1]) if b is None else int(np.searchsorted(found.edges[1], b)))
    assert bins.bin_rows(df.limit(0), ["a"], ["id"]).frame.collect() == []


@pytest.mark.parametrize("l1, l2", [(0.0, 0.0), (1.5, 4.0)])
def test_leaf_values_are_soft_thresholded_means(spark, l1, l2):
    df, found = frame(spark)
    model = boosting.fit_models(binned(df), {"m": "y"}, PLAIN.sized(l1=l1, l2=l2), ["id"], weight="w")["m"]
    base = np.average(found["y"], weights=found["w"])
    leaf = model.leaves(found[INPUTS].to_numpy())[:, 1]
    assert len(np.unique(leaf)) > 4
    for one in np.unique(leaf):
        own = found[leaf == one]
        g, h = float((own["w"] * (base - own["y"])).sum()), float(own["w"].sum())
        assert model.value[one] == pytest.approx(-np.sign(g) * max(abs(g) - l1, 0) / (h + l2))
        assert model.cover[one] == pytest.approx(h) and len(own) >= 5


def brute(x, y, w, leaves, min_rows):
    """Leaf-wise growth over all cuts between values: the prediction of each row."""
    open_, done = [np.arange(len(y))], []

    def best(at):
        found = (1e-6, None)
        whole = np.sum(w[at] * y[at]) ** 2 / np.sum(w[at])
        for f in range(x.shape[1]):
            for cut in np.unique(x[at, f])[:-1]:
                left, right = at[x[at, f] <= cut], at[x[at, f] > cut]
                if min(len(left), len(right)) >= min_rows:
                    gain = sum(np.sum(w[p] * y[p]) ** 2 / np.sum(w[p]) for p in (left, right)) - whole
                    if gain > found[0] + 1e-9:
                        found = (gain, (left, right))
        return found

    scored = [(best(at), at) for at in open_]
    while len(scored) + len(done) < leaves and any(s[0][1] for s in scored):
        i = max(range(len(scored)), key=lambda k: scored[k][0][0] if scored[k][0][1] else -1)
        (_, parts), _ = scored.pop(i)
        scored += [(best(p), p) for p in parts]
    out = np.zeros(len(y))
    for _, at in scored:
        out[at] = np.average(y[at], weights=w[at])
    return out


@pytest.mark.parametrize("task_rows", [10 ** 6, 150])
def test_leaf_wise_growth_equals_brute_force_in_one_task_and_over_jobs(spark, task_rows):
    rng = np.random.default_rng(3)
    n = 400
    found = pd.DataFrame({"a": rng.integers(0, 40, n) / 4, "b": rng.integers(0, 30, n) / 2, "c": rng.integers(0, 5, n) * 1.0})
    y = np.exp(found["a"] / 2) + found["b"] * found["c"] + rng.normal(size=n)
    found = found.assign(id=np.arange(n), y=y - np.average(y), z=0.0, w=1.0, city=0)
    df = spark.createDataFrame(found).repartition(3)
    settings = PLAIN.sized(depth=0, leaves=25, min_rows=4)
    model = boosting.fit_models(binned(df), {"m": "y"}, settings, ["id"], task_rows=task_rows)["m"]
    base = found["y"].mean()
    expected = base + brute(found[INPUTS].to_numpy(), (found["y"] - base).to_numpy(), found["w"].to_numpy(), 25, 4)
    np.testing.assert_allclose(predictions(model, found), expected, atol=1e-9)
    assert int((model.feature < 0).sum()) - 1 == 25


def test_a_bound_on_leaves_allows_deep_trees(spark):
    n = 3000
    x = np.arange(n) / 7.0
    found = pd.DataFrame({"a": x, "b": np.sin(x), "c": 0.0, "id": np.arange(n), "y": np.exp(x / 12), "z": 0.0, "w": 1.0, "city": 0})
    settings = PLAIN.sized(depth=0, leaves=60, min_rows=1, bins=256)
    model = boosting.fit_models(binned(spark.createDataFrame(found), bins=256), {"m": "y"}, settings, ["id"])["m"]
    depth = {0: 0}
    nodes = model.nodes[model.nodes["tree"] == 0].set_index("node")
    for node in nodes.index:
        if nodes.at[node, "feature"] >= 0:
            depth[nodes.at[node, "left"]] = depth[nodes.at[node, "right"]] = depth[node] + 1
    assert max(depth.values()) > 8 and int((nodes["feature"] < 0).sum()) == 60


@pytest.mark.parametrize("kind, leaves", [("boosted", 0), ("boosted", 9), ("forest", 0)])
def test_jobs_and_tasks_grow_the_same_trees(spark, kind, leaves):
    """Sampling of rows and columns, penalties, early stop: all the same wherever a node is split."""
    df, found = frame(spark, 900)
    settings = TreeSettings(kind, trees=12, depth=0 if leaves else 4, leaves=leaves, min_rows=8, columns="0.7", rows=0.8, step=0.3,
                            patience=4, l1=0.1 if kind == "boosted" else 0.0, l2=1.0 if kind == "boosted" else 0.0)
    data = binned(df)
    one, many = (boosting.fit_models(data, {"m": "y", "o": "z"}, settings, ["id"], "id % 5 = 0", "w", task_rows=rows)
                 for rows in (10 ** 6, 100))
    for name in "mo":
        assert one[name].trees == many[name].trees and one[name].rounds == many[name].rounds
        np.testing.assert_allclose(predictions(one[name], found), predictions(many[name], found), atol=1e-9)
    assert np.corrcoef(predictions(one["m"], found), found["y"])[0, 1] > 0.9


@pytest.mark.parametrize("task_rows", [10 ** 6, 60])
def test_fitting_stops_in_the_round_in_which_patience_is_used_up(spark, task_rows):
    df, found = frame(spark, 300)
    noise = df.withColumn("y", F.rand(3))
    model = boosting.fit_models(binned(noise), {"m": "y"}, PLAIN.sized(trees=40, step=0.5, patience=3), ["id"], "id % 3 = 0",
                                task_rows=task_rows)["m"]
    assert model.rounds < 40 and model.trees == model.rounds - 3
    x, y = found[INPUTS].to_numpy(), noise.toPandas().set_index("id")["y"].sort_index().to_numpy()
    held = found["id"].to_numpy() % 3 == 0
    part, losses = model.value[model.leaves(x)], []
    for rounds in range(1, model.trees + 1):
        losses.append(np.mean((part[held, :rounds + 1].sum(1) - y[held]) ** 2))
    assert min(losses) == losses[-1]


def test_one_fit_for_all_groups_equals_separate_fits(spark):
    df, found = frame(spark)
    settings = PLAIN.sized(trees=5, step=0.3)
    data = binned(df)
    nodes = boosting.fit_lanes(boosting.lane_rows(data, "city", "y", ["id"], weight="w"), data.edges, settings)
    models = boosting.models_of(nodes, INPUTS)
    assert set(models) == {"0", "1", "2"}
    for city in (0, 2):
        own = bins.Binned(data.frame.where(F.col("city") == city), data.inputs, data.edges)
        alone = boosting.fit_models(own, {"m": "y"}, settings, ["id"], weight="w")["m"]
        np.testing.assert_allclose(predictions(alone, found), predictions(models[str(city)], found))
    more = df.select("id", "city", *INPUTS).unionByName(spark.createDataFrame([(-1, 9, 0.0, 0.0, 0.0), (-2, None, 0.0, 0.0, 0.0)],
                                                                              "id long, city long, a double, b double, c double"))
    scored = {r.id: r.p for r in boosting.score_groups(more, nodes, "city", INPUTS, "p", rows_per_task=50).collect()}
    assert scored.pop(-1) is None and scored.pop(-2) is None and len(scored) == len(found)
    for city, part in found.groupby("city"):
        np.testing.assert_allclose([scored[i] for i in part["id"]], predictions(models[str(city)], part))


def test_fewer_inputs_use_the_same_bins(spark):
    df, found = frame(spark)
    model = boosting.fit_models(binned(df), {"m": "y"}, PLAIN, ["id"], weight="w", inputs=["c", "a"])["m"]
    again = boosting.fit_models(bins.bin_rows(df, ["c", "a"], ["id", "y", "w"], "w"), {"m": "y"}, PLAIN, ["id"], weight="w")["m"]
    x = found[["c", "a"]].to_numpy()
    np.testing.assert_allclose(model.predict(x), again.predict(x))


def test_scoring_in_spark_nulls_and_importance(spark):
    df, found = frame(spark)
    model = boosting.fit_models(binned(df), {"m": "y"}, PLAIN.sized(trees=8, step=0.4), ["id"], weight="w")["m"]
    scored = model.transform(df.unionByName(spark.createDataFrame([(-1, None)], "id long, a double"), allowMissingColumns=True), "p")
    got = {r.id: r.p for r in scored.collect()}
    np.testing.assert_allclose([got[i] for i in found["id"]], predictions(model, found))
    assert got[-1] == pytest.approx(predictions(model, pd.DataFrame([[np.nan] * 3], columns=INPUTS))[0])
    shares = model.importance()
    assert sum(shares.values()) == pytest.approx(1.0) and max(shares, key=shares.get) == "a"


def test_empty_and_constant_targets(spark):
    df, found = frame(spark, 50)
    assert boosting.fit_models(binned(df.limit(0)), {"m": "y"}, PLAIN, ["id"]) == {}
    flat = boosting.fit_models(binned(df.withColumn("y", F.lit(2.0))), {"m": "y"}, PLAIN.sized(trees=3), ["id"])["m"]
    np.testing.assert_allclose(predictions(flat, found), 2.0)


def test_attributions_add_up_and_equal_all_orders(spark):
    """Shapley values over every order of the features, with unknown features followed by cover."""
    from itertools import permutations

    from tillcast.operators import attribution

    df, found = frame(spark, 200)
    model = boosting.fit_models(binned(df), {"m": "y"}, PLAIN.sized(trees=3, step=0.5), ["id"], weight="w")["m"]
    x = found[INPUTS].to_numpy()[:12]

    def expected(row, known, node):
        f = model.feature[node]
        if f < 0:
            return model.value[node]
        left, right = model.left[node], model.right[node]
        if f in known:
            return expected(row, known, left if row[f] <= model.threshold[node] else right)
        return (model.cover[left] * expected(row, known, left) + model.cover[right] * expected(row, known, right)) / model.cover[node]

    brute = np.zeros((len(x), 3))
    for i, row in enumerate(x):
        value = lambda known: sum(expected(row, known, r) for r in model.roots)
        for order in permutations(range(3)):
            for k, f in enumerate(order):
                brute[i, f] += (value(set(order[:k + 1])) - value(set(order[:k]))) / 6
    np.testing.assert_allclose(attribution.attribute(attribution.leaf_paths(model), x, 3), brute, atol=1e-9)
    rows = attribution.tree_attributions(model.transform(df, "p"), model, ["id", "p"]).collect()
    assert len(rows) == 200
    for r in rows:
        assert sum(r["values"]) + r["base"] == pytest.approx(r["p"])
    top = {r.feature: r.mean_abs for r in attribution.mean_attribution(
        attribution.tree_attributions(df, model, ["id"]), INPUTS).collect()}
    assert max(top, key=top.get) == "a" and len(top) == 3


def test_tree_models_are_saved_and_shuffled(spark):
    from tillcast.operators import importance
    from tillcast.session import shared_path
    from tillcast.sources import models as store

    df, found = frame(spark)
    model = boosting.fit_models(binned(df), {"m": "y"}, PLAIN.sized(trees=4, step=0.5), ["id"], weight="w")["m"]
    path = shared_path(spark, "test-models")
    store.save_models({"xgboost": model}, path)
    loaded = store.load_models(path)["xgboost"]
    np.testing.assert_array_equal(predictions(loaded, found), predictions(model, found))
    one = {r.feature: r.wape_growth for r in importance.permutation_importance(df, model, INPUTS, "y", ["id"], 90).collect()}
    rows = df.select("id", "y", *INPUTS)

    class Plain:
        """The same model without its type, scored as any other."""

        def transform(self, frame, output):
            return model.transform(frame, output)

    two = {r.feature: r.wape_growth for r in importance.permutation_importance(rows, Plain(), INPUTS, "y", ["id"], 90).collect()}
    assert one == pytest.approx(two) and max(one, key=one.get) == "a"


def test_fewer_rounds_take_larger_steps():
    from tillcast.plans.training import Sizes

    sizes = Sizes().within(50)
    assert sizes.boosted.trees == 50 and sizes.boosted.step == 0.3 and sizes.boosted.depth == Sizes().boosted.depth
    assert sizes.fine.leaves == 255 and sizes.boosted.patience == 8 and Sizes().within(10 ** 6) == Sizes()


def test_large_lanes_lie_in_blocks_of_one_lane(spark):
    df, found = frame(spark, 900)
    rows = boosting.lane_rows(binned(df), "city", "y", ["id"], "id % 5 = 0", "w")
    out = boosting._blocks(rows, {"0": 0.5, "1": 1.5, "2": 2.5}, 3).collect()
    assert len({r.block for r in out}) == len(out) and sum(r.n for r in out) == len(found)
    for lane in (0, 1, 2):
        own = found[found["city"] == lane]
        for held in (False, True):
            parts = [r for r in out if r.lane == str(lane) and r.held == held]
            y = np.concatenate([np.frombuffer(r.y) for r in parts])
            np.testing.assert_allclose(np.sort(y), np.sort(own.loc[(own["id"] % 5 == 0) == held, "y"]))
            assert all(len(r.bins) == 3 * r.n <= 3 * boosting.BLOCK_ROWS and set(np.frombuffer(r.margin)) == {lane + 0.5} for r in parts)


def test_a_bound_on_leaves_bounds_the_nodes_that_are_asked_for(spark, monkeypatch):
    """Leaf-wise trees over jobs grow nothing below nodes that the bound leaves out."""
    df, _ = frame(spark, 900)
    asked, split = [], boosting._split_nodes
    monkeypatch.setattr(boosting, "_split_nodes", lambda b, units, *a: asked.append(sum(len(u.asked) for u in units)) or split(b, units, *a))
    settings = PLAIN.sized(depth=0, leaves=4, min_rows=1)
    boosting.fit_models(binned(df), {"m": "y"}, settings, ["id"], task_rows=20)
    assert max(asked) <= 6 and sum(asked) < 24  # two children of at most three splits a level; 8 and 82 before


def test_many_asked_nodes_are_summed_in_several_jobs(spark, monkeypatch):
    df, found = frame(spark, 900)
    data, settings = binned(df), PLAIN.sized(depth=5, min_rows=2)
    whole = boosting.fit_models(data, {"m": "y", "o": "z"}, settings, ["id"], task_rows=100)
    monkeypatch.setattr(boosting, "MOST_NODES", 3)
    parts = boosting.fit_models(data, {"m": "y", "o": "z"}, settings, ["id"], task_rows=100)
    for name in "mo":
        np.testing.assert_allclose(predictions(whole[name], found), predictions(parts[name], found), atol=1e-9)


def test_shuffled_features_send_only_rows_down_again_that_they_move(spark):
    df, found = frame(spark)
    model = boosting.fit_models(binned(df), {"m": "y"}, PLAIN.sized(trees=4, step=0.5), ["id"], weight="w")["m"]
    on_path, x = model.on_path(), found[INPUTS].to_numpy()
    for i in range(3):
        moved = x.copy()
        moved[:, i] = moved[::-1, i]
        before, after = model.leaves(x), model.leaves(moved)
        assert not ((before != after) & ~on_path[before, i]).any()
        some = np.flatnonzero(found["id"] % 3 == 0)
        for root in model.roots:
            np.testing.assert_array_equal(model.leaf(x.T, root, some), model.leaf(x.T, root)[some])


def test_nodes_move_however_few_levels_they_have_and_blocks_stay_in_memory(spark, monkeypatch):
    """Jobs read the whole lane, so a node with two levels to go moves, too; only a lane's blocks are held, until its fit ends."""
    df, found = frame(spark, 900)
    data, held, split = binned(df), [], boosting._split_nodes
    monkeypatch.setattr(boosting, "_split_nodes", lambda b, *a: held.append(b.storageLevel) or split(b, *a))
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    moved = boosting.fit_models(data, {"m": "y"}, PLAIN, ["id"], "id % 5 = 0", task_rows=650)["m"]
    assert len(held) == 1  # three jobs before, one a level
    assert held[0].useMemory and not held[0].useDisk
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    whole = boosting.fit_models(data, {"m": "y"}, PLAIN, ["id"], "id % 5 = 0")["m"]
    np.testing.assert_allclose(predictions(whole, found), predictions(moved, found), atol=1e-9)

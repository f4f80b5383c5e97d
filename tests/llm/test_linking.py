import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import linking, numbering


def _roots(n, edges):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_random_graphs_and_a_long_path(spark, seed):
    rng = np.random.default_rng(seed)
    n = 300
    edges = [tuple(map(int, rng.integers(0, 200, 2))) for _ in range(150)] + [(i, i + 1) for i in range(220, 299)]
    found = {r.id: r.comp for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [found.get(i, i) for i in range(n)] == _roots(n, edges)


def test_no_edges(spark):
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_link_misses_no_pair_that_shares_a_key(spark):
    """Links along a chain of neighbours: the pivot of the one large key is far from most rows."""
    rng = np.random.default_rng(3)
    place = {i: int(v) for i, v in enumerate(rng.permutation(120) * 2 + (rng.random(120) < 0.2))}
    rows = spark.createDataFrame([(7, i, v) for i, v in place.items()], "key long, id long, v long")
    def near(x, y):
        return F.abs(x("v") - y("v")) <= 10

    def verify(pairs, loads):
        found = pairs.collect()
        return spark.createDataFrame([(r.a, r.b) for r in found if abs(place[r.a] - place[r.b]) <= 2], "a long, b long")

    def kernel(left, right):
        return np.abs(left["load"].to_numpy()[:, None] - right["load"].to_numpy()) <= 2

    def load(ids):
        return ids.join(rows.select("id", F.col("v").alias("load")), "id")

    found = {r.id: r.comp for r in linking.link(rows, near, verify, load, kernel, tile=16).collect()}
    edges = [(a, b) for a in place for b in place if a < b and abs(place[a] - place[b]) <= 2]
    assert [found.get(i, i) for i in place] == _roots(len(place), edges)


def test_a_group_of_copies_is_not_listed_pair_by_pair(spark):
    rows = spark.range(400).select(F.lit(1).cast("long").alias("key"), "id")
    sizes = []

    def verify(pairs, loads):
        sizes.append(pairs.count())
        return pairs

    found = linking.link(rows, lambda x, y: F.lit(True), verify, lambda ids: ids, None).collect()
    assert {r.comp for r in found} == {0} and len(found) == 400
    assert sum(sizes) < 400


@pytest.mark.parametrize("blocks", [1, 7])
def test_running_sum(spark, blocks):
    df = spark.range(500).withColumn("part", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 3)) \
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("v", F.col("id") % 5)
    rows = numbering.running_sum(df, "part", "block", ["id"], "v", "before").collect()
    assert len(rows) == 500
    total = {}
    for r in sorted(rows, key=lambda r: (r.part, r.block, r.id)):
        assert r.before == total.get(r.part, 0)
        total[r.part] = r.before + r.v

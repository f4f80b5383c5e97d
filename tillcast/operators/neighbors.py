"""Exact k-nearest-neighbour regression, weighted by inverse distance."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.constants import NEIGHBOURS
from tillcast.session import materialize

TRAIN_BLOCK, QUERY_BLOCK, TILE = 50_000, 20_000, 256
MOST_CELLS = 4096
DRAWN = 16          # drawn rows for each cell, from which the cuts between cells follow
LEAF_ROWS = 256     # points of a box inside a block
FEW_QUERIES = 8     # a block with fewer queries is not cut into boxes
DENSE = 0.1         # share of a block's boxes from which on the whole block is screened


def _distances(query, points):
    """Distances from one query to points; features add up in their order."""
    total = np.zeros(len(points))
    for j in range(points.shape[1]):
        total += (query[j] - points[:, j]) ** 2
    return np.sqrt(total)


def _to_boxes(queries, low, high):
    """Distances from queries to boxes: never more than ``_distances`` to a point inside, as both round alike."""
    total = np.zeros((len(queries), len(low)))
    for j in range(queries.shape[1]):
        x = queries[:, j][:, None]
        total += np.maximum(np.maximum(low[None, :, j] - x, x - high[None, :, j]), 0.0) ** 2
    return np.sqrt(total)


def cuts(points, cells):
    """Median cuts that deal points into up to ``cells`` parts, as arrays: feature (-1: a part), value, next node, part."""
    feature, value, kids, part = [], [], [], []
    open_, many = [(points, cells, -1)], 0
    while open_:
        some, wanted, parent = open_.pop()
        node = len(feature)
        if parent >= 0:
            kids[parent // 2][parent % 2] = node
        spread = some.std(axis=0) if wanted > 1 and len(some) > 1 else np.zeros(1)
        at = int(np.argmax(np.nan_to_num(spread)))
        feature.append(-1), value.append(0.0), kids.append([-1, -1]), part.append(-1)
        if spread[at] > 0:
            x = some[:, at]
            middle = np.partition(x, (len(x) - 1) // 2)[(len(x) - 1) // 2]
            if middle == x.max():
                middle = x[x < middle].max(initial=-np.inf)
            left = x <= middle
            if 0 < left.sum() < len(x):
                feature[node], value[node] = at, middle
                first = min(wanted - 1, max(1, round(wanted * left.mean())))
                open_ += [(some[~left], wanted - first, 2 * node + 1), (some[left], first, 2 * node)]
                continue
        part[node], many = many, many + 1
    return np.array(feature), np.array(value), np.array(kids), np.array(part)


def dealt(points, tree):
    """The part of each point."""
    feature, value, kids, part = tree
    node = np.zeros(len(points), dtype=np.int64)
    open_ = np.arange(len(points))
    while len(open_ := open_[feature[node[open_]] >= 0]):
        at = node[open_]
        node[open_] = kids[at, (points[open_, feature[at]] > value[at]).astype(np.int64)]
    return part[node]


def _screened(tile, points, norms, k):
    """For each query, the points within rounding error of its k-th distance, by a matrix product."""
    tile_norms = (tile ** 2).sum(axis=1)
    approx = tile_norms[:, None] + norms[None, :] - 2.0 * tile @ points.T
    slack = 1e-9 * (1.0 + tile_norms + norms.max(initial=0.0))
    for i, row in enumerate(approx):
        yield i, np.flatnonzero(row <= np.partition(row, k - 1)[k - 1] + slack[i]) if len(row) > k else np.arange(len(row))


def _boxed(tile, points, boxes, reach, k):
    """For each query, points among which its k nearest within reach are; None if too many boxes are near."""
    begin, low, high = boxes
    far, near = _to_boxes(tile, low, high), np.zeros((len(tile), len(low)), dtype=bool)
    for i, row in enumerate(far):
        order, limit = np.argsort(row), reach[i]
        first = order[:1 + np.searchsorted(np.cumsum(begin[order + 1] - begin[order]), k)]
        close = _distances(tile[i], np.concatenate([points[begin[b]:begin[b + 1]] for b in first]))
        if len(close) >= k:
            limit = min(limit, np.partition(close, k - 1)[k - 1])
        near[i] = row <= limit
    if near.mean() > DENSE:
        return None
    return [np.concatenate([np.arange(begin[b], begin[b + 1]) for b in np.flatnonzero(row)] or [np.arange(0)]) for row in near]


def nearest_in_block(queries, q_ids, points, p_ids, targets, k, reach=None):
    """The k nearest points of each query, ties by point id, as parallel lists.

    The block is cut into boxes; a query's k-th distance in the nearest of them rules out every
    box that is farther, and so does its ``reach``, beyond which no point is wanted. Where
    few boxes are ruled out, as with many dimensions, a matrix product screens the block. Points
    that remain are measured exactly, so neither decides the result.
    """
    out = ([], [], [], [])
    reach = np.full(len(queries), np.inf) if reach is None else reach
    boxes = None
    if len(queries) >= FEW_QUERIES and len(points) > max(k, 4 * LEAF_ROWS):
        part = dealt(points, cuts(points, math.ceil(len(points) / LEAF_ROWS)))
        order = np.argsort(part, kind="stable")
        points, p_ids, targets = points[order], p_ids[order], targets[order]
        begin = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(points))
        boxes = begin, np.fmin.reduceat(points, begin[:-1]), np.fmax.reduceat(points, begin[:-1])
    norms = (points ** 2).sum(axis=1)
    for start in range(0, len(queries), TILE):
        tile = queries[start:start + TILE]
        found = boxes and _boxed(tile, points, boxes, reach[start:start + TILE], k)
        for i, near in enumerate(found) if found else _screened(tile, points, norms, k):
            exact = _distances(tile[i], points[near])
            best = np.lexsort((p_ids[near], exact))[:k]
            out[0].extend([q_ids[start + i]] * len(best))
            out[1].extend(exact[best])
            out[2].extend(p_ids[near][best])
            out[3].extend(targets[near][best])
    return out


def _vectors(column):
    return np.vstack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _with_home(df, tree, schema):
    """Each row's cell."""
    def place(batches):
        for frame in batches:
            if len(frame):
                yield frame.assign(cell=dealt(_vectors(frame["x"]), tree).astype(np.int32))

    return df.mapInPandas(place, f"{schema}, cell int")


def cells_to_visit(asked, low, high, reach):
    """Cells that may hold a point within a query's reach, besides its home cell."""
    def visits(batches):
        for frame in batches:
            for i in range(0, len(frame), TILE):
                some = frame.iloc[i:i + TILE]
                near = ~(_to_boxes(_vectors(some["x"]), low, high) > some["reach"].to_numpy()[:, None])
                near[np.arange(len(some)), some["cell"].to_numpy()] = False
                row, cell = near.nonzero()
                yield some[["id", "x", "reach"]].iloc[row].assign(cell=cell.astype(np.int32))[["id", "x", "cell", "reach"]]

    asked = asked.join(reach, asked["id"] == reach["query"]).select("id", "x", "cell", reach["reach"])
    return asked.mapInPandas(visits, "id string, x array<double>, cell int, reach double")


def _search_cells(asked, points, sizes, k, train_block, query_block):
    """The k nearest points of each (query, cell); cells and their queries are cut into blocks by hash."""
    spark = asked.sparkSession
    many = asked.groupBy("cell").agg(F.count("*").alias("n")).collect()
    blocks = spark.createDataFrame(
        [(r["cell"], max(1, math.ceil(sizes.get(r["cell"], 0) / train_block)), math.ceil(r["n"] / query_block)) for r in many],
        "_cell int, _t int, _q int")

    def spread(df, own, n_own, other, n_other, *columns):
        return df.join(blocks, F.col("cell") == F.col("_cell")).select(
            "cell", "id", "x", *columns, F.pmod(F.xxhash64("id"), F.col(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(n_other) - 1)).alias(other))

    def search(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(t) == 0:
            return pd.DataFrame({"query": [], "distance": [], "neighbor": [], "value": []})
        found = nearest_in_block(
            _vectors(q["x"]), q["id"].to_numpy(), _vectors(t["x"]), t["id"].to_numpy(), t["value"].to_numpy(), k,
            q["reach"].to_numpy())
        return pd.DataFrame(dict(zip(("query", "distance", "neighbor", "value"), found)))

    left = spread(asked, "qb", "_q", "tb", "_t", "reach")
    right = spread(points, "tb", "_t", "qb", "_q", "value")
    return left.groupBy("cell", "qb", "tb").cogroup(right.groupBy("cell", "qb", "tb")).applyInPandas(
        search, "query string, distance double, neighbor string, value double")


def _nearest(pairs, k):
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbor"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k)


def knn_neighbors(train, queries, inputs, target, row_id, k=NEIGHBOURS,
                  train_block=TRAIN_BLOCK, query_block=QUERY_BLOCK):
    """(query, distance, neighbour, value) for the k nearest training rows of each query.

    Training rows lie in cells between median cuts of drawn rows, each cell in a box. A query
    searches its home cell first; its k-th distance there then rules out every cell whose
    box is farther, so the result is exact.
    Cells and their queries are cut by a hash of the row id into blocks of bounded size;
    a pair of blocks emits at most k rows per query, and a window with a rank limit,
    applied before and after the shuffle, merges them. Queries of one id share k rows, in
    which each pair of a query and a training row counts once, wherever it was found.
    """
    vector = F.array(*[F.col(c).cast("double") for c in inputs]).alias("x")
    name = F.col(row_id).cast("string").alias("id")
    points = train.filter(F.col(target).isNotNull()).select(name, vector, F.col(target).cast("double").alias("value"))
    count = min(MOST_CELLS, math.ceil(points.count() / train_block))
    if not count:
        return train.sparkSession.createDataFrame([], "query string, distance double, neighbor string, value double, rank int")
    drawn = [r["x"] for r in points.orderBy(F.xxhash64("id"), "id").limit(DRAWN * count).select("x").collect()]
    tree = cuts(np.array(drawn, dtype=float), count)
    points = materialize(_with_home(points, tree, "id string, x array<double>, value double"), "points")
    asked = materialize(_with_home(queries.select(name, vector), tree, "id string, x array<double>"), "queries") \
        .withColumn("reach", F.lit(math.inf))
    ends = [f(F.get("x", F.lit(j))).alias(f"{n}{j}") for j in range(len(inputs)) for n, f in (("low", F.min), ("high", F.max))]
    cells = {r["cell"]: r for r in points.groupBy("cell").agg(F.count("*").alias("n"), *ends).collect()}
    sizes = {c: r["n"] for c, r in cells.items()}
    low, high = (np.array([[cells[c][f"{n}{j}"] if c in cells else none for j in range(len(inputs))] for c in range(tree[3].max() + 1)], dtype=float)
                 for n, none in (("low", math.inf), ("high", -math.inf)))
    home = materialize(_nearest(_search_cells(asked, points, sizes, k, train_block, query_block), k), "home")
    reach = asked.select(F.col("id").alias("_id")).distinct().join(
        home.groupBy("query").agg(F.count("*").alias("_n"), F.max("distance").alias("_far")), F.col("_id") == F.col("query"), "left"
    ).select(F.col("_id").alias("query"), F.when(F.col("_n") >= k, F.col("_far")).otherwise(math.inf).alias("reach"))
    if len(low) == 1:
        return home
    further = materialize(cells_to_visit(asked.drop("reach"), low, high, reach), "visits")
    if further.isEmpty():
        return home
    return _nearest(home.drop("rank").union(_search_cells(further, points, sizes, k, train_block, query_block)), k)


def knn_predictions(neighbors):
    """Inverse-distance mean per query; exact hits alone count where there are any."""
    hit = F.col("distance") == 0
    inverse = F.when(~hit, 1.0 / F.col("distance"))
    hits = F.avg(F.when(hit, F.col("value")))
    return neighbors.groupBy("query").agg(
        F.coalesce(hits, F.sum(inverse * F.col("value")) / F.sum(inverse)).alias("prediction"),
        F.count("*").cast("int").alias("n_neighbors"), F.max("distance").alias("farthest"))


def knn_forecast(train, queries, inputs, target, row_id, output="knn", **options):
    """``queries`` with the kNN prediction as a column."""
    found = knn_predictions(knn_neighbors(train, queries, inputs, target, row_id, **options))
    return queries.join(found.select(F.col("query").alias(row_id), F.col("prediction").alias(output)), row_id, "left")

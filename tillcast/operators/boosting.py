"""Histogram tree ensembles: leaf-wise or level-wise boosting with early stop, and forests.

Rows carry bins (see ``bins``), a target, a weight and a lane. A lane is one ensemble: a
target, a group, or a tree of a forest. All lanes grow at once, so a model per city needs
no fit per city. A node's best split comes from a histogram of gradients per bin; gains and
leaf values use L1 and L2 penalties:

    leaf = -step * soft(G, l1) / (H + l2),  soft(G, l1) = sign(G) * max(|G| - l1, 0)

The rows of a large lane are written as blocks: one row holds the bins of up to
``BLOCK_ROWS`` rows, feature by feature, so that reading them costs next to nothing. Nodes
are split by Spark: tasks sum histograms of their rows, one shuffle by (lane, node) adds
them up and finds the best split, and only best splits reach the driver. A node with at
most ``TASK_ROWS`` rows, and far fewer than its lane, moves to one task, however few levels
it has to go, since every job reads the whole lane; that task grows all that lies below it,
where the histogram of the larger child is its parent's less its sibling's. Jobs find the
blocks in the executors' memory as far as it holds them, and read the rest again. A lane
that has at most ``BOOSTED_ROWS`` rows altogether (``TASK_ROWS`` of a forest) is fitted by one
task, all rounds of it, on codes of features that go together (see ``bundles``). The margin of
a larger one is a written column, renewed every other round; trees since then are added where
rows are read. Fitting stops in the round in which patience is used up.

With a bound on leaves, the open leaf of the largest gain is split first. As a node's gain
does not depend on other nodes, subtrees grown apart are cut to the bound afterwards in
that order, with the same result. A node that would not be split with what is known so far
(the smallest gain on the way to it decides) never is, so nothing below it is grown.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.bins import Binned, unpack
from tillcast.operators.bundles import Bundled, Cells, sums
from tillcast.session import drop_path, materialize, shared_path

TASK_ROWS = 1_000_000   # rows of a forest's lane that one task takes over
BOOSTED_ROWS = 4_000_000    # rows of a boosted lane that one task takes over (about 250 bytes each, all rounds)
NODE_SHARE = 4          # a node moves to one task when it holds at most this part of the largest lane ...
NODE_ROWS = 250_000     # ... or at most so many rows, and never with more than a lane that one task takes ...
MOST_NODE_ROWS = 2_000_000  # ... or than this
MOVED_ROWS = 1 << 27    # rows of all trees of a forest that grow at once
MOST_NODES = 2048       # nodes whose histograms are summed in one job
BLOCK_ROWS = 8192       # rows of a block
LOOSE_ROWS = 1 << 19    # rows that a task holds back for full blocks
FILE_ROWS = 1 << 20     # rows of a partition when lanes are laid apart
AT_ONCE = 8192          # rows whose histogram is summed at once
MOST_TASKS = 512        # partitions over which lanes or nodes are dealt
MOST_LEVELS = 12        # deepest trees whose levels are grown at once
BLOCK = 2               # rounds between two writes of the margin
COPIES = 32             # tasks that share the trees of a small forest
LEAST_GAIN = 1e-6

NODES = ("lane string, tree int, node int, feature int, bin int, threshold double, left int, right int, value double, "
         "cover double, gain double")
_COLUMNS = [c.split()[0] for c in NODES.split(", ")]
#: Cumulative Poisson(1) probabilities: how often a row is drawn for a tree of a forest.
_DRAWN = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])


def _uniform(key, *salts):
    """Numbers in [0, 1) from keys, the same wherever a row lies."""
    x = np.asarray(key).astype(np.int64).view(np.uint64).copy()
    for salt in salts:
        x ^= np.uint64((salt * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) % (1 << 64))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return (x >> np.uint64(11)) * 2.0 ** -53


def _soft(g, l1):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _chosen(settings, features, tree, path=0):
    """Which features a tree (of boosting) or a split (of a forest) may use."""
    share = 1.0 if settings.columns in ("all", "1.0") else float(settings.columns)
    many = max(1, int(np.ceil(share * features)))
    mask = np.zeros(features, dtype=bool)
    at = path % (1 << 61) if settings.kind == "forest" else 0
    mask[np.argsort(_uniform(np.arange(features), settings.seed, tree, at), kind="stable")[:many]] = True
    return mask


def _gains(g, h, n, settings):
    """Gains of all cuts between bins (last axis) from running sums of gradient, hessian and rows."""
    def score(g, h):
        return (_soft(g, settings.l1) if settings.l1 else g) ** 2 / np.maximum(h + settings.l2, 1e-300)

    left, total = [x[..., :-1] for x in (g, h, n)], [x[..., -1:] for x in (g, h, n)]
    right = [t - x for t, x in zip(total, left)]
    fits = (left[2] >= settings.min_rows) & (right[2] >= settings.min_rows) & (left[1] > 0) & (right[1] > 0)
    return np.where(fits, score(*left[:2]) + score(*right[:2]) - score(*total[:2]), -np.inf)


def best_splits(hist, settings):
    """Best bin and gain of each histogram (m, bins, 3: gradient, hessian, rows) and what lies left of it."""
    left = np.cumsum(hist, axis=1)
    gain = _gains(*np.moveaxis(left, -1, 0), settings)
    if not gain.shape[1]:
        return np.zeros(len(hist), dtype=int), np.full(len(hist), -np.inf), np.zeros((len(hist), 3))
    at, each = gain.argmax(1), np.arange(len(hist))
    return at, gain[each, at], left[each, at]


class _Sums:
    """What is summed per cell: gradients, and hessians and rows, both in one number where that is exact.

    Hessians that are all 1 are the rows; with few binary places they lie below the rows in one number.
    """

    def __init__(self, g, h):
        self.unit, self.equal = None, bool((h == 1.0).all())
        if self.equal:
            self.weights = [g, h]
            return
        most = float(h.max(initial=0.0)) * len(h)
        for unit in (1.0, 4.0, 1024.0):
            if most * unit < 2.0 ** 26 and len(h) < 2 ** 25 and (h >= 0).all() and (h * unit == np.floor(h * unit)).all():
                self.unit, self.weights = unit, [g, h * unit + 2.0 ** 27]
                return
        self.weights = [g, h, np.ones(len(h))]

    def apart(self, parts):
        """Gradient, hessian and rows from sums."""
        if self.equal:
            return parts[0], parts[1], parts[1]
        if not self.unit:
            return tuple(parts)
        n = np.floor(parts[1] * 2.0 ** -27)
        return parts[0], (parts[1] - n * 2.0 ** 27) / self.unit, n


def _best_cuts(hist, cells, given, settings):
    """For each node (line of ``hist``) and used feature: gain and bin of the best cut; and the running sums they come from."""
    many, features = len(hist[0]), len(cells.used)
    gain, at, running = np.full((many, features), -np.inf), np.zeros((many, features), np.int64), []
    for size, own, begin, end in cells.squares:
        running.append(given.apart([np.cumsum(x[:, begin:end].reshape(many, len(own), size), axis=2) for x in hist]))
        found = _gains(*running[-1], settings)
        gain[:, own], at[:, own] = found.max(2), found.argmax(2)
    return gain, at, running


class Tree:
    """A tree as lists; candidates keep the sums and gains that choosing among them needs."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.gain, self.sums, self.path = [], [], [], [], [], [], []

    def add(self, sums, path):
        for column, value in zip((self.feature, self.bin, self.left, self.right, self.gain, self.sums, self.path),
                                 (-1, 0, -1, -1, 0.0, tuple(float(s) for s in sums), path)):
            column.append(value)
        return len(self.feature) - 1

    def split(self, node, feature, at, gain, left):
        self.feature[node], self.bin[node], self.gain[node] = int(feature), int(at), float(gain)
        right = np.subtract(self.sums[node], left)
        self.left[node], self.right[node] = self.add(left, 2 * self.path[node]), self.add(right, 2 * self.path[node] + 1)
        return self.left[node], self.right[node]

    def arrays(self):
        return tuple(np.array(c, dtype=np.int64) for c in (self.feature, self.bin, self.left, self.right))

    def values(self, settings, share=1.0):
        sums = np.array(self.sums).reshape(-1, 3)
        step = settings.step if settings.kind == "boosted" else share
        return -step * _soft(sums[:, 0], settings.l1) / np.maximum(sums[:, 1] + settings.l2, 1e-300)

    def graft(self, node, other):
        """Put a subtree of the same node under it."""
        moved = {0: node}
        for i in range(1, len(other.feature)):
            moved[i] = self.add(other.sums[i], 0)
        for i, at in moved.items():
            self.feature[at], self.bin[at], self.gain[at] = other.feature[i], other.bin[i], other.gain[i]
            self.left[at], self.right[at] = moved.get(other.left[i], -1), moved.get(other.right[i], -1)


def depth_limit(settings):
    return settings.depth or 1 << 30


def best_first(tree, leaves, picked=None):
    """The tree after splitting its leaf of largest gain until there are ``leaves`` leaves (0: no bound).

    Nodes that are split are added to ``picked``, under their numbers in ``tree``.
    """
    out = Tree()
    out.add(tree.sums[0], 1)
    heap, many = [(-tree.gain[0], 1, 0, 0)] if tree.feature[0] >= 0 else [], 1
    while heap and (not leaves or many < leaves):
        gain, path, node, at = heapq.heappop(heap)
        kids = out.split(at, tree.feature[node], tree.bin[node], -gain, tree.sums[tree.left[node]])
        if picked is not None:
            picked.add(node)
        many += 1
        for own, child, way in zip(kids, (tree.left[node], tree.right[node]), (2 * path, 2 * path + 1)):
            out.sums[own] = tree.sums[child]
            if tree.feature[child] >= 0:
                heapq.heappush(heap, (-tree.gain[child], way, child, own))
    return out


def _used(settings, features, tree):
    """The features whose histograms a tree needs; a forest chooses anew at every node."""
    return np.arange(features) if settings.kind == "forest" else np.flatnonzero(_chosen(settings, features, tree))


def grow(data, g, h, settings, number, path=1, depth=0, at=None):
    """A tree over rows in memory (``bundles.Bundled``), and the node in which each row ends.

    Only the rows ``at`` count (all by default); the others end where the splits send them.
    ``path`` and ``depth`` say where in the whole tree the root stands.
    """
    features = len(data.sizes)
    cells = Cells(data, _used(settings, features, number))
    at = np.arange(data.rows) if at is None else at
    given, tree = _Sums(g, h), Tree()
    tree.add((g[at].sum(), h[at].sum(), len(at)), path)

    def best(hist, nodes):
        """(feature, bin, gain, sums to the left) of the best split of each node, None without one."""
        gain, cut, running = _best_cuts(hist, cells, given, settings)
        if settings.kind == "forest":
            gain = np.where(np.stack([_chosen(settings, features, number, tree.path[n]) for n in nodes])[:, cells.used], gain, -np.inf)
        out, first = [], gain.argmax(1)
        for i, f in enumerate(first.tolist()):
            if gain[i, f] > LEAST_GAIN:
                square, line = cells.square_of[f]
                out.append((cells.used[f], cut[i, f], gain[i, f], [x[i, line, cut[i, f]] for x in running[square]]))
            else:
                out.append(None)
        return out

    def may_split(node, level):
        return level < depth_limit(settings) and tree.sums[node][2] >= 2 * settings.min_rows

    if settings.leaves or not 0 < settings.depth <= MOST_LEVELS:
        return tree, _grow_by_node(data, cells, given, tree, best, may_split, settings, depth, at)
    return tree, _grow_by_level(data, cells, given, tree, best, may_split, depth, at)


def _grow_by_level(data, cells, given, tree, best, may_split, depth, at):
    """All nodes of a level at once; the histogram of a larger child is its parent's less its sibling's."""
    leaf, nodes = np.zeros(data.rows, np.int32), [0]
    counted = None if len(at) == data.rows else np.zeros(data.rows, dtype=bool)
    if counted is not None:
        counted[at] = True
    open_ = may_split(0, depth)
    hist = sums(data, cells, at, given.weights) if open_ else None
    while open_:
        splits, kids, kept = {}, {}, []
        for i, (node, found) in enumerate(zip(nodes, best(hist, nodes))):
            if found is not None:
                splits[node] = found[:2]
                kids[node] = tree.split(node, *found)
                kept.append(i)
        if not splits:
            break
        rows = None
        if len(splits) < len(nodes) or sum(tree.sums[n][2] for n in nodes) < len(at):   # some rows have ended
            goes_on = np.zeros(len(tree.feature), dtype=bool)
            goes_on[list(splits)] = True
            rows = np.flatnonzero(goes_on.take(leaf))
        data.moved(leaf, kids, splits, rows)
        depth += 1
        # one child of each split is summed, the smaller one; a child that cannot be split needs no histogram
        slot, asked = np.full(len(tree.feature), -1), []
        for i, pair in zip(kept, kids.values()):
            own = [may_split(k, depth) for k in pair]
            if any(own):
                small = int(tree.sums[pair[1]][2] < tree.sums[pair[0]][2])
                slot[pair[small]] = len(asked)
                asked.append((i, pair, small, own))
        if not asked:
            break
        chosen = slot.take(leaf) >= 0
        rows = np.flatnonzero(chosen if counted is None else chosen & counted)
        less = sums(data, cells, rows, given.weights, slot.take(leaf.take(rows)), len(asked))
        nodes, order = [], []
        for k, (i, pair, small, own) in enumerate(asked):
            for side in (0, 1):
                if own[side]:
                    nodes.append(pair[side])
                    order.append((k, i, side == small))
        k, i, own = (np.array(c) for c in zip(*order))
        hist = [np.where(own[:, None], y[k], x[i] - y[k]) for x, y in zip(hist, less)]
    return leaf


def _grow_by_node(data, cells, given, tree, best, may_split, settings, depth, at):
    """The node of largest gain first, for a bound on leaves; without one the deepest, so that few histograms are open."""
    leaf, heap, many = np.zeros(data.rows, np.int32), [], 1

    def offer(nodes, level, parts, hists):
        for i, found in enumerate(best([np.stack(x) for x in zip(*hists)], nodes)):
            if found is not None:
                order = -found[2] if settings.leaves else -tree.path[nodes[i]]
                heapq.heappush(heap, (order, tree.path[nodes[i]], nodes[i], level, parts[i], hists[i], found))

    def histogram(rows):
        return [x[0] for x in sums(data, cells, rows, given.weights)]

    if may_split(0, depth):
        offer([0], depth, [at], [histogram(at)])
    while heap and (not settings.leaves or many < settings.leaves):
        _, _, node, level, rows, hist, found = heapq.heappop(heap)
        kids = tree.split(node, *found)
        many += 1
        goes = data.bins(found[0], rows) <= found[1]
        parts = rows[goes], rows[~goes]
        for own, part in zip(kids, parts):
            leaf[part] = own
        open_ = [i for i in (0, 1) if may_split(kids[i], level + 1)]
        if open_:
            small = int(len(parts[1]) < len(parts[0]))
            own = histogram(parts[small])
            both = [own if i == small else [x - y for x, y in zip(hist, own)] for i in open_]
            offer([kids[i] for i in open_], level + 1, [parts[i] for i in open_], both)
    if len(at) < data.rows:
        rest = np.ones(data.rows, dtype=bool)
        rest[at] = False
        rest = np.flatnonzero(rest)
        leaf[rest] = data.descend(tree.arrays(), rest)
    return leaf


def descend(arrays, bins):
    """The node of a tree in which each row ends; ``bins`` has a line per feature."""
    feature, at_bin, left, right = arrays
    inner, flat, rows = feature >= 0, bins.ravel(), bins.shape[1]
    begin, kids = np.maximum(feature, 0) * rows, np.stack([left, right], 1).ravel()
    out, open_, node = np.zeros(rows, dtype=np.int64), np.arange(rows), np.zeros(rows, dtype=np.int64)
    while True:
        still = inner.take(node)
        if not still.all():
            out[open_] = node
            open_, node = open_[still], node[still]
        if not len(open_):
            return out
        node = kids.take(2 * node + (flat.take(begin.take(node) + open_) > at_bin.take(node)))


class Patience:
    """Stops ``patience`` rounds after the best one."""

    def __init__(self, patience):
        self.patience, self.best, self.kept, self.rounds = patience, np.inf, 0, 0

    def goes_on(self, loss):
        self.rounds += 1
        if loss < self.best:
            self.best, self.kept = loss, self.rounds
        return not self.patience or self.rounds - self.kept < self.patience


def _table(lane, trees, values, base, rounds, edges):
    """Node rows of an ensemble; tree -1 is its base, whose cover counts the rounds that were fitted."""
    out = [pd.DataFrame([(lane, -1, 0, -1, 0, 0.0, -1, -1, base, float(rounds), 0.0)], columns=_COLUMNS)]
    for number, tree, value in zip(trees, trees.values(), values):
        n = len(tree.feature)
        ends = [edges[f][b] if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.bin)]
        out.append(pd.DataFrame(dict(zip(_COLUMNS, (
            lane, number, np.arange(n), tree.feature, tree.bin, ends, tree.left, tree.right, value, [s[1] for s in tree.sums], tree.gain)))))
    return pd.concat(out, ignore_index=True)


def _sampled(settings, key, number):
    """How much each row counts for a tree: drawn with replacement (forest) or once (boosting)."""
    if settings.kind == "boosted" and settings.rows >= 1.0:
        return np.ones(len(key))
    if settings.kind == "forest":
        return np.searchsorted(_DRAWN, _uniform(key, settings.seed, number, 1), side="right").astype(float)
    return (_uniform(key, settings.seed, number, 2) < settings.rows).astype(float)


def _lines(bins, order):
    """Rows in some order as a line per feature, without another copy of all."""
    out = np.empty(bins.shape[::-1], dtype=bins.dtype)
    for i in range(0, len(order), BLOCK_ROWS):
        out[:, i:i + BLOCK_ROWS] = bins[order[i:i + BLOCK_ROWS]].T
    return out


def fit_rows(key, held, y, w, bins, settings, share=(0, 1)):
    """All rounds of one lane in memory: (trees by number, their node values, base, rounds fitted).

    A forest grows the trees whose number leaves ``share[0]`` over ``share[1]``.
    """
    order = np.argsort(key, kind="stable")
    key, held, y, w, data = key[order], held[order], y[order], w[order], Bundled(_lines(bins, order))
    train = ~held
    trees, values = {}, []
    if not train.any():
        return trees, values, 0.0, 0
    if settings.kind == "forest":
        for number in range(share[0], settings.trees, share[1]):
            drawn = _sampled(settings, key, number) * train
            at = np.flatnonzero(drawn)
            weight = w[at] * drawn[at]
            trees[number] = grow(data.pick(at), -weight * y[at], weight, settings, number)[0]
            values.append(trees[number].values(settings, 1.0 / settings.trees))
        return trees, values, 0.0, settings.trees
    base = float(np.sum(w[train] * y[train]) / np.sum(w[train]))
    margin, wait = np.full(len(y), base), Patience(settings.patience if held.any() else 0)
    for number in range(settings.trees):
        at = np.flatnonzero(train & (_sampled(settings, key, number) > 0))
        if not len(at):
            at = np.flatnonzero(train)
        tree, leaf = grow(data, w * (margin - y), w, settings, number, at=at)
        trees[number] = tree
        values.append(tree.values(settings))
        margin += values[-1].take(leaf)
        if not wait.goes_on(np.mean((margin[held] - y[held]) ** 2) if held.any() else -number):
            break
    kept = wait.kept if wait.patience else len(trees)
    return {n: trees[n] for n in range(kept)}, values[:kept], base, wait.rounds


def _arrow_rows(table, features):
    column = lambda c: table.column(c).to_numpy() if isinstance(table, pa.Table) else table.column(c).to_numpy(zero_copy_only=False)
    return column("key"), column("held").astype(bool), column("y"), column("w"), unpack(table.column("bins"), features)


def _fit_small(rows, edges, settings, lanes):
    """Lanes that one task each can hold; a forest's trees are shared between several tasks.

    A little data is a lot of work here, so lanes are dealt to as many tasks as may be needed to keep them apart.
    """
    def fit(table):
        lane = table.column("lane")[0].as_py()
        part = (table.column("copy")[0].as_py(), copies)
        trees, values, base, rounds = fit_rows(*_arrow_rows(table, len(edges)), settings, part)
        found = _table(lane, trees, values, base, rounds, edges)
        return pa.Table.from_pandas(found[found["tree"] >= 0] if part[0] else found, schema=_ARROW, preserve_index=False)

    copies = min(COPIES, settings.trees) if settings.kind == "forest" else 1
    copied = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return copied.repartition(_tasks(rows.sparkSession, lanes * copies), "lane", "copy").groupBy("lane", "copy").applyInArrow(fit, NODES)


def _tasks(spark, groups):
    """A number of partitions that keeps most of some groups apart; being asked for, it is not coalesced."""
    return max(spark.sparkContext.defaultParallelism, min(MOST_TASKS, 4 * groups))


_ARROW = pa.schema([("lane", pa.string()), ("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()),
                    ("threshold", pa.float64()), ("left", pa.int32()), ("right", pa.int32()), ("value", pa.float64()),
                    ("cover", pa.float64()), ("gain", pa.float64())])


@dataclass
class _Unit:
    """A tree that grows, as tasks see it: its lane, what is grown, and which nodes are asked for."""

    lane: str
    number: int
    arrays: tuple
    asked: dict
    since: list             # (arrays, values) of the lane's trees that its margin does not hold yet


_BLOCKS = ("lane string, held boolean, block long, n int, key binary, y binary, w binary, margin binary, bins binary")
_BLOCK_COLUMNS = [c.split()[0] for c in _BLOCKS.split(", ")]
_DENSE = {"key": np.int64, "y": np.float64, "w": np.float64, "margin": np.float64}


def _blocks(rows, bases, features):
    """``rows`` as blocks, each of one lane and either held or not; margins start at the lane's base."""
    def pack(batches):
        source, made, loose, many = TaskContext.get().partitionId(), 0, {}, {}

        def flush(group):
            nonlocal made
            key, y, w, bins = (np.concatenate(c) for c in zip(*loose.pop(group)))
            many.pop(group)
            out = []
            for i in range(0, len(key), BLOCK_ROWS):
                some = slice(i, i + BLOCK_ROWS)
                n = len(key[some])
                packed = (key[some], y[some], w[some], np.full(n, bases[group[0]]), np.ascontiguousarray(bins[some].T))
                out.append((*group, (source << 32) + made, n, *(x.tobytes() for x in packed)))
                made += 1
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), _BLOCK_ARROW.types)], schema=_BLOCK_ARROW)

        for batch in batches:
            key, held, y, w, bins = _arrow_rows(batch, features)
            lanes, codes = np.unique(batch.column("lane").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            codes = 2 * codes + held
            for code in np.unique(codes):
                at, group = np.flatnonzero(codes == code), (str(lanes[code // 2]), bool(code % 2))
                loose.setdefault(group, []).append((key[at], y[at], w[at], bins[at]))
                many[group] = many.get(group, 0) + len(at)
                if many[group] >= 8 * BLOCK_ROWS:
                    yield flush(group)
            while sum(many.values()) > LOOSE_ROWS:
                yield flush(max(many, key=many.get))
        for group in list(loose):
            yield flush(group)

    return rows.mapInArrow(pack, _BLOCKS)


_BLOCK_ARROW = pa.schema([("lane", pa.string()), ("held", pa.bool_()), ("block", pa.int64()), ("n", pa.int32()),
                          *((c, pa.binary()) for c in ("key", "y", "w", "margin", "bins"))])


def _read_blocks(batch, features):
    """The blocks of a batch: lane, number of the block, and its arrays by name (bins with a line per feature)."""
    for i in range(batch.num_rows):
        n = batch.column("n")[i].as_py()
        found = {c: np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in _DENSE.items()}
        found["bins"] = np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8).reshape(features, n)
        yield batch.column("lane")[i].as_py(), batch.column("block")[i].as_py(), found


def _wanted(block, unit, settings, slots):
    """Rows of a block that count for a unit's asked nodes: rows, slot of their node, gradient, hessian."""
    drawn = _sampled(settings, block["key"], unit.number)
    slot = slots[descend(unit.arrays, block["bins"])]
    at = np.flatnonzero((drawn > 0) & (slot >= 0))
    h = block["w"][at] * drawn[at]
    return at, slot[at], h * (block["margin"][at] - block["y"][at]), h


def _per_unit(batches, units, settings, features):
    """For each block and each unit of its lane: (index of unit, block, arrays, rows, slots, gradient, hessian)."""
    of = {}
    for i, unit in enumerate(units):
        slots = np.full(len(unit.arrays[0]), -1, dtype=np.int64)
        slots[sorted(unit.asked)] = np.arange(len(unit.asked))
        of.setdefault(unit.lane, []).append((i, unit, slots))
    for batch in batches:
        for lane, number, block in _read_blocks(batch, features):
            asked = of.get(lane, ())
            if asked and asked[0][1].since:  # units of one lane have the same trees behind them
                block["margin"] = block["margin"] + sum(v.take(descend(a, block["bins"])) for a, v in asked[0][1].since)
            for i, unit, slots in asked:
                yield i, number, block, *_wanted(block, unit, settings, slots)


def _split_nodes(blocks, units, settings, features):
    """Best split of the asked nodes of all units, by histograms summed in one shuffle."""
    size = settings.bins
    asked = [sorted(unit.asked) for unit in units]

    def partial(batches):
        source, sums, loose = TaskContext.get().partitionId(), {}, {}

        def add(i):
            used = _used(settings, features, units[i].number)
            if i not in sums:
                sums[i] = np.zeros((len(used), len(asked[i]) * size, 3))
            parts = loose.pop(i)
            slot, g, h = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
            bins = np.concatenate([p[0] for p in parts], axis=1)
            _add_wide(sums[i], bins, slot * size, g, h)

        for i, _, block, at, slot, g, h in _per_unit(batches, units, settings, features):
            if len(at):
                used = _used(settings, features, units[i].number)
                loose.setdefault(i, []).append((block["bins"][used].take(at, 1), slot, g, h))
                if sum(len(p[1]) for p in loose[i]) >= max(AT_ONCE, len(asked[i]) * size):
                    add(i)
        for i in list(loose):
            add(i)
        for i, total in sums.items():
            for first in range(0, len(asked[i]), 64):
                found = [(k, np.ascontiguousarray(total[:, k * size:(k + 1) * size])) for k in range(first, min(first + 64, len(asked[i])))]
                found = [(asked[i][k], x.tobytes()) for k, x in found if x[0, :, 2].any()]
                yield pa.record_batch([pa.array([i] * len(found), pa.int32()), pa.array([n for n, _ in found], pa.int32()),
                                       pa.array([source] * len(found), pa.int32()), pa.array([x for _, x in found], pa.binary())],
                                      names=["unit", "node", "source", "hist"])

    def reduce(batches):
        key, total, out = None, None, []

        def done():
            unit = units[key[0]]
            used = _used(settings, features, unit.number)
            at, gain, left = best_splits(total, settings)
            if settings.kind == "forest":
                gain = np.where(_chosen(settings, features, unit.number, unit.asked[key[1]][0])[used], gain, -np.inf)
            f = int(gain.argmax())
            out.append((*key, int(used[f]), int(at[f]), float(gain[f]), *left[f].tolist(), *total[0].sum(0).tolist()))

        for batch in batches:
            for r in range(batch.num_rows):
                own = batch.column("unit")[r].as_py(), batch.column("node")[r].as_py()
                found = np.frombuffer(batch.column("hist")[r].as_buffer()).reshape(-1, size, 3)
                if own != key:
                    if key is not None:
                        done()
                    key, total = own, found.copy()
                else:
                    total += found
        if key is not None:
            done()
            yield pa.record_batch([pa.array(c) for c in zip(*out)], names=names)

    names = ["unit", "node", "feature", "bin", "gain", "g", "h", "n", "all_g", "all_h", "all_n"]
    schema = ("unit long, node long, feature long, bin long, gain double, g double, h double, n double, "
              "all_g double, all_h double, all_n double")
    summed = blocks.mapInArrow(partial, "unit int, node int, source int, hist binary").repartition("unit", "node").sortWithinPartitions(
        "unit", "node", "source")
    return sorted(summed.mapInArrow(reduce, schema).collect())


def _add_wide(out, bins, cells, g, h):
    """Add rows to ``out`` (features, cells, 3) at once, however many cells there are."""
    given, cells_of = _Sums(g, h), out.shape[1]
    for f in range(len(out)):
        code = bins[f] + cells
        for k, v in enumerate(given.apart([np.bincount(code, w, cells_of) for w in given.weights])):
            out[f, :, k] += v


def _finish_nodes(blocks, units, settings, features):
    """Subtrees of the asked nodes, each grown by one task: {(unit, node): tree}."""
    asked = [np.array(sorted(unit.asked)) for unit in units]

    def deal(batches):
        for i, number, block, at, slot, g, h in _per_unit(batches, units, settings, features):
            if not len(at):
                continue
            order = np.argsort(slot, kind="stable")
            at, slot, g, h = at[order], slot[order], g[order], h[order]
            begin = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
            ends, bins = [*begin[1:], len(at)], block["bins"].take(at, 1)
            cut = [slice(a, b) for a, b in zip(begin, ends)]
            yield pa.record_batch(
                [pa.array(np.full(len(cut), i, np.int32)), pa.array(asked[i][slot[begin]].astype(np.int32)), pa.array(np.full(len(cut), number)),
                 *(pa.array([x[c].tobytes() for c in cut], pa.binary()) for x in (g, h)),
                 pa.array([bins[:, c].tobytes() for c in cut], pa.binary())], names=["unit", "node", "block", "g", "h", "bins"])

    def finish(table):
        unit, node = table.column("unit")[0].as_py(), table.column("node")[0].as_py()
        path, depth = units[unit].asked[node]
        table = table.sort_by("block")
        g, h = (np.concatenate([np.frombuffer(x.as_buffer()) for x in table.column(c)]) for c in ("g", "h"))
        bins = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8).reshape(features, -1) for x in table.column("bins")], axis=1)
        tree, _ = grow(Bundled(bins), g, h, settings, units[unit].number, path, depth)
        n = len(tree.feature)
        columns = [np.full(n, unit), np.full(n, node), np.arange(n), tree.feature, tree.bin, tree.left, tree.right, tree.gain,
                   *np.array(tree.sums).reshape(-1, 3).T]
        return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.int32()] * 7 + [pa.float64()] * 4)], names=names)

    names = ["unit", "node", "at", "feature", "bin", "left", "right", "gain", "g", "h", "n"]
    schema = "unit int, node int, at int, feature int, bin int, left int, right int, gain double, g double, h double, n double"
    dealt = blocks.mapInArrow(deal, "unit int, node int, block long, g binary, h binary, bins binary")
    out = {}
    dealt = dealt.repartition(_tasks(blocks.sparkSession, sum(map(len, asked))), "unit", "node")
    for key, part in dealt.groupBy("unit", "node").applyInArrow(finish, schema).toPandas().groupby(["unit", "node"]):
        tree, part = Tree(), part.sort_values("at")
        for sums in part[["g", "h", "n"]].to_numpy():
            tree.add(sums, 0)
        tree.feature, tree.bin, tree.left, tree.right = (part[c].tolist() for c in ("feature", "bin", "left", "right"))
        tree.gain = part["gain"].tolist()
        out[key] = tree
    return out


def _in_jobs(asked):
    """The asked nodes of all lanes in jobs of at most ``MOST_NODES``: per job {index of lane: nodes}."""
    jobs, many = [], MOST_NODES
    for i, nodes in enumerate(asked):
        for node, at in nodes.items():
            if many >= MOST_NODES:
                jobs.append({})
                many = 0
            jobs[-1].setdefault(i, {})[node] = at
            many += 1
    return jobs


def _grow_large(blocks, lanes, settings, features, node_rows):
    """One tree for each (lane, number, trees since its margin), grown together."""
    trees, asked, small = [Tree() for _ in lanes], [{0: (1, 0)} for _ in lanes], [{} for _ in lanes]
    above = [{} for _ in lanes]
    for tree in trees:
        tree.add((0.0, 0.0, 0.0), 1)
    unit = lambda i, nodes: _Unit(lanes[i][0], lanes[i][1], trees[i].arrays(), nodes, lanes[i][2])

    def kept(i, nodes):
        """Nodes that may be split: with a bound on leaves, those whose parent is split by what is known."""
        if not settings.leaves or not nodes:
            return nodes
        picked = set()
        best_first(trees[i], settings.leaves, picked)
        return {n: at for n, at in nodes.items() if above[i][n] in picked}

    while any(asked):
        last, asked = asked, [{} for _ in lanes]
        for job in _in_jobs(last):
            order = sorted(job)
            for u, node, feature, at, gain, *sums in _split_nodes(blocks, [unit(i, job[i]) for i in order], settings, features):
                i = order[u]
                tree, (path, depth) = trees[i], last[i][node]
                if node == 0:
                    tree.sums[0] = tuple(sums[3:])
                if gain <= LEAST_GAIN:
                    continue
                for child in tree.split(node, feature, at, gain, sums[:3]):
                    above[i][child], rows = node, tree.sums[child][2]
                    if depth + 1 < depth_limit(settings) and rows >= 2 * settings.min_rows:
                        (small[i] if rows <= node_rows else asked[i])[child] = (tree.path[child], depth + 1)
        asked = [kept(i, nodes) for i, nodes in enumerate(asked)]
    small = [kept(i, nodes) for i, nodes in enumerate(small)]
    if any(small):
        order = [i for i, nodes in enumerate(small) if nodes]
        for (u, node), part in _finish_nodes(blocks, [unit(i, small[i]) for i in order], settings, features).items():
            trees[order[int(u)]].graft(int(node), part)
    return [best_first(tree, settings.leaves) for tree in trees]


def _renewed(blocks, since, features):
    """``blocks`` with the trees in their margins."""
    def add(batches):
        for batch in batches:
            for k, (lane, _, block) in enumerate(_read_blocks(batch, features)):
                margin = block["margin"] + sum(v.take(descend(a, block["bins"])) for a, v in since[lane])
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([margin.tobytes()], pa.binary()) if c == "margin" else one.column(c) for c in _BLOCK_COLUMNS], _BLOCK_COLUMNS)

    return blocks.mapInArrow(add, _BLOCKS)


def _losses(blocks, since, features):
    """Mean squared error of each lane's rows."""
    def errors(batches):
        found = {}
        for batch in batches:
            for lane, number, block in _read_blocks(batch, features):
                if lane in since:
                    margin = block["margin"] + sum(v.take(descend(a, block["bins"])) for a, v in since[lane])
                    found[number] = lane, float(np.sum((margin - block["y"]) ** 2)), len(margin)
        yield pa.record_batch([pa.array([v[k] for v in found.values()], t) for k, t in ((0, pa.string()), (1, pa.float64()), (2, pa.int64()))],
                              names=["lane", "error", "many"])

    sums = blocks.mapInArrow(errors, "lane string, error double, many long").groupBy("lane").agg(F.sum("error").alias("error"), F.sum("many").alias("many"))
    return {r.lane: r.error / r.many for r in sums.collect()}


def _fit_large(rows, counts, edges, settings, task_rows):
    """Lanes with more rows than one task takes; ``counts`` has their rows."""
    spark, features, out = rows.sparkSession, len(edges), []
    node_rows, total = min(task_rows, MOST_NODE_ROWS, max(NODE_ROWS, max(counts.values()) // NODE_SHARE)), sum(counts.values())
    if len(counts) > 1:  # a task that sees one lane sums the histograms of one lane
        rows = rows.repartitionByRange(max(len(counts), -(-total // FILE_ROWS)), "lane", "key")
    path = shared_path(spark, "blocks")
    read = lambda at: spark.read.schema(_BLOCKS).parquet(at)
    kept = lambda some: some.persist(StorageLevel.MEMORY_ONLY)
    clean = spark.sparkContext._jvm.System.gc  # lets Spark delete the shuffle files of jobs that are done
    if settings.kind == "forest":
        _blocks(rows.where("not held"), dict.fromkeys(counts, 0.0), features).write.parquet(path)
        for lane, many in sorted(counts.items()):
            own, trees = kept(read(path).where(F.col("lane") == lane)), {}
            wave = max(1, min(settings.trees, MOST_NODES // max(1, 2 * many // node_rows), MOVED_ROWS // many))
            for first in range(0, settings.trees, wave):
                numbers = range(first, min(first + wave, settings.trees))
                trees.update(zip(numbers, _grow_large(own, [(lane, n, []) for n in numbers], settings, features, node_rows)))
                clean()
            own.unpersist()
            values = [t.values(settings, 1.0 / settings.trees) for t in trees.values()]
            out.append(_table(lane, trees, values, 0.0, settings.trees, edges))
        drop_path(spark, path)
        return pd.concat(out, ignore_index=True)
    mean = F.sum(F.col("w") * F.col("y")) / F.sum("w")
    base = {r.lane: r.margin for r in rows.where("not held").groupBy("lane").agg(mean.alias("margin")).collect()}
    held = {r.lane for r in rows.where("held").select("lane").distinct().collect()}
    _blocks(rows.where(F.col("lane").isin(list(base))), base, features).write.parquet(path)
    trees, values, since = ({lane: [] for lane in base} for _ in range(3))
    waits, active = {lane: Patience(settings.patience if lane in held else 0) for lane in base}, sorted(base)
    parts = lambda at: [kept(read(at).where(c)) for c in ("not held", "held")]
    train, late = parts(path)
    for number in range(settings.trees):
        grown = _grow_large(train, [(lane, number, since[lane]) for lane in active], settings, features, node_rows)
        clean()
        for lane, tree in zip(active, grown):
            trees[lane].append(tree)
            values[lane].append(tree.values(settings))
            since[lane].append((tree.arrays(), values[lane][-1]))
        watched = {lane: since[lane] for lane in active if waits[lane].patience}
        losses = _losses(late, watched, features) if watched else {}
        active = [lane for lane in active if waits[lane].goes_on(losses.get(lane, -number))]
        if not active:
            break
        if (number + 1) % BLOCK == 0 and number + 1 < settings.trees:
            old, path = path, shared_path(spark, "blocks")
            _renewed(read(old).where(F.col("lane").isin(active)), {lane: since[lane] for lane in active}, features).write.parquet(path)
            for part in (train, late):
                part.unpersist()
            drop_path(spark, old)
            train, late = parts(path)
            since.update({lane: [] for lane in active})
    for part in (train, late):
        part.unpersist()
    drop_path(spark, path)
    for lane, own in trees.items():
        kept = waits[lane].kept if waits[lane].patience else len(own)
        out.append(_table(lane, dict(enumerate(own[:kept])), values[lane][:kept], base[lane], waits[lane].rounds, edges))
    return pd.concat(out, ignore_index=True)


def lane_rows(binned: Binned, lane, target, keys, held="false", weight=None, inputs=None) -> DataFrame:
    """Rows of one or many lanes: ``lane`` and ``held`` are expressions; rows without target are left out.

    With ``inputs`` only these of the bins are kept, in their order.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    rows = binned.frame.where(F.col(target).isNotNull()).select(
        F.expr(lane).cast("string").alias("lane"), F.xxhash64(*keys).alias("key"), F.coalesce(F.expr(held), F.lit(False)).alias("held"),
        F.col(target).cast("double").alias("y"), w.cast("double").alias("w"), "bins")
    if inputs is None or list(inputs) == binned.inputs:
        return rows
    at, size, names = [binned.inputs.index(c) for c in inputs], len(binned.inputs), rows.columns

    def pick(batches):
        for batch in batches:
            part = np.ascontiguousarray(unpack(batch.column("bins"), size)[:, at])
            packed = pa.array([x.tobytes() for x in part], pa.binary())
            yield pa.RecordBatch.from_arrays([packed if c == "bins" else batch.column(c) for c in names], names)

    return rows.mapInArrow(pick, rows.schema)


def fit_lanes(rows: DataFrame, edges, settings, task_rows=None) -> DataFrame:
    """Nodes of the ensembles of all lanes, as a written table (see ``NODES``).

    Small lanes are one job for any number of lanes; only names of large ones reach the driver.
    """
    spark, edges = rows.sparkSession, list(edges)
    task_rows = task_rows or (TASK_ROWS if settings.kind == "forest" else BOOSTED_ROWS)
    sizes = materialize(rows.groupBy("lane").agg(F.count("*").alias("many")), "lane-sizes")
    counts = {r.lane: r.many for r in sizes.where(F.col("many") > task_rows).collect()}
    few = sizes.where(F.col("many") <= task_rows).select("lane")
    small = _fit_small(rows.join(few, "lane", "left_semi") if counts else rows, edges, settings, few.count())
    if not counts:
        return materialize(small, "trees")
    large = _fit_large(rows.where(F.col("lane").isin(list(counts))), counts, edges, settings, task_rows)
    found = spark.createDataFrame(pa.Table.from_pandas(large, schema=_ARROW, preserve_index=False))
    return materialize(found.unionByName(small) if len(few.head(1)) else found, "trees")


class TreeModel:
    """An ensemble as flat arrays: ``x <= threshold`` goes left, null and NaN go right."""

    def __init__(self, inputs, nodes):
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        self.inputs, self.nodes = list(inputs), nodes
        self.rounds = int(nodes.loc[nodes["tree"] < 0, "cover"].iloc[0])
        first = nodes.groupby("tree")["node"].transform("size").groupby(nodes["tree"]).first()
        self.roots = np.concatenate([[0], np.cumsum(first.to_numpy())[:-1]]).astype(np.int64)
        start = np.repeat(self.roots, first.to_numpy())
        self.feature = nodes["feature"].to_numpy()
        self.threshold, self.value, self.cover = (nodes[c].to_numpy() for c in ("threshold", "value", "cover"))
        self.left, self.right = (nodes[c].to_numpy() + start for c in ("left", "right"))
        self.inner, self.column = self.feature >= 0, np.maximum(self.feature, 0).astype(np.int64)
        self.kids = np.stack([self.right, self.left], 1).ravel()

    @property
    def trees(self):
        return len(self.roots) - 1

    def leaves(self, x, some=slice(None)):
        """The leaf of each row in each of some trees."""
        return np.stack([self.leaf(x.T, root) for root in self.roots[some]], 1)

    def leaf(self, x, root, some=None):
        """The leaf of all or some rows below a node; ``x`` has a line per input."""
        flat, rows = np.ascontiguousarray(x).ravel(), x.shape[1]
        out, open_, node = np.zeros(rows, dtype=np.int64), np.arange(rows) if some is None else some, np.full(rows if some is None else len(some), root)
        while True:
            still = self.inner.take(node)
            if not still.all():
                out[open_] = node
                open_, node = open_[still], node[still]
            if not len(open_):
                return out if some is None else out[some]
            goes = flat.take(self.column.take(node) * rows + open_) <= self.threshold.take(node)
            node = self.kids.take(2 * node + goes)

    def predict(self, x):
        out = np.zeros(len(x))
        for i in range(0, len(x), 4096):
            part = np.ascontiguousarray(x[i:i + 4096].T)
            for t in range(0, len(self.roots), 64):
                found = np.stack([self.value.take(self.leaf(part, root)) for root in self.roots[t:t + 64]], 1)
                out[i:i + 4096] += found.sum(1)
        return out

    def transform(self, df, output="prediction"):
        """Add the prediction of every row."""
        model = self

        @F.pandas_udf("double")
        def predict(frame: pd.DataFrame) -> pd.Series:
            return pd.Series(model.predict(frame.to_numpy(dtype=float)))

        return df.withColumn(output, predict(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.inputs)])))

    def on_path(self):
        """Whether an input decides on the way from its root to a node: (nodes, inputs)."""
        out, level = np.zeros((len(self.feature), len(self.inputs)), dtype=bool), self.roots
        while len(level := level[self.inner[level]]):
            for kids in (self.left[level], self.right[level]):
                out[kids] = out[level]
                out[kids, self.feature[level]] = True
            level = np.concatenate([self.left[level], self.right[level]])
        return out

    def importance(self):
        """Share of the gain of each input."""
        split = self.nodes[self.nodes["feature"] >= 0].groupby("feature")["gain"].sum()
        total = split.sum() or 1.0
        return {c: float(split.get(i, 0.0) / total) for i, c in enumerate(self.inputs)}


def models_of(nodes: DataFrame, inputs) -> dict:
    """One model per lane, on the driver; for a bounded number of lanes."""
    return {lane: TreeModel(inputs, part) for lane, part in nodes.toPandas().groupby("lane")}


def fit_models(binned: Binned, targets, settings, keys, held="false", weight=None, inputs=None, task_rows=None) -> dict:
    """A model per entry of ``targets`` (name to target column), all fitted together."""
    rows = None
    for name, target in targets.items():
        own = lane_rows(binned, f"'{name}'", target, keys, held, weight, inputs)
        rows = own if rows is None else rows.unionByName(own)
    inputs = binned.inputs if inputs is None else list(inputs)
    edges = [binned.edges[binned.inputs.index(c)] for c in inputs]
    return models_of(fit_lanes(rows, edges, settings, task_rows), inputs)


def score_groups(df: DataFrame, nodes: DataFrame, group, inputs, output="prediction", rows_per_task=TASK_ROWS) -> DataFrame:
    """Predictions of each row's own group's model; NULL for groups without one, also for rows without group.

    A group's rows are dealt to tasks of bounded size, each of which reads the group's model.
    """
    inputs = list(inputs)
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    sizes = df.groupBy(name.alias("_lane")).agg(F.ceil(F.count("*") / rows_per_task).cast("long").alias("_salts"))
    rows = df.withColumn("_lane", name).join(sizes, "_lane").withColumn(
        "_salt", F.pmod(F.xxhash64(*df.columns), F.col("_salts"))).drop("_salts")
    salted = nodes.withColumn("_lane", F.concat(F.lit("="), "lane")).join(sizes, "_lane").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))).drop("_salts")

    def score(left, right):
        if not left.num_rows:
            found = pa.nulls(0, pa.float64())
        elif not right.num_rows:
            found = pa.nulls(left.num_rows, pa.float64())
        else:
            x = np.column_stack([left.column(c).cast(pa.float64()).to_numpy() for c in inputs])
            found = pa.array(TreeModel(inputs, right.select(_COLUMNS).to_pandas()).predict(x))
        return left.drop_columns(["_lane", "_salt"]).append_column(output, found)

    schema = df.withColumn(output, F.lit(None).cast("double")).schema
    return rows.groupBy("_lane", "_salt").cogroup(salted.groupBy("_lane", "_salt")).applyInArrow(score, schema)

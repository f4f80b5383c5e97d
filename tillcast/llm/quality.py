"""Document quality: histogram gradient-boosted trees over document statistics.

Statistics of whole texts come from array operations over the bytes and word hashes of a
batch. Trees are grown level by level on histograms of binned statistics of a bounded
labelled sample; all trees are complete and flattened into arrays, so a batch goes
through all trees by ``depth`` gathers.

Undefined and edge cases: a null or empty text has statistics of zero and is scored like
any other. Without labels, or with one class only, every score is the (smoothed) share of
that class. Texts may be of any length. Every row gives a row, whatever its id. Other
columns are not read. An empty table gives an empty result.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import arrow, labelled, text

TREES, DEPTH, BINS, RATE, PENALTY = 80, 4, 64, 0.15, 2.0
ACCEPT = 0.7

#: Frequent short words of the languages that corpora hold most of.
COMMON = ("the of and to in a is that it for on was with as be by this are from or an der die das und in zu den mit ist von "
          "im des ein eine nicht auch es le la les de des et en un une que est pour dans du au el los las y del por con para "
          "se su al lo como").split()
_COMMON = np.unique(np.concatenate([text.word_hash(w) for w in COMMON]))


def _table(*spans):
    out = np.zeros(256, dtype=np.uint8)
    for lo, hi in spans:
        out[lo:hi + 1] = 1
    return out


_LOWER, _UPPER, _DIGIT = _table((97, 122)), _table((65, 90)), _table((48, 57))
_STOP = np.zeros(256, dtype=np.uint8)
_STOP[[33, 46, 63]] = 1
_MARK = _table((33, 47), (58, 64), (91, 96), (123, 126))
_PLAIN_MARK = np.zeros(256, dtype=np.uint8)
_PLAIN_MARK[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 1
_HEAD = np.ones(256, dtype=np.uint8)
_HEAD[128:192] = 0
_CLASSES = (_HEAD, _LOWER, _UPPER, _DIGIT, text.SPACE.astype(np.uint8), _MARK, _MARK & ~_PLAIN_MARK & 1, _table((33, 33)),
            _table((124, 124)), _table((10, 10)), _STOP, _table((128, 255)))
FEATURES = 25


def _per_text(values, offsets):
    """Sums of an array over each text's bytes."""
    out = np.zeros(len(offsets) - 1, dtype=np.float64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.int64)
    return out


def statistics(column):
    """One row of document statistics per text."""
    data, offsets = text.buffers(column)
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    chars, lower, upper, digit, space, mark, odd, bang, bar, line, stop, wide = (
        _per_text(c[data], offsets) for c in _CLASSES)
    hashes, docs, starts, ends = text.words(data, offsets, spans=True)
    words = np.bincount(docs, minlength=n).astype(np.float64)
    length = (ends - starts).astype(np.float64)
    per_word = lambda x: np.bincount(docs, x, minlength=n) / np.maximum(words, 1)
    begin = text.runs(docs, n)
    distinct, most, longest = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in np.flatnonzero(words).tolist():
        own = np.sort(hashes[begin[i]:begin[i + 1]])
        edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
        distinct[i], most[i] = len(edge) - 1, np.diff(edge).max()
        longest[i] = length[begin[i]:begin[i + 1]].max()
    twice = np.zeros(len(hashes))
    if len(hashes):
        twice[1:] = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1])
    last = data[ends - 1] if len(ends) else data[:0]
    first = data[starts] if len(starts) else data[:0]
    common = _COMMON[np.minimum(np.searchsorted(_COMMON, hashes), len(_COMMON) - 1)] == hashes
    many, some = np.maximum(words, 1), np.maximum(chars, 1)
    lines = line + (size > 0)
    return np.stack([
        np.log1p(chars), np.log1p(words), per_word(length), distinct / many, most / many, upper / np.maximum(lower + upper, 1),
        digit / some, space / some, mark / some, odd / some, bang / some, bar / some, np.log1p(lines),
        chars / np.maximum(lines, 1), words / np.maximum(lines, 1), stop / many, wide / np.maximum(size, 1), longest,
        per_word(twice), per_word(common), per_word((_MARK & ~_PLAIN_MARK & 1)[last]), per_word(_UPPER[first]),
        per_word(length <= 2), per_word((length == 1) & (_MARK[first] > 0)), stop / np.maximum(lines, 1)], axis=1)


@dataclass
class Forest:
    """Complete trees as arrays: feature and threshold by (tree, node), value by (tree, leaf)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x):
        total = np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - (len(v) - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x, y, trees=TREES, depth=DEPTH, bins=BINS, rate=RATE, penalty=PENALTY):
    """Boosted trees for the log-odds of y (0 or 1)."""
    n, width = x.shape if len(x) else (0, FEATURES)
    share = (y.sum() + 0.5) / (n + 1) if n else 0.5
    base = float(np.log(share / (1 - share)))
    nodes, leaves = 2 ** depth - 1, 2 ** depth
    if n == 0 or y.min() == y.max():
        return Forest(base, *(np.zeros((0, k)) for k in (nodes, nodes, leaves)))
    cuts = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(width)]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    cell = code + np.arange(width) * bins
    total = np.full(n, base)
    features, thresholds, values = (np.zeros((trees, nodes), dtype=np.int64), np.full((trees, nodes), np.inf),
                                    np.zeros((trees, leaves)))
    gains = lambda g, h: g * g / (h + penalty)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            flat = ((at - first)[:, None] * (width * bins) + cell).ravel()
            sums = [np.bincount(flat, np.repeat(v, width), minlength=many * width * bins).reshape(many, width, bins).cumsum(2)
                    for v in (g, h)]
            left, all_ = [s[:, :, :-1] for s in sums], [s[:, :, -1:] for s in sums]
            gain = gains(*left) + gains(all_[0] - left[0], all_[1] - left[1]) - gains(*all_)
            gain[(left[1] < 1) | (all_[1] - left[1] < 1)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                j, b = divmod(int(best[k]), bins - 1)
                if gain[k, j, b] > 1e-9 and b < len(cuts[j]):
                    features[t, first + k], thresholds[t, first + k] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), features[t, at]] > thresholds[t, at])
        at -= nodes
        values[t] = rate * np.bincount(at, g, minlength=leaves) / (np.bincount(at, h, minlength=leaves) + penalty)
        total += values[t][at]
    return Forest(base, features, thresholds, values)


def _sample_statistics(batches):
    for batch in arrow.slices(batches, "text", arrow.FINE):
        found = statistics(batch.column("text"))
        yield pa.record_batch({"label": batch.column("label"), "x": pa.array(list(found), pa.list_(pa.float64()))})


def train(documents: DataFrame, labels: DataFrame, *, rows=None, label="quality", bound=labelled.SAMPLE) -> Forest:
    """Fit on at most ``bound`` labelled documents."""
    found = labelled.sample(documents, labels, label, rows=rows, bound=bound) \
        .mapInArrow(_sample_statistics, "label int, x array<double>").toPandas()
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(-1, FEATURES)
    y = (found["label"].to_numpy(dtype=np.int64) > 0).astype(np.float64)
    order = np.lexsort((*x.T, y))   # the fit does not depend on the order of rows
    return fit(x[order], y[order])


def score(documents: DataFrame, model: Forest, *, held_out=None, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in arrow.slices(batches, "text", arrow.FINE):
            found = shared.value.score(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= ACCEPT).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"),
        F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def accepted(documents: DataFrame, model: Forest, *, text_col="text", least=ACCEPT) -> DataFrame:
    """The rows whose text scores at least ``least``, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in arrow.slices(batches, text_col, arrow.FINE):
            yield batch.filter(pa.array(shared.value.score(statistics(batch.column(text_col))) >= least))

    return documents.mapInArrow(keep, documents.schema)

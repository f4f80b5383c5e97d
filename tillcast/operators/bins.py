"""Feature bins from mergeable weighted quantile summaries."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialize

ENTRIES = 2048          # pairs of a summary; each thinning moves ranks by at most 1/ENTRIES of its weight
SALTS = 32


def thin(values, weights, entries):
    """At most ``entries`` (value, weight) pairs, in order, whose ranks are those of the given pairs, nearly."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    if len(values):
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        values, weights = values[first], np.add.reduceat(weights, first)
    if len(values) <= entries:
        return values, weights
    stops = np.cumsum(weights)
    at = np.searchsorted(stops, (np.arange(entries) + 0.5) * (stops[-1] / entries))
    at, many = np.unique(np.minimum(at, len(values) - 1), return_counts=True)
    return values[at], many * (stops[-1] / entries)


class Summary:
    """A weighted quantile summary of one feature.

    Thinned summaries carry like digits of a binary counter: two of one level merge into one
    of the next, so a value is thinned once per level, and levels grow with the logarithm
    of the number of rows. The rank error is at most the number of levels over ``entries``.
    """

    def __init__(self, entries=ENTRIES):
        self.entries, self.loose, self.size, self.levels = entries, [], 0, {}

    def add(self, values, weights):
        found = ~np.isnan(values) & (weights > 0)
        self.loose.append((values[found], weights[found]))
        self.size += int(found.sum())
        if self.size >= 4 * self.entries:
            self.carry(0, *(np.concatenate(c) for c in zip(*self.loose)))
            self.loose, self.size = [], 0

    def carry(self, level, values, weights):
        values, weights = thin(values, weights, self.entries)
        while level in self.levels:
            own = self.levels.pop(level)
            values, weights = thin(np.concatenate([own[0], values]), np.concatenate([own[1], weights]), self.entries)
            level += 1
        self.levels[level] = values, weights

    def parts(self):
        """(level, values, weights) of all that was added; loose pairs have level -1."""
        loose = [(-1, *thin(*(np.concatenate(c) for c in zip(*self.loose)), 4 * self.entries))] if self.loose else []
        return loose + [(k, *v) for k, v in sorted(self.levels.items())]

    def merge(self, level, values, weights):
        if level < 0:
            self.add(values, weights)
        else:
            self.carry(level, values, weights)

    def edges(self, bins):
        """Upper ends of all bins but the last; with few values each has its own bin."""
        parts = self.parts()
        if not parts:
            return np.zeros(0)
        values, weights = thin(*(np.concatenate([p[i] for p in parts]) for i in (1, 2)), 1 << 62)
        if len(values) <= bins:
            return values[:-1]
        stops = np.cumsum(weights)
        at = np.searchsorted(stops, np.arange(1, bins) * (stops[-1] / bins) * (1 - 1e-12))
        return np.unique(values[at[at < len(values) - 1]])


_SUMMARY = "feature int, salt int, source int, level int, value array<double>, weight array<double>"
_NAMES = ["feature", "salt", "source", "level", "value", "weight"]


def _emit(found):
    rows = [(f, salt, source, *part) for (f, salt, source), s in found.items() for part in s.parts()]
    kinds = [pa.int32()] * 4 + [pa.list_(pa.float64())] * 2
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _NAMES)


def fit_edges(df: DataFrame, inputs, weight=None, bins=64, entries=ENTRIES) -> list:
    """Bin edges of every input, from one pass and two small merges; nothing but edges reaches the driver."""
    inputs = list(inputs)
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)],
                     (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))

    def gather(batches):
        source = TaskContext.get().partitionId()
        found = {(i, source % SALTS, source): Summary(entries) for i in range(len(inputs))}
        for batch in batches:
            w = batch.column("w").fill_null(0.0).to_numpy(zero_copy_only=False)
            for (i, _, _), summary in found.items():
                summary.add(batch.column(f"x{i}").fill_null(np.nan).to_numpy(zero_copy_only=False), w)
        yield _emit(found)

    def merged(batches):
        found = {}
        for batch in batches:
            values, weights = batch.column("value"), batch.column("weight")
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("feature", "salt", "level")))):
                found.setdefault((*key[:2], 0), Summary(entries)).merge(key[2], values[i].values.to_numpy(), weights[i].values.to_numpy())
        return found

    def merge(batches):
        yield _emit(merged(batches))

    def cut(batches):
        found = merged(batches)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int32()), pa.array(
            [s.edges(bins) for s in found.values()], pa.list_(pa.float64()))], ["feature", "edges"])

    order = ["feature", "salt", "source", "level", "value"]
    parts = rows.mapInArrow(gather, _SUMMARY).repartition("feature", "salt").sortWithinPartitions(order).mapInArrow(merge, _SUMMARY)
    parts = parts.withColumn("source", F.col("salt")).withColumn("salt", F.lit(0)).repartition("feature").sortWithinPartitions(order)
    out = {r.feature: np.array(r.edges) for r in parts.mapInArrow(cut, "feature int, edges array<double>").collect()}
    return [out.get(i, np.zeros(0)) for i in range(len(inputs))]


@dataclass
class Binned:
    """Rows with their bins (one byte per input, in order), written once for every fit."""

    frame: DataFrame
    inputs: list
    edges: list


def bin_rows(df: DataFrame, inputs, keep, weight=None, fit_on=None, bins=64) -> Binned:
    """Bins of ``inputs`` beside the columns ``keep``; edges come from the rows ``fit_on`` (all by default).

    A value lies in the first bin whose edge is not below it; null and NaN lie in the last one.
    """
    inputs, keep = list(inputs), list(dict.fromkeys(keep))
    if bins > 256:
        raise ValueError("a bin number is one byte")
    edges = fit_edges(df if fit_on is None else fit_on, inputs, weight, bins)
    rows = df.select(*keep, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(inputs)])

    def binned(batches):
        for batch in batches:
            out = np.empty((batch.num_rows, len(inputs)), dtype=np.uint8)
            for i, edge in enumerate(edges):
                out[:, i] = np.searchsorted(edge, batch.column(f"_x{i}").fill_null(np.nan).to_numpy(zero_copy_only=False))
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(inputs))
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends.buffers()[1], pa.py_buffer(out.tobytes())])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), packed], [*keep, "bins"])

    kinds = ", ".join(f"`{c}` {k}" for c, k in df.select(*keep).dtypes)
    return Binned(materialize(rows.mapInArrow(binned, f"{kinds}, bins binary"), "binned"), inputs, edges)


def unpack(column, size):
    """The bins (rows, size) of an Arrow column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros((0, size), dtype=np.uint8)
    first = np.frombuffer(offsets, dtype=np.int32)[column.offset]
    return np.frombuffer(data, dtype=np.uint8)[first:first + len(column) * size].reshape(len(column), size)

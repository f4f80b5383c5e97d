"""Exact medians of many columns without gathering a column in one task."""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.operators.bins import SALTS, Summary, thin
from tillcast.session import materialize

ACCURACY = 1_000
ENTRIES = 4096          # pairs of a summary; its ranks are far closer than the margin of a bracket
MAX_ROWS = 1_000_000
MOST_HELD = 1 << 16     # values of a column that a task holds before it counts them


@dataclass
class Bracket:
    """A value range that holds the two middle ranks of one column."""

    lo: float | None = None
    hi: float | None = None
    first: int = 0
    second: int = 0
    below: int = 0
    targets: tuple = (0.5, 0.5)
    margin: float = 2.0 / ACCURACY

    def holds(self, column):
        return F.col(column).isNotNull() if self.lo is None else F.col(column).between(self.lo, self.hi)

    def probabilities(self):
        return [max(0.0, self.targets[0] - self.margin), min(1.0, self.targets[1] + self.margin)]


def _inside(x, lo, hi):
    """Which of the non-null values ``x`` lie in a bracket; NaN lies above all numbers."""
    if lo is None:
        return np.ones(len(x), dtype=bool)
    return (x >= lo) & (x <= hi) if hi == hi else (x >= lo) | np.isnan(x)


def _columns(batch, names):
    """The non-null values of each column of a batch."""
    for c in names:
        yield c, batch.column(c).drop_null().to_numpy(zero_copy_only=False) + 0.0


def _sketch(data, brackets):
    """Approximate quantiles just around the target ranks, all columns in one pass and two small merges."""
    wanted = {c: (b.lo, b.hi, b.probabilities()) for c, b in brackets.items()}

    def pairs(summary):
        return (np.concatenate(x) for x in zip(*(p[1:] for p in summary.parts())))

    def rows(found):
        one = [(*key, *thin(*pairs(s), ENTRIES)) for key, s in found.items() if s.parts()]
        one = [r for r in one if len(r[2])]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in one], k) for i, k in enumerate(_SKETCH.types)], schema=_SKETCH)

    def gather(batches):
        found = {(c, TaskContext.get().partitionId() % SALTS): Summary(ENTRIES) for c in wanted}
        for batch in batches:
            for (c, x), summary in zip(_columns(batch, wanted), found.values()):
                x = x[_inside(x, *wanted[c][:2])]
                summary.add(np.where(np.isnan(x), np.inf, x), np.ones(len(x)))
        yield rows(found)

    def merged(batches):
        found = {}
        for batch in batches:
            for i, (c, salt) in enumerate(zip(batch.column("name").to_pylist(), batch.column("salt").to_pylist())):
                found.setdefault((c, salt), Summary(ENTRIES)).merge(0, *(batch.column(k)[i].values.to_numpy() for k in ("value", "weight")))
        return found

    def merge(batches):
        yield rows(merged(batches))

    def cut(batches):
        for (c, _), summary in merged(batches).items():
            values, weights = thin(*pairs(summary), 1 << 62)
            stops = np.cumsum(weights)
            at = np.searchsorted(stops, np.array(wanted[c][2]) * stops[-1] * (1 - 1e-12))
            yield pa.RecordBatch.from_pydict({"name": [c], "ends": pa.array([values[np.minimum(at, len(values) - 1)]], pa.list_(pa.float64()))})

    kinds = "name string, salt int, value array<double>, weight array<double>"
    parts = data.mapInArrow(gather, kinds).repartition("name", "salt").mapInArrow(merge, kinds)
    parts = parts.withColumn("salt", F.lit(0)).repartition("name").mapInArrow(cut, "name string, ends array<double>")
    out = {}
    for c, (lo, hi) in parts.collect():
        whole, (first, last) = (-math.inf, math.nan) if wanted[c][0] is None else wanted[c][:2], wanted[c][2]
        # summaries thin out the ends, and an end at infinity stands for NaN, too
        out[c] = whole[0] if first == 0.0 else lo, whole[1] if last == 1.0 else math.nan if hi == math.inf else hi
    return out


_SKETCH = pa.schema([("name", pa.string()), ("salt", pa.int32()), ("value", pa.list_(pa.float64())), ("weight", pa.list_(pa.float64()))])


def _count(data, ranges):
    """Per column its rows, those below a range and those inside it, and the written counts of the values inside; one pass."""
    def count(batches):
        many, loose, held = {c: [0, 0] for c in ranges}, {c: [] for c in ranges}, dict.fromkeys(ranges, 0)

        def counted(c):
            values, rows = (np.concatenate(x) for x in zip(*loose[c]))
            values, at = np.unique(values, return_inverse=True)
            return values, np.bincount(at, rows, len(values)).astype(np.int64)

        def flush(c):
            values, rows = counted(c) if loose[c] else (np.zeros(0), np.zeros(0, dtype=np.int64))
            loose[c], held[c] = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([c] * len(values), pa.string()), pa.array(values), pa.array(rows), *[pa.nulls(len(values), pa.int64())] * 2], schema=_COUNTED)

        for batch in batches:
            for c, x in _columns(batch, ranges):
                inside = x[_inside(x, *ranges[c])]
                many[c][0] += len(x)
                many[c][1] += int(np.count_nonzero(x < ranges[c][0]))
                loose[c].append((inside, np.ones(len(inside))))
                held[c] += len(inside)
                if held[c] > MOST_HELD:
                    loose[c] = [counted(c)]
                    held[c] = len(loose[c][0][0])
                    if held[c] > MOST_HELD // 2:
                        yield flush(c)
        for c in ranges:
            yield flush(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(many), pa.string()), pa.nulls(len(many), pa.float64()), pa.nulls(len(many), pa.int64()),
             *(pa.array([m[i] for m in many.values()], pa.int64()) for i in (0, 1))], schema=_COUNTED)

    found = materialize(data.mapInArrow(count, "name string, value double, rows long, n long, below long"), "medians")
    sums = found.groupBy("name").agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("n", "below", "rows")])
    return {r["name"]: (r["n"], r["below"], r["rows"]) for r in sums.collect()}, found.where("rows is not null")


_COUNTED = pa.schema([("name", pa.string()), ("value", pa.float64()), ("rows", pa.int64()), ("n", pa.int64()), ("below", pa.int64())])


def exact_medians(df, columns, max_rows=MAX_ROWS):
    """Interpolating medians, as ``{column: value}`` (None for an all-NULL column).

    A sketch brackets the middle ranks of all columns in one pass; a second pass counts
    the rows below the brackets, and the values inside them. Brackets with too many rows
    shrink by the same two passes again, each time more than a hundredfold; one that cannot
    shrink is held up by very frequent values at its ends, which are counted apart and left
    behind. The counts are added across the cluster, and only the middle values leave it.
    So no task ever sorts more than ``max_rows`` values of a column. Columns are worked on
    as arrays. NaN counts as larger than every number.
    """
    columns = list(dict.fromkeys(columns))
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    medians = dict.fromkeys(columns)
    open_brackets = {c: Bracket() for c in columns}
    while open_brackets:
        done, ranges = {}, _sketch(data, open_brackets)
        open_brackets = {c: b for c, b in open_brackets.items() if c in ranges}
        if not ranges:
            break
        (counts, inside_rows), held_up = _count(data, ranges), {}
        for c, bracket in list(open_brackets.items()):
            n, below, inside = counts[c]
            first, second = (n - 1) // 2, n // 2
            if not below <= first <= second < below + inside:
                bracket.margin *= 8
                continue
            stuck = (bracket.lo, bracket.hi) == ranges[c]
            bracket.lo, bracket.hi = ranges[c]
            bracket.first, bracket.second, bracket.below = first, second, below
            bracket.targets = ((first - below) / inside, (second - below) / inside)
            if bracket.lo == bracket.hi:
                medians[c] = bracket.lo
                del open_brackets[c]
            elif inside <= max_rows:
                done[c] = open_brackets.pop(c)
            elif stuck:
                held_up[c] = inside
        for c, median in _leave_ends(data, open_brackets, held_up).items():
            medians[c] = median
            del open_brackets[c]
        if done:
            medians.update(_middle_values(inside_rows, done))
    return medians


def _leave_ends(data, brackets, held_up):
    """Move brackets inside their end values; medians that the ends decide are returned."""
    if not held_up:
        return {}
    aggs = []
    for c in held_up:
        lo, hi, x = F.lit(brackets[c].lo), F.lit(brackets[c].hi), F.col(c)
        within = (x > lo) & (x < hi)
        aggs += [F.count_if(x == lo).alias(f"{c}|lo"), F.count_if(x == hi).alias(f"{c}|hi"),
                 F.min(F.when(within, x)).alias(f"{c}|next"), F.max(F.when(within, x)).alias(f"{c}|last")]
    ends, decided = data.agg(*aggs).first().asDict(), {}
    for c, inside in held_up.items():
        b, n_lo, n_hi = brackets[c], ends[f"{c}|lo"], ends[f"{c}|hi"]
        first, second = b.first - b.below, b.second - b.below
        if n_lo <= first and second < inside - n_hi:
            b.lo, b.hi, b.below = ends[f"{c}|next"], ends[f"{c}|last"], b.below + n_lo
            b.targets = tuple((r - n_lo) / (inside - n_lo - n_hi) for r in (first, second))
            if b.lo == b.hi:
                decided[c] = b.lo
        else:  # ranks follow each other, so one beside an end run is its neighbour
            low = b.lo if first < n_lo else ends[f"{c}|last"] if first < inside - n_hi else b.hi
            high = b.hi if second >= inside - n_hi else ends[f"{c}|next"] if second >= n_lo else b.lo
            decided[c] = (low + high) / 2
    return decided


def _middle_values(inside, brackets):
    """The median of each column from the value counts inside its bracket."""
    def per_column(attribute):
        pairs = [F.lit(x) for c, b in brackets.items() for x in (c, getattr(b, attribute))]
        return F.create_map(*pairs)[F.col("name")]

    counted = inside.where(F.col("name").isin(list(brackets))).groupBy("name", "value").agg(F.sum("rows").alias("rows"))
    upto = Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("upto", F.sum("rows").over(upto) + per_column("below"))
    start = F.col("upto") - F.col("rows")
    at_first = (start <= per_column("first")) & (per_column("first") < F.col("upto"))
    at_second = (start <= per_column("second")) & (per_column("second") < F.col("upto"))
    middle = ranked.filter(at_first | at_second).groupBy("name").agg(
        ((F.max(F.when(at_first, F.col("value"))) + F.max(F.when(at_second, F.col("value")))) / 2)
        .alias("median"))
    return {r["name"]: r["median"] for r in middle.collect()}

"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of documents with a target share of all tokens. A round fills one
window of ``window`` sequences (one by default). In every round each queue earns credit in
proportion to its share and serves as many quanta of ``quantum`` tokens as its credit
covers, cutting documents where a quantum ends; what is left is carried to the next round.
When a queue is empty, the others share its credit. A queue's first quantum is served
early by a part of its length that a hash of its name gives, so many small queues of equal
share do not all serve in the same round.

As credit grows in a straight line between two queues running empty, the round that serves
a quantum follows from its number in its queue: no pass over the queue is needed, and
deficits carry over windows and partitions alike. Consecutive quanta of one document that
the same round serves are one part. Places in queues and in the output are running sums
over blocks (see ``numbering``), so one source may hold any part of all rows and one
document any part of its source. The output is one stream of tokens in order of (round,
queue, place), cut every ``length`` tokens, so only the last sequence can need padding. As
a queue is at most one quantum ahead of or behind its credit, so is each queue's part of
the stream up to any window.

Every source has its own queue, however small it is; queues, totals and shares are a
written table that is joined to the rows. Queues that keep their share of tokens all run
empty together, so only the sources with a given weight add times at which one runs empty.

Undefined and edge cases: a null text is empty: its end token alone is packed. A null
source is a source of its own. Every row is packed, repeated rows and rows without id as
well. Texts may be of any length. Other columns are not read. An empty table gives an
empty result.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import arrow, bpe, numbering, text
from tillcast.session import materialize

LENGTH = 2048
WINDOW = 1              # sequences that one round fills
QUANTA = 16             # quanta in a sequence
NEAR = 64               # sequences whose parts one task orders
END = 1
SLICE = 1 << 20         # bytes of text encoded at once
ROWS = 1000             # texts that reach a task at once

TOKENS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()),
                    ("ids", pa.binary())])
PARTS = pa.schema([("row", pa.int64()), ("queue", pa.string()), ("round", pa.int64()), ("at", pa.int64()),
                   ("start", pa.int64()), ("size", pa.int64())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("queue", pa.string()), ("round", pa.int64())])


def _tokens(vocabulary, end):
    def tokens(batches):
        encoder = bpe.Encoder.load(vocabulary)
        for batch in arrow.slices(batches, "text", SLICE):
            data, offsets = text.buffers(batch.column("text"))
            ids, begin = encoder.encode(data, offsets)
            n = batch.num_rows
            out = np.full(len(ids) + n, end, dtype="<u2" if ids.max(initial=end) < 1 << 16 else "<u4")
            out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(begin))] = ids
            ends = (begin + np.arange(n + 1)).astype(np.int64)
            runs = pa.py_buffer((ends * out.itemsize).astype(np.int32).tobytes())
            packed = pa.Array.from_buffers(pa.binary(), n, [None, runs, pa.py_buffer(out.tobytes())])
            yield pa.record_batch([batch.column("row"), batch.column("doc_id"), batch.column("source"),
                                   pa.array(np.diff(ends)), packed], schema=TOKENS)

    return tokens


def ranges(first, last):
    """Owners and members of the whole numbers ``first`` to ``last``, both included, of each pair."""
    many = last - first + 1
    owner = np.repeat(np.arange(len(first)), many)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + first[owner]


def rounds(k, phase, weight, total, plan, quantum, fill):
    """The round that serves quantum ``k`` of a queue; all but ``plan`` and the sizes are arrays."""
    times, every = plan
    credit = np.minimum((k + 1 - phase) * quantum, total)
    return np.maximum(np.ceil(np.interp(credit / weight, times, every) / fill - 1e-9).astype(np.int64) - 1, 0)


def _parts(plan, quantum, fill):
    """Cut rows where the round changes."""
    def parts(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            before, n, weight, total, phase = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("before", "n", "weight", "total", "phase"))
            owner, k = ranges(before // quantum, (before + n - 1) // quantum)
            turn = rounds(k, phase[owner], weight[owner], total[owner], plan, quantum, fill)
            new = np.ones(len(k), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (turn[1:] != turn[:-1])
            owner, at, turn = owner[new], np.maximum(k[new] * quantum, before[owner[new]]), turn[new]
            last = np.append(owner[1:] != owner[:-1], True)
            stop = np.where(last, (before + n)[owner], np.append(at[1:], 0))
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(take), batch.column("queue").take(take), pa.array(turn), pa.array(at),
                 pa.array(at - before[owner]), pa.array(stop - at)], schema=PARTS)

    return parts


def _pieces(length):
    """Cut the parts of each document where a sequence ends."""
    def pieces(batches):
        for batch in arrow.slices(batches, "ids", SLICE):
            if not batch.num_rows:
                continue
            held = batch.column("parts")
            many = pc.list_value_length(held).to_numpy(zero_copy_only=False)
            flat = held.flatten()
            start, size, place, turn = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("start", "size", "place", "round"))
            part, sequence = ranges(place // length, (place + size - 1) // length)
            at = np.maximum(place[part], sequence * length)
            stop = np.minimum((place + size)[part], (sequence + 1) * length)
            begin, row = start[part] + at - place[part], np.repeat(np.arange(batch.num_rows), many)[part]
            n, sums, last, ids = batch.column("n").to_pylist(), np.empty(len(row), dtype=np.int64), -1, None
            for i, (r, a, b) in enumerate(zip(row.tolist(), begin.tolist(), (begin + stop - at).tolist())):
                if r != last:
                    raw = batch.column("ids")[r].as_py()
                    last, ids = r, np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n[r] else "<u4").astype("<u4")
                sums[i] = zlib.crc32(ids[a:b])
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), pa.array(begin), pa.array(stop - at), pa.array(sums),
                 batch.column("n").take(take), pa.array(sequence), pa.array(at - sequence * length),
                 batch.column("queue").take(take), pa.array(turn[part])], schema=PIECES)

    return pieces


def served(totals, weights):
    """For each queue: breakpoints of its own tokens and of all queues' tokens served by then.

    All queues earn credit weight by weight; a queue of ``totals`` tokens is empty at time
    total / weight. Between two such times all counts grow in straight lines.
    """
    names = sorted(totals)
    full, share = np.array([totals[q] for q in names], dtype=float), np.array([weights[q] for q in names], dtype=float)
    ends = full / share
    times = np.unique(np.concatenate([[0.0], ends]))
    rank = np.argsort(ends, kind="stable")
    empty = np.searchsorted(ends[rank], times, side="right")    # queues that are empty by each time
    done = np.concatenate([[0.0], np.cumsum(full[rank])])[empty]
    live = np.concatenate([np.cumsum(share[rank][::-1])[::-1], [0.0]])[empty]
    every = done + times * live
    return {q: (weights[q], times, every) for q in names}


def pack(documents: DataFrame, *, weights=None, length=LENGTH, window=WINDOW, quantum=None, vocabulary="byte_bpe_50k", end=END,
         id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row per piece of a document; see the module.

    ``weights`` maps sources to target shares; by default each source's share of tokens,
    which makes all queues run empty together. Sources without weight keep their share.
    ``quantum`` is a sixteenth of a sequence by default.
    """
    spark = documents.sparkSession
    docs = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    with arrow.small_batches(spark, ROWS):
        tokens = materialize(docs.mapInArrow(
            _tokens(vocabulary, end), "row long, doc_id long, source string, n long, ids binary"), "tokens")
    per = tokens.groupBy("source").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    size = per.agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")).first()
    scale = size.n or 1
    given = spark.createDataFrame([(s, float(w)) for s, w in (weights or {}).items()], "_source string, _weight double")
    queues = materialize(per.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("_source")), "left").select(
        F.col("source").alias("_source"), F.coalesce(F.concat(F.lit("source "), "source"), F.lit("no source")).alias("queue"),
        F.col("n").alias("_total"), F.coalesce("_weight", F.col("n") / F.lit(scale)).alias("weight"),
        F.col("_weight").isNotNull().alias("_given")), "queues")
    # queues without a given weight run empty together, as one queue of all their tokens would
    own = queues.where("_given").collect()
    rest = (size.n or 0) - sum(r._total for r in own)
    totals = {(r.queue,): r._total for r in own} | ({(): rest} if rest else {})
    plan = served(totals, {(r.queue,): r.weight for r in own} | {(): rest / scale})
    _, times, every = next(iter(plan.values()), (1.0, np.zeros(1), np.zeros(1)))

    rows = tokens.select("row", "doc_id", "source", "n").join(
        queues.select("_source", "queue", "weight", "_total"), F.col("source").eqNullSafe(F.col("_source")))
    blocks = numbering.block_count(size.rows or 0)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    rows = numbering.running_sum(rows, "queue", "block", ["row"], "n", "before").select(
        "row", "queue", "before", "n", "weight", F.col("_total").alias("total"),
        (F.pmod(F.xxhash64("queue"), F.lit(1 << 20)) / F.lit(1 << 20)).alias("phase"))
    quantum, fill = quantum or max(1, length // QUANTA), window * length
    parts = materialize(rows.mapInArrow(
        _parts((times, every), quantum, fill), "row long, queue string, round long, at long, start long, size long"), "parts")
    parts = parts.withColumn("group", F.floor(F.col("round") * window / NEAR)).withColumn("all", F.lit(0))
    parts = numbering.running_sum(parts, "all", "group", ["round", "queue", "at"], "size", "place")
    # as many parts as a document has quanta at most
    placed = parts.groupBy(F.col("row").alias("_row")).agg(
        F.first("queue").alias("queue"), F.sort_array(F.collect_list(F.struct("start", "size", "place", "round"))).alias("parts"))
    out = tokens.select("row", "doc_id", "n", "ids").join(placed, F.col("row") == F.col("_row")).select(
        "doc_id", "n", "queue", "parts", "ids")
    return out.mapInArrow(
        _pieces(length), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, queue string, round long")

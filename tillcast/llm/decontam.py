"""Benchmark decontamination by SimHash windows, multi-index Hamming tables and weighted shingles.

For each benchmark item the corpus is read in windows of the item's number of words. A
window's fingerprint adds up the signs of its shingles' hashes, each as often as it
occurs. Fingerprints of items of one size are cut into blocks; a table per block holds
every value within the flips that one block must stay below when the whole distance is
within the radius, so by the pigeonhole principle every item within the radius is found.
Candidates are verified by the weighted Jaccard similarity of their shingles (each weighs
as often as it occurs), the sum of minima over the sum of maxima.

Only windows that share a shingle with an item of their size are fingerprinted: any other
has similarity zero, so nothing is lost by that. At similarity 0.8 a fingerprint of 64
bits differs in 10 bits on average (3 standard deviations: 18); the radius is 20.

The benchmark is a stated query set. It is read in blocks of about ``ITEMS`` items, each
of which is broadcast and held against all documents.

Undefined and edge cases: words are runs of ASCII letters, digits and non-ASCII bytes,
with A-Z lower-cased. An item shorter than a shingle is one shingle, its whole sequence;
an item without words matches nothing. A document shorter than an item is one window. Null
and empty texts match nothing. Items with equal ids or texts are each reported. Repeated
rows and rows without id are tested row by row. An empty table on either side gives no
matches.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import arrow, text

WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 8              # blocks of 8 bits
ITEMS = 20_000
_SEEN = 1 << 22         # places of the table that sorts out shingles of no item

MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()),
                     ("first_word", pa.int64()), ("n_words", pa.int64())])


def fingerprints(shingles):
    """SimHash of each row of a matrix of shingle hashes; 0 stands for no shingle."""
    rows, width = shingles.shape
    out = np.empty(rows, dtype=np.uint64)
    step = max(1, (1 << 22) // (64 * max(width, 1)))
    for a in range(0, rows, step):
        part = np.ascontiguousarray(shingles[a:a + step])
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), width, 8), axis=2)
        ones = bits.sum(axis=1, dtype=np.int32)
        whole = (part != 0).sum(axis=1)[:, None]
        out[a:a + step] = np.packbits(2 * ones >= whole, axis=1).view(np.uint64).ravel()
    return out


class Index:
    """Items by size, with Hamming tables and the shingles that anchor windows."""

    def __init__(self, ids, texts, words=WORDS, similarity=SIMILARITY, radius=RADIUS):
        self.words, self.similarity, self.radius = words, similarity, radius
        self.ids, self.sizes, self.counts = ids, {}, []
        anchors = {}
        raw = "".join(x or "" for x in texts).encode()
        ends = np.cumsum([len((x or "").encode()) for x in texts])
        hashes, docs = text.words(np.frombuffer(raw, np.uint8), np.concatenate([[0], ends]).astype(np.int64), text.ALNUM)
        begin = text.runs(docs, len(texts))
        groups = {}
        for i in range(len(texts)):
            own = hashes[begin[i]:begin[i + 1]]
            k = min(words, len(own))
            parts = text.shingles(own, np.zeros(len(own), np.int32), k)[0] if k else own
            self.counts.append(Counter(parts.tolist()))
            if k:
                groups.setdefault(len(own), []).append((i, parts))
                for s in parts.tolist():
                    anchors.setdefault(k, {}).setdefault(s, set()).add(len(own))
        flips = radius // BLOCKS
        near = [v for v in range(256) if bin(v).count("1") <= flips]
        for size, found in groups.items():
            items = np.array([i for i, _ in found])
            prints = fingerprints(np.stack([p for _, p in found]))
            tables = []
            for b in range(BLOCKS):
                value = (prints >> np.uint64(8 * b)).astype(np.uint8)
                pairs = np.array([(v ^ x, j) for j, v in enumerate(value.tolist()) for x in near])
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                tables.append((np.searchsorted(pairs[:, 0], np.arange(257)), pairs[:, 1]))
            self.sizes[size] = (items, prints, tables)
        self.anchors = {}
        for k, found in anchors.items():
            keys = np.array(sorted(found), dtype=np.uint64)
            seen = np.zeros(_SEEN, dtype=bool)
            seen[keys & np.uint64(_SEEN - 1)] = True
            sizes = [sorted(found[int(s)]) for s in keys]
            self.anchors[k] = (keys, seen, np.concatenate([[0], np.cumsum([len(s) for s in sizes])]),
                               np.array([m for s in sizes for m in s]))

    def near(self, size, prints):
        """(window, item) pairs of one size within the radius."""
        items, own, tables = self.sizes[size]
        pairs = []
        for b, (begin, entries) in enumerate(tables):
            value = (prints >> np.uint64(8 * b)).astype(np.uint8).astype(np.int64)
            many = begin[value + 1] - begin[value]
            window = np.repeat(np.arange(len(prints)), many)
            item = entries[np.repeat(begin[value] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            close = np.bitwise_count(prints[window] ^ own[item]) <= self.radius
            pairs.append(window[close] * len(items) + item[close])
        pairs = np.unique(np.concatenate(pairs))
        return pairs // len(items), items[pairs % len(items)]

    def matches(self, column):
        """(row, item, similarity, first word, words) of the best window of each matched pair."""
        data, offsets = text.buffers(column)
        hashes, docs = text.words(data, offsets, text.ALNUM)
        begin = text.runs(docs, len(offsets) - 1)
        best = {}
        for k, (keys, seen, lists, sizes) in self.anchors.items():
            values, _, at = text.shingles(hashes, docs, k)
            hit = np.flatnonzero(seen[values & np.uint64(_SEEN - 1)])
            place = np.minimum(np.searchsorted(keys, values[hit]), len(keys) - 1)
            exact = keys[place] == values[hit]
            hit, place = hit[exact], place[exact]
            if not len(hit):
                continue
            many = lists[place + 1] - lists[place]
            size = sizes[np.repeat(lists[place] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            word = np.repeat(at[hit], many)
            whole = np.zeros(len(hashes) + 1, dtype=np.uint64)    # shingle that starts at each word, or 0
            whole[at] = values
            for m in np.unique(size).tolist():
                starts = self._starts(np.unique(word[size == m]), m, k, docs, begin)
                own = docs[starts]
                length = np.minimum(m, begin[own + 1] - starts)
                step = np.arange(m - k + 1)
                inside = step < np.maximum(length - k + 1, 1)[:, None]
                parts = np.where(inside, whole[np.minimum(starts[:, None] + step, len(hashes))], 0)
                for w, item in zip(*(x.tolist() for x in self.near(m, fingerprints(parts)))):
                    found = Counter(parts[w][parts[w] != 0].tolist())
                    low = sum(min(n, self.counts[item].get(s, 0)) for s, n in found.items())
                    sure = low / (found.total() + self.counts[item].total() - low)
                    pair = (int(own[w]), item)
                    if sure >= self.similarity and sure > best.get(pair, (0,))[0]:
                        best[pair] = (sure, int(starts[w] - begin[own[w]]), int(length[w]))
        return [(row, self.ids[item], *found) for (row, item), found in sorted(best.items())]

    @staticmethod
    def _starts(word, m, k, docs, begin):
        """First words of all windows of m words that hold one of the given (sorted) shingle starts."""
        own = docs[word]
        last = np.maximum(begin[own + 1] - m, begin[own])
        lo, hi = np.maximum(word - (m - k), begin[own]), np.minimum(word, last)
        lo = np.minimum(lo, hi)
        lo[1:] = np.maximum(lo[1:], hi[:-1] + 1)    # starts and ends never fall
        many = np.maximum(hi - lo + 1, 0)
        return np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())


def _indexes(benchmark, id_col, text_col, size, **options):
    """One index per block of items."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = max(1, -(-items.count() // size))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        yield Index([r.id for r in own], [r.text for r in own], **options)


def find_matches(documents: DataFrame, benchmark: DataFrame, *, id_col="doc_id", text_col="text", item_col="item_id",
                 item_text_col="text", items=ITEMS, **options) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: the best window of each contaminated pair."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for index in _indexes(benchmark, item_col, item_text_col, items, **options):
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def match(batches, shared=shared):
            for batch in arrow.slices(batches, "text", arrow.FINE):
                found = shared.value.matches(batch.column("text"))
                ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array([f[i] for f in found], MATCHES.types[i]) for i in range(1, 5))], schema=MATCHES)

        part = rows.mapInArrow(match, "doc_id long, item_id long, similarity double, first_word long, n_words long")
        out = part if out is None else out.union(part)
    return out


def clean(documents: DataFrame, benchmark: DataFrame, *, text_col="text", item_col="item_id", item_text_col="text",
          items=ITEMS, **options) -> DataFrame:
    """The rows that match no item, with all their columns."""
    for index in _indexes(benchmark, item_col, item_text_col, items, **options):
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def keep(batches, shared=shared):
            for batch in arrow.slices(batches, text_col, arrow.FINE):
                good = np.ones(batch.num_rows, dtype=bool)
                good[[f[0] for f in shared.value.matches(batch.column(text_col))]] = False
                yield batch.filter(pa.array(good))

        documents = documents.mapInArrow(keep, documents.schema)
    return documents

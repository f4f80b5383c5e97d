"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Two permutations of the numbers below 2**32 make all coordinates of a signature: the first
scatters a document's shingles, the second is read at the shingle's place shifted
circularly by the coordinate's number, and the smallest value is kept. Coordinates are
grouped in bands; documents that agree in a band are candidates. Candidates are confirmed
on their full shingle sets, and confirmed links join documents into components.

With 32 bands of 5 coordinates a pair at similarity 0.8 meets in no band with probability
3e-6, more similar ones much less often; there is no other loss.

Documents with equal shingle sets are collapsed first (by 128 bits over the whole set and
its size), so a group of copies of any size costs one row per copy. A band may still hold
a third of all rows: see ``linking``, which never lists pairs within a band.

Undefined and edge cases: a null or empty text, or one of white space, has no shingles and
links with nothing; its ``component_id`` is its own ``doc_id``. A text with fewer words
than a shingle has one shingle, the whole sequence. Texts may be of any length. Every
input row gives a row. A repeated ``doc_id`` is one document that has the links of each of
its rows. A row without ``doc_id`` gets the component of documents with an equal set, if
any, else null. Other columns are not read. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import linking, text
from tillcast.session import materialize

WORDS = 5
SIMILARITY = (4, 5)     # at least 4/5
BANDS = 32
ROWS = 5
_PART = 1 << 16         # shingles per block of signature work, so that a block stays in cache

FEATURES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                      ("bands", pa.list_(pa.int64()))])
SETS = pa.schema([("id", pa.int64()), ("d1", pa.int64()), ("items", pa.list_(pa.int64()))])


def _permute(x):
    """The second permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(column, k):
    """Distinct shingles of each text: all values, and the run of each text (n + 1 offsets)."""
    data, offsets = text.buffers(column)
    hashes, docs = text.words(data, offsets)
    values, owners, _ = text.shingles(hashes, docs, k)
    begin = text.runs(owners, len(column))
    own = [np.unique(values[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    sizes = np.array([len(x) for x in own], dtype=np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *own]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def signatures(values, begin, size):
    """``size`` circulant coordinates of each set; 2**32 - 1 where a set is empty."""
    n = len(begin) - 1
    out = np.full((n, size), np.uint32(0xFFFFFFFF))
    place = (values >> np.uint64(32)).astype(np.uint32)  # the values are scattered by their hash already
    full = np.flatnonzero(np.diff(begin) > 0)
    at = 0
    while at < len(full):
        # some whole sets, or a part of a large one
        stop = max(at + 1, int(np.searchsorted(begin[full + 1], begin[full[at]] + _PART, side="right")))
        own = full[at:stop]
        for lo in range(int(begin[own[0]]), int(begin[own[-1] + 1]), _PART if len(own) == 1 else 1 << 62):
            hi = min(lo + _PART, int(begin[own[-1] + 1])) if len(own) == 1 else int(begin[own[-1] + 1])
            part = place[lo:hi]
            starts = begin[own] - lo if len(own) > 1 else np.zeros(1, dtype=np.int64)
            for i in range(size):
                least = np.minimum.reduceat(_permute(part + np.uint32(i)), starts)
                out[own, i] = np.minimum(out[own, i], least)
        at = stop
    return out


def _features(k, bands, rows):
    def features(batches):
        salt = text.mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                values, begin = shingle_sets(part.column("text"), k)
                sizes = np.diff(begin)
                signed = signatures(values, begin, bands * rows).astype(np.uint64).reshape(-1, bands, rows)
                key = np.broadcast_to(salt, signed.shape[:2]).copy()
                for i in range(rows):
                    key = text.mix(key * np.uint64(0x9FB21C651E98DF25) + signed[:, :, i])
                total = lambda x: np.concatenate([[np.uint64(0)], np.cumsum(x)])
                one, two = total(values), total(text.mix(values ^ np.uint64(0x5851F42D4C957F2D)))
                digest = [(s[begin[1:]] - s[begin[:-1]]).view(np.int64) for s in (one, two)]
                keys = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands), pa.array(key.view(np.int64).ravel()))
                yield pa.record_batch([part.column("doc_id"), pa.array(sizes), *map(pa.array, digest), keys], schema=FEATURES)

    return features


def _sets(k):
    def sets(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                values, begin = shingle_sets(part.column("text"), k)
                total = np.concatenate([[np.uint64(0)], np.cumsum(values)])
                digest = (total[begin[1:]] - total[begin[:-1]]).view(np.int64)
                items = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.record_batch([part.column("doc_id"), pa.array(digest), items], schema=SETS)

    return sets


def _similar(left, right, above, below):
    """Which sets of ``left`` and ``right`` reach the similarity, from one index of the items of ``right``."""
    sizes = np.array([len(x) for x in right])
    items, owners = np.concatenate(right), np.repeat(np.arange(len(right)), sizes)
    rank = np.argsort(items, kind="stable")
    items, owners = items[rank], owners[rank]
    out = np.zeros((len(left), len(right)), dtype=bool)
    for i, own in enumerate(left):
        lo, hi = np.searchsorted(items, own, side="left"), np.searchsorted(items, own, side="right")
        many = hi - lo
        hit = owners[np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        common = np.bincount(hit, minlength=len(right))
        out[i] = below * common >= above * (len(own) + sizes - common)
    return out


def near_duplicates(documents: DataFrame, *, words: int = WORDS, similarity=SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents whose sets of ``words``-word shingles have a Jaccard similarity of at least
    ``similarity`` (numerator, denominator) link; ``kept`` marks the smallest id of each
    component.
    """
    above, below = similarity
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = materialize(docs.mapInArrow(
        _features(words, bands, rows), "doc_id long, n long, d1 long, d2 long, bands array<long>"), "features")
    # equal sets become one row, under their smallest id
    sets = materialize(found.where("n > 0").groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("id"), F.min("bands").alias("bands")).where("id is not null"), "sets")
    keys = sets.select("id", "n", F.explode("bands").alias("key"))

    def near(x, y):  # no pair beyond this ratio of sizes reaches the similarity
        return (x("n") * below >= y("n") * above) & (y("n") * below >= x("n") * above)

    def load(ids):
        # the one place where texts are shuffled
        chosen = docs.join(ids.select(F.col("id").alias("_id")).hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
        return materialize(chosen.mapInArrow(_sets(words), "id long, d1 long, items array<long>")
                           .dropDuplicates(["id", "d1"]).select("id", F.col("items").alias("load")), "items")

    def verify(pairs, items):
        side = lambda s: items.select(F.col("id").alias(s), F.col("load").alias(f"i{s}")).hint("merge")
        both = pairs.join(side("b"), "b").join(side("a"), "a")
        common = F.size(F.array_intersect("ia", "ib"))
        return both.where(below * common >= above * (F.size("ia") + F.size("ib") - common)).select("a", "b").distinct()

    def kernel(left, right):
        return _similar(left["load"].tolist(), right["load"].tolist(), above, below)

    comps = materialize(linking.link(keys, near, verify, load, kernel), "components")
    labelled = sets.select("d1", "d2", "n", "id").join(
        comps.select(F.col("id").alias("_id"), "comp"), F.col("id") == F.col("_id"), "left")
    labelled = labelled.select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.col("n").alias("_n"), F.coalesce("comp", "id").alias("comp"))
    out = found.select("doc_id", "n", "d1", "d2").join(
        labelled, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")) & (F.col("n") == F.col("_n")), "left")
    comp = F.coalesce("comp", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(comp == F.col("doc_id"), F.lit(False)).alias("kept"))


#: For shingles of two words and a similarity of 0.8.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [[w[1]]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b
    ON a.item = b.item AND a.doc_id <> b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, c.component_id = s.doc_id AS kept
FROM sets s JOIN comp c ON s.doc_id = c.doc_id
"""

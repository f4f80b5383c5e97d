"""Substring dedup by seed and extend: repeated runs of words stay in their first document.

Seeds: every run of ``gram`` words that is the smallest by hash in some window of
``words`` words (winnowing). Equal windows choose equal seeds, so documents that share a
window share a seed at the same place in it. Seeds are joined by hash; a seed that only
one document has goes no further.

Extend: of each seed's documents the one with the smallest id is the pivot, and every
other occurrence is extended against it, to the left and to the right, word by word.
Neighbouring seeds with the same pivot at the same distance are extended together. What
agrees over at least ``words`` words is a maximal repeat and is removed from the later
document. So a seed that a third of all documents share costs one comparison for each of
them, and pairs within its group are never listed.

Where an occurrence and its pivot part inside a window, other documents may still share
that window. Such a window is a seed of its full length: it is joined by its hash with
all others that part from the same pivot. Windows of the pivot need no such test, as no
smaller document holds their seed.

Documents are cut into segments of a bounded number of words, each with the words around
it that extension can need, so the longest document is spread over many tasks.

Undefined and edge cases: windows are judged on the input. A null text has no words and
stays null; kept words are joined by one space, so a text without repeats changes only in
its white space. Documents without id are compared with none. Documents that share an id
count as one: they take nothing from each other. Repeated rows each get the same result.
Words are compared by 64-bit hashes, windows by 128 bits. A text in which one word is
repeated over and over has a seed at every word. Other columns are not read. An empty
table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import arrow, text
from tillcast.session import materialize

WORDS, GRAM, SEGMENT = 50, 25, 512
SLICE = 2 << 20         # bytes of text worked on at once

_KEY = ["id", "mark"]


def _sums(hashes, size, salt=0):
    """Hash of each run of ``size`` words in a row, whatever texts it spans."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = text._powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((text.mix(hashes + np.uint64(salt)) if salt else hashes) * up[:n], out=sums[1:])
    return text.mix((sums[size:] - sums[:-size]) * down[:n - size + 1])


def _smallest(values, width):
    """Place of the last smallest value of each window of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    low, at, size = values, np.arange(len(values)), 1

    def merge(step):
        left, right = low[:len(low) - step], low[step:]
        later = right <= left
        return np.where(later, right, left), np.where(later, at[step:], at[:len(at) - step])

    while size * 2 <= width:
        (low, at), size = merge(size), size * 2
    if size < width:
        low, at = merge(width - size)
    return at[:n]


def _chosen(hashes, docs, words, gram):
    """The seed of each window, and the windows' first words; windows lie inside one text."""
    grams = _sums(hashes, gram)
    at = _smallest(grams, words - gram + 1)
    first = np.flatnonzero(docs[:len(at)] == docs[words - 1:words - 1 + len(at)])
    return grams, at[first], first


def _seeds(words, gram):
    def seeds(batches):
        for batch in arrow.slices(batches, "text", SLICE):
            data, offsets = text.buffers(batch.column("text"))
            hashes, docs = text.words(data, offsets, letters=text.EXACT)
            grams, at, _ = _chosen(hashes, docs, words, gram)
            at = np.unique(at)
            own = docs[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(own)), batch.column("mark").take(pa.array(own)),
                 pa.array((at - text.runs(docs, batch.num_rows)[own]).astype(np.int32)), pa.array(grams[at].view(np.int64))],
                ["id", "mark", "at", "gram"])

    return seeds


def _cut(words, gram, segment):
    """The wanted segments of each text, with the words around them."""
    margin = words - gram

    def cut(batches):
        for batch in arrow.slices(batches, "text", SLICE):
            data, offsets = text.buffers(batch.column("text"))
            _, docs, starts, ends = text.words(data, offsets, spans=True)
            begin, raw = text.runs(docs, batch.num_rows), data.tobytes()
            rows, segs, first, parts = [], [], [], []
            for row, wanted in enumerate(batch.column("segs").to_pylist()):
                base, n = begin[row], begin[row + 1] - begin[row]
                for seg in wanted:
                    lo, hi = max(0, seg * segment - margin), min(n, (seg + 1) * segment + words)
                    rows.append(row)
                    segs.append(seg)
                    first.append(lo)
                    parts.append(raw[starts[base + lo]:ends[base + hi - 1]])
            rows = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(rows), batch.column("mark").take(rows), pa.array(segs, pa.int32()),
                 pa.array(first, pa.int32()), pa.array(parts, pa.binary()).cast(pa.string())],
                ["id", "mark", "seg", "first", "text"])

    return cut


def _fetch(words, gram):
    """The pivot's words around the seeds of a chain, with the place of the first one in the later document."""
    margin = words - gram

    def fetch(batches):
        for batch in arrow.slices(batches, "text", SLICE):
            data, offsets = text.buffers(batch.column("text"))
            _, docs, starts, ends = text.words(data, offsets, spans=True)
            begin, raw = text.runs(docs, batch.num_rows), data.tobytes()
            low, high, apart, first = (batch.column(c).to_numpy() for c in ("low", "high", "apart", "first"))
            lo = np.maximum(low - apart - margin - first, 0)
            hi = np.minimum(high - apart + words - first, np.diff(begin))
            parts = [raw[a:b] for a, b in zip(starts[begin[:-1] + lo].tolist(), ends[begin[:-1] + hi - 1].tolist())]
            kept = [batch.column(c) for c in ("id", "mark", "seg", "ats")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array((first + lo + apart).astype(np.int32)), pa.array(parts, pa.binary()).cast(pa.string())],
                ["id", "mark", "seg", "ats", "place", "pivot"])

    return fetch


def _ranges(begin, size):
    """begin, begin + 1, ... for each pair, one after another, and the pair of each."""
    pair = np.repeat(np.arange(len(size)), size)
    stops = np.cumsum(size)
    return np.arange(stops[-1] if len(stops) else 0) - (stops - size)[pair] + begin[pair], pair


def _extend(words, gram, kind):
    """Maximal repeats of each segment with its pivots, and the windows where they part."""
    names = ["id", "mark", "again", "start", "stop", "a", "b"]

    def rows(batch, at, again, start, stop, a, b):
        at = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [batch.column("id").take(at), batch.column("mark").take(at), pa.array(np.full(len(at), again)),
             pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names)

    def extend(batches):
        for batch in arrow.slices(batches, "text", SLICE // 4):
            data, offsets = text.buffers(batch.column("text"))
            hashes, docs = text.words(data, offsets, letters=text.EXACT)
            begin = text.runs(docs, batch.num_rows)
            first = batch.column("first").to_numpy().astype(np.int64)
            chains = batch.column("chains")
            owner = np.repeat(np.arange(batch.num_rows), chains.value_lengths().to_numpy())
            chains = chains.flatten()
            place, pivot, ats = (chains.field(c) for c in ("place", "pivot", "ats"))

            # seeds of the segment that have an earlier document
            seeded = np.zeros(len(hashes) + 1, dtype=bool)
            seed_of = np.repeat(owner, ats.value_lengths().to_numpy())
            seeded[begin[seed_of] + ats.flatten().to_numpy() - first[seed_of]] = True

            # word by word against the pivots
            held = np.flatnonzero(pivot.is_valid().to_numpy(zero_copy_only=False))
            owner, place = owner[held], place.take(pa.array(held)).to_numpy().astype(np.int64)
            raw, cuts = text.buffers(pivot.take(pa.array(held)))
            other, other_of = text.words(raw, cuts, letters=text.EXACT)
            theirs = text.runs(other_of, len(held))
            lo = np.maximum(place, first[owner])
            hi = np.minimum(place + np.diff(theirs), first[owner] + np.diff(begin)[owner])
            size = np.maximum(hi - lo, 0)
            mine, chain = _ranges(begin[owner] + lo - first[owner], size)
            yours, _ = _ranges(theirs[:-1] + lo - place, size)
            edge = np.zeros(len(mine) + 1, dtype=bool)
            edge[np.cumsum(size)] = edge[0] = True
            same = hashes[mine] == other[yours]
            edge[1:-1] |= same[1:] != same[:-1]
            edge = np.flatnonzero(edge)
            run, length = edge[:-1], np.diff(edge)
            long = same[run] & (length >= words) if len(run) else np.zeros(0, dtype=bool)
            run, length = run[long], length[long]
            at, who = mine[run], owner[chain[run]]
            start = at - begin[who] + first[who]
            none = np.zeros(len(at), dtype=np.uint64)
            yield rows(batch, who, False, start, start + length, none, none)

            # windows whose seed has an earlier document but that no pivot covers
            change = np.zeros(len(hashes) + 2, dtype=np.int32)
            np.add.at(change, at, 1)
            np.add.at(change, at + length - words + 1, -1)
            covered = np.cumsum(change) > 0
            _, seed, window = _chosen(hashes, docs, words, gram)
            window = window[seeded[seed] & ~covered[window]]
            who = docs[window]
            start = window - begin[who] + first[who]
            yield rows(batch, who, True, start, start + words, _sums(hashes, words)[window], _sums(hashes, words, 0x51ED)[window])

    return extend, f"id {kind}, mark long, again boolean, start int, stop int, a long, b long"


def repeats(documents: DataFrame, *, words=WORDS, gram=GRAM, segment=SEGMENT, id_col="doc_id", text_col="text") -> DataFrame:
    """Spans of words (``start`` to before ``stop``) to remove: id, mark (hash of the text), start, stop.

    Spans of a document may overlap.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("mark"),
                            F.col(text_col).alias("text")).where("id is not null and text is not null")
    kind = dict(docs.dtypes)["id"]
    seeds = materialize(docs.mapInArrow(_seeds(words, gram), f"id {kind}, mark long, at int, gram long"), "seeds")
    shared = seeds.groupBy("gram").agg(F.min(F.struct("id", "mark", "at")).alias("pivot"), F.max("id").alias("last")).where(
        "pivot.id < last").select(F.col("gram").alias("_gram"), "pivot")
    hits = seeds.join(shared, F.col("gram") == F.col("_gram")).select(
        "id", "mark", "at", F.floor(F.col("at") / segment).cast("int").alias("seg"),
        F.col("pivot.id").alias("p_id"), F.col("pivot.mark").alias("p_mark"), F.col("pivot.at").alias("p_at"),
        F.floor(F.col("pivot.at") / segment).cast("int").alias("p_seg"))
    hits = materialize(hits, "hits")

    wanted = hits.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set("seg").alias("segs"))
    texts = docs.join(wanted, (F.col("id") == F.col("_id")) & (F.col("mark") == F.col("_mark"))).select("id", "mark", "text", "segs")
    cut = texts.mapInArrow(_cut(words, gram, segment), f"id {kind}, mark long, seg int, first int, text string")
    cut = materialize(cut.dropDuplicates([*_KEY, "seg"]), "segments")

    # a seed in the pivot's own document has nothing to be compared with; the pivot itself needs nothing
    later = hits.where("not (p_id = id and p_mark = mark and p_at = at)")
    apart = (F.col("at") - F.col("p_at")).alias("apart")
    chains = later.where("p_id <> id").groupBy(*_KEY, "seg", "p_id", "p_mark", "p_seg", apart).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.collect_set("at").alias("ats"))
    pivots = cut.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), F.col("seg").alias("_seg"), "first", "text")
    found = chains.join(pivots, (F.col("p_id") == F.col("_id")) & (F.col("p_mark") == F.col("_mark")) & (F.col("p_seg") == F.col("_seg")))
    found = found.select(*_KEY, "seg", "ats", "low", "high", "apart", "first", "text").mapInArrow(
        _fetch(words, gram), f"id {kind}, mark long, seg int, ats array<int>, place int, pivot string")
    own = later.where("p_id = id").groupBy(*_KEY, "seg").agg(F.collect_set("at").alias("ats")).select(
        *_KEY, "seg", "ats", F.lit(0).alias("place"), F.lit(None).cast("string").alias("pivot"))
    work = found.unionByName(own).groupBy(*_KEY, "seg").agg(F.collect_list(F.struct("place", "pivot", "ats")).alias("chains"))
    extend, schema = _extend(words, gram, kind)
    found = materialize(work.join(cut, [*_KEY, "seg"]).select(*_KEY, "first", "text", "chains").mapInArrow(extend, schema), "repeats")

    rest = found.where("again")
    many = rest.groupBy(F.col("a").alias("_a"), F.col("b").alias("_b")).agg(
        F.min("id").alias("_from"), F.max("id").alias("_to")).where("_from < _to")
    rest = rest.join(many, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).where("id > _from")
    columns = [*_KEY, "start", "stop"]
    return found.where("not again").select(columns).unionByName(rest.select(columns))


def _without(kind):
    """Texts of the words outside the spans, and how many words there were and went."""
    def without(batches):
        for batch in arrow.slices(batches, "text", SLICE):
            data, offsets = text.buffers(batch.column("text"))
            _, docs, starts, ends = text.words(data, offsets, spans=True)
            begin = text.runs(docs, batch.num_rows)
            spans = batch.column("spans")
            row = np.repeat(np.arange(batch.num_rows), spans.value_lengths().fill_null(0).to_numpy())
            spans = spans.flatten()
            change = np.zeros(len(docs) + 1, dtype=np.int32)
            np.add.at(change, begin[row] + spans.field("start").to_numpy(), 1)
            np.add.at(change, begin[row] + spans.field("stop").to_numpy(), -1)
            kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
            runs = text.runs(docs[kept], batch.num_rows)
            out, cuts = _joined(data, starts[kept], ends[kept], runs)
            lost = batch.column("text").is_null().to_numpy(zero_copy_only=False)
            left = pa.Array.from_buffers(pa.large_string(), batch.num_rows, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(out.tobytes())])
            left = pa.array(np.where(lost, None, left.to_numpy(zero_copy_only=False)), pa.string()) if lost.any() else left.cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(begin)), pa.array(np.diff(begin) - np.diff(runs)), left],
                ["id", "n_words", "n_removed", "text"])

    return without, f"id {kind}, n_words long, n_removed long, text string"


def _joined(data, starts, ends, runs):
    """The words of each run joined by one space: bytes and offsets."""
    size = ends - starts
    opens = np.zeros(len(starts) + 1, dtype=bool)
    opens[runs[:-1]] = True                        # an empty run marks the next one's first word, which opens it as well
    gap = (~opens[:-1]).astype(np.int64)
    stops = np.cumsum(size + gap)
    out = np.full(int(stops[-1]) if len(stops) else 0, 32, dtype=np.uint8)
    step = 1 << 17                                 # words copied at once
    for i in range(0, len(starts), step):
        source, word = _ranges(starts[i:i + step], size[i:i + step])
        out[source + (stops - size - starts)[i:i + step][word]] = data[source]
    return out, np.concatenate([[0], stops])[runs].astype(np.int64)


def remove_repeats(documents: DataFrame, *, words=WORDS, gram=GRAM, segment=SEGMENT, id_col="doc_id", text_col="text") -> DataFrame:
    """Per document: id (as ``id_col``), n_words, n_removed, text (the kept words joined by one space)."""
    spans = repeats(documents, words=words, gram=gram, segment=segment, id_col=id_col, text_col=text_col)
    spans = materialize(spans.distinct().groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    joined = docs.join(spans, (F.col("id") == F.col("_id")) & (F.xxhash64("text") == F.col("_mark")), "left")
    without, schema = _without(dict(docs.dtypes)["id"])
    return joined.select("id", "text", "spans").mapInArrow(without, schema).withColumnRenamed("id", id_col)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs),
win AS MATERIALIZED (
  SELECT r, doc_id, p, md5(array_to_string(w[p + 1 : p + 50], ' ')) AS h
  FROM (SELECT r, doc_id, w, unnest(range(len(w) - 49)) AS p FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS doc_id FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT win.r, win.p FROM win JOIN firsts f ON win.h = f.h AND win.doc_id > f.doc_id),
marked AS (
  SELECT x.r, x.p, x.word,
         count(g.p) OVER (PARTITION BY x.r ORDER BY x.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS lost
  FROM words x LEFT JOIN gone g ON x.r = g.r AND x.p = g.p),
kept AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (WHERE lost) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT lost) AS text
  FROM marked GROUP BY r)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.r = k.r
"""

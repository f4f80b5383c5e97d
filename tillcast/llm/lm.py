"""Language-model scores from a weighted backoff automaton.

Counts cover every training token, and every n-gram of the training texts is an arc of the
automaton, however rare it is and however many there are. Arcs carry absolutely discounted
probabilities; where a state has no arc for a word, its failure arc goes to the state
without the oldest word and carries the weight that makes the probabilities of each state
sum to one. At the root every word has the smoothed frequency
(c + 0.5) / (N + 0.5 (V + 1)).

The automaton grows with the corpus, so it is held in written tables: per order the arcs
(key of the n-gram, probability) and the backoff weights (key of the context, weight). The
n-grams of the texts to score are looked up by joins: each distinct one once, those
without an arc along their failure arcs, and the rows of each text last. All other joins
are between a table and unique keys, so frequent contexts are split by adaptive execution.

With ``gram_share`` the automaton is bounded instead: an n-gram is a state only if it
makes up that share of all training tokens. Each order is then counted only where the
order below was kept, without loss, and the automaton is broadcast. Texts are scored in
one traversal from left to right that carries the state and adds up log-probabilities, for
many stretches of text at a time: a stretch first reads the last words before it, which
fix the state it starts in.

Words of at least ``WORD_SHARE`` of all tokens (at most 1 / WORD_SHARE of them) are
broadcast. All rarer words are looked up by a join with the table of all counts, where no
key can be frequent.

Undefined and edge cases: a null text is empty, which is its end alone. Without training
rows N and V are 0 and every token has probability one. Rows are scored one by one,
whatever their id; a null id counts as training, not as held out. Other columns are not
read. An empty table gives an empty result. Words and n-grams are told apart by 64-bit
hashes.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import arrow, text
from tillcast.session import materialize

ORDER = 3
WORD_SHARE = 1e-6
DISCOUNT = 0.5
STRETCH = 256           # tokens that one lane of the traversal scores
END = np.uint64(0xE0D0E0D0E0D0E0D1)
_CHAIN = np.uint64(0xD6E8FEB86659FD93)
_ABSENT = np.uint64(0xA0761D6478BD642F)


@dataclass
class Automaton:
    """States 0 (root), then n-grams by order. Arcs are sorted by state * words + word."""

    words: np.ndarray               # hashes, sorted
    root: np.ndarray                # log10 probability of each word at the root
    denominator: float
    order: int = 1
    is_state: np.ndarray = None     # which words open n-grams
    levels: list = field(default_factory=list)      # per order from 2: sorted keys
    arcs: np.ndarray = None
    weight: np.ndarray = None
    target: np.ndarray = None
    fail: np.ndarray = None
    backoff: np.ndarray = None

    def index(self, hashes):
        """Position of each hash among the words, or -1."""
        if not len(self.words):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)


def _find(keys, wanted, valid):
    """Position of each wanted value in sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(valid & (keys[at] == wanted), at, -1)


def sequences(column):
    """Token hashes of all texts with an end after each, and the first token of each text (n + 1)."""
    data, offsets = text.buffers(column)
    hashes, docs = text.words(data, offsets)
    n = len(column)
    begin = text.runs(docs, n) + np.arange(n + 1)
    out = np.full(len(hashes) + n, END, dtype=np.uint64)
    out[np.arange(len(hashes)) + docs] = hashes
    return out, begin


class Trained(tuple):
    """(automaton, table of word counts, N); ``arcs`` and ``states`` hold the tables of orders from 2."""

    arcs = states = None


def _keys(tokens, begin, order):
    """Per order the keys of the n-gram that ends at each token and of the one before it, and the token's place.

    Where a text has too few words before a token, the key is made up and equals that of no n-gram.
    """
    place = np.arange(len(tokens)) - np.repeat(begin[:-1], np.diff(begin))
    grams, before = [tokens], []
    for n in range(2, order + 1):
        last = np.zeros_like(tokens)
        last[1:] = grams[-1][:-1]
        missing = text.mix(grams[-1] ^ _ABSENT)
        grams.append(np.where(place >= n - 1, text.mix(last * _CHAIN + tokens + np.uint64(n)), missing))
        before.append(np.where(place >= 1, last, missing))
    return grams, before, place


def _long(keys):
    return pa.array(keys.view(np.int64))


def _arc_counts(n):
    def counts(batches):
        for batch in arrow.slices(batches, "text"):
            grams, before, place = _keys(*sequences(batch.column("text")), n)
            at = np.flatnonzero(place >= n - 1)
            found, first, many = np.unique(grams[-1][at], return_index=True, return_counts=True)
            at = at[first]
            yield pa.record_batch({"gram": _long(found), "context": _long(before[-1][at]), "suffix": _long(grams[-2][at]),
                                   "n": pa.array(many.astype(np.int64))})

    return counts


def _asked(order):
    """Each distinct n-gram of a slice once, with the keys of its shorter suffixes (s) and contexts (c)."""
    def asked(batches):
        for batch in arrow.slices(batches, "text"):
            grams, before, _ = _keys(*sequences(batch.column("text")), order)
            found, at = np.unique(grams[-1], return_index=True)
            yield pa.record_batch({"gram": _long(found)} | {f"s{n}": _long(grams[n - 1][at]) for n in range(1, order)}
                                  | {f"c{n}": _long(before[n - 1][at]) for n in range(1, order)})

    return asked


def _levels(model, ids, begin, upto):
    """Index of the n-gram that ends at each token, for orders 1 to ``upto``, or -1."""
    state = np.where((ids >= 0) & model.is_state[ids], ids, -1) if len(model.words) else ids
    out, first = [state], begin[:-1]
    place = np.arange(len(ids)) - np.repeat(first, np.diff(begin))
    for n in range(2, upto + 1):
        before = np.full(len(ids), -1, dtype=np.int64)
        before[1:] = out[-1][:-1]
        valid = (before >= 0) & (state >= 0) & (place >= n - 1)
        out.append(_find(model.levels[n - 2], before * len(model.words) + state, valid))
    return out


def _word_counts(batches):
    for batch in arrow.slices(batches, "text"):
        tokens, _ = sequences(batch.column("text"))
        found, n = np.unique(tokens, return_counts=True)
        yield pa.record_batch({"word": pa.array(found.view(np.int64)), "n": pa.array(n.astype(np.int64))})


def _gram_counts(shared, n):
    def counts(batches):
        model = shared.value
        for batch in arrow.slices(batches, "text"):
            tokens, begin = sequences(batch.column("text"))
            below = _levels(model, model.index(tokens), begin, n - 1)
            place = np.arange(len(tokens)) - np.repeat(begin[:-1], np.diff(begin))
            ok = np.zeros(len(tokens), dtype=bool)
            ok[1:] = (below[-1][:-1] >= 0) & (below[-1][1:] >= 0) & (place[1:] >= n - 1)
            at = np.flatnonzero(ok)
            found, many = np.unique(below[-1][at - 1] * len(model.words) + below[0][at], return_counts=True)
            yield pa.record_batch({"gram": pa.array(found), "n": pa.array(many.astype(np.int64))})

    return counts


def build(model, counts, gram_counts, discount=DISCOUNT):
    """Fill in arcs, failure arcs and weights. ``counts``: of the words; per order of its n-grams."""
    size = max(len(model.words), 1)
    base = np.cumsum([1, len(model.words), *(len(k) for k in model.levels)])
    suffix, seen = [np.arange(len(model.words))], [counts, *gram_counts]
    fail = [np.zeros(1, np.int64), np.zeros(len(model.words), np.int64)]
    backoff = [np.zeros(1), np.zeros(len(model.words))]
    arcs, weight, target, below = [], [], [], None
    lower = 10.0 ** model.root
    for n, keys in enumerate(model.levels, start=2):
        head, word = keys // size, keys % size
        if n == 2:
            own = word                                      # the suffix of a bigram is its last word
            under = lower[word]
        else:
            own = _find(model.levels[n - 3], suffix[-1][head] * size + word, np.ones(len(keys), bool))
            under = below[own]
        p = (seen[n - 1] - discount) / seen[n - 2][head]
        kept = np.bincount(head, p, minlength=len(seen[n - 2]))
        rest = np.bincount(head, under, minlength=len(seen[n - 2]))
        backoff[n - 1] = np.log10(np.maximum(1 - kept, 1e-12) / np.maximum(1 - rest, 1e-12))
        arcs.append((base[n - 2] + head) * size + word)
        weight.append(np.log10(p))
        target.append(base[n - 1] + np.arange(len(keys)) if n < model.order else base[n - 2] + own)
        fail.append(base[n - 2] + own)
        backoff.append(np.zeros(len(keys)))
        suffix.append(own)
        below = p
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    model.arcs, model.weight, model.target = join(arcs), join(weight), join(target).astype(np.int64)
    model.fail, model.backoff = np.concatenate(fail).astype(np.int64), np.concatenate(backoff)
    return model


def train(documents: DataFrame, *, text_col="text", order=ORDER, word_share=WORD_SHARE, gram_share=None):
    """The automaton, the table of all counts (word, n), and N, from all rows.

    The arcs are written tables; with ``gram_share`` they are part of the automaton, see the module.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(text_col).cast("string").alias("text"))
    table = materialize(
        texts.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    size = table.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    tokens, distinct = size.tokens or 0, size.distinct
    least = max(word_share * tokens, 1)
    frequent = table.where(F.col("n") >= least).toPandas()
    hashes = frequent["word"].to_numpy(dtype=np.int64).view(np.uint64)
    rank = np.argsort(hashes)
    counts = frequent["n"].to_numpy(dtype=np.int64)[rank]
    below = tokens + 0.5 * (distinct + 1)
    model = Automaton(hashes[rank], np.log10((counts + 0.5) / below), below, order)
    if gram_share is None and order > 1:
        trained = Trained((model, table, tokens))
        trained.arcs, trained.states = _arcs(texts, table, below, order)
        return trained
    least = max((gram_share or 0) * tokens, 1)
    model.is_state = counts >= least
    grams = []
    for n in range(2, order + 1):
        shared = spark.sparkContext.broadcast(model)
        kept = texts.mapInArrow(_gram_counts(shared, n), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")) \
            .where(F.col("n") >= least).toPandas().sort_values("gram")
        shared.unpersist()
        model.levels.append(kept["gram"].to_numpy(dtype=np.int64))
        grams.append(kept["n"].to_numpy(dtype=np.int64))
    return Trained((build(model, counts, grams), table, tokens))


def _arcs(texts, table, below, order, discount=DISCOUNT):
    """Per order from 2: arcs (gram, p) and backoff weights of their contexts (context, backoff), as written tables."""
    arcs, states = {}, {}
    lower = table.select(F.col("word").alias("_gram"), ((F.col("n") + 0.5) / F.lit(below)).alias("_p"))
    for n in range(2, order + 1):
        seen = materialize(
            texts.mapInArrow(_arc_counts(n), "gram long, context long, suffix long, n long").groupBy("gram").agg(
                F.first("context").alias("context"), F.first("suffix").alias("suffix"), F.sum("n").alias("n")), "grams")
        # each token but a text's last has one after it, so a context occurs as often as all its arcs
        rest = seen.select("context", "suffix", "n").join(lower, F.col("suffix") == F.col("_gram"))
        own = rest.groupBy("context").agg(F.sum("n").alias("times"), F.count("*").alias("many"), F.sum("_p").alias("rest"))
        left = F.lit(discount) * F.col("many") / F.col("times")
        state = materialize(own.select("context", "times", F.log10(
            F.greatest(left, F.lit(1e-12)) / F.greatest(1 - F.col("rest"), F.lit(1e-12))).alias("backoff")), "states")
        times = state.select(F.col("context").alias("_context"), "times")
        arcs[n] = materialize(seen.select("gram", "context", "n").join(times, F.col("context") == F.col("_context")).select(
            "gram", ((F.col("n") - discount) / F.col("times")).alias("p")), "arcs")
        states[n] = state.select("context", "backoff")
        lower = arcs[n].select(F.col("gram").alias("_gram"), F.col("p").alias("_p"))
    return arcs, states


def _looked_up(texts, trained):
    """(gram, log): the log10 probability of the last word of each distinct n-gram of the texts."""
    model, table, _ = trained
    order = model.order
    shorter = [f"{k}{n}" for k in "sc" for n in range(1, order)]
    asked = texts.mapInArrow(_asked(order), ", ".join(f"{c} long" for c in ["gram", *shorter])).groupBy("gram").agg(
        *[F.first(c).alias(c) for c in shorter])

    def joined(rows, key, found, name, value):
        found = found.select(F.col(name).alias("_key"), F.col(value).alias(f"_{value}"))
        return rows.join(found, F.col(key) == F.col("_key"), "left").drop("_key")

    miss = F.col("_p").isNull()
    full = materialize(joined(asked, "gram", trained.arcs[order], "gram", "p").select(
        "gram", "_p", *[F.when(miss, F.col(c)).alias(c) for c in shorter]), "asked")
    # failure arcs: what has no arc pays the backoff weight of its context and drops the oldest word
    rows = full.where(miss).drop("_p").withColumn("log", F.lit(0.0)).withColumn("open", F.lit(True))
    for n in range(order, 1, -1):
        rows = joined(rows, f"c{n - 1}", trained.states[n], "context", "backoff").withColumn(
            "log", F.col("log") + F.when(F.col("open"), F.coalesce("_backoff", F.lit(0.0))).otherwise(0.0))
        if n > 2:
            hit = F.col("open") & F.col("_p").isNotNull()
            rows = joined(rows, f"s{n - 1}", trained.arcs[n - 1], "gram", "p").withColumn(
                "log", F.col("log") + F.when(hit, F.log10("_p")).otherwise(0.0)).withColumn(
                "open", F.col("open") & F.col("_p").isNull()).drop("_p")
        rows = rows.drop("_backoff")
    root = F.log10((F.coalesce("_n", F.lit(0)) + 0.5) / F.lit(model.denominator))
    rows = joined(rows, "s1", table, "word", "n").select(
        "gram", (F.col("log") + F.when(F.col("open"), root).otherwise(0.0)).alias("log"))
    return full.where(~miss).select("gram", F.log10("_p").alias("log")).unionAll(rows)


def traverse(model, ids, begin, stretch=STRETCH):
    """Log10 probability of each text of word indices; -1 is a rare word, which adds nothing here."""
    size = max(len(model.words), 1)
    length = np.diff(begin)
    lanes = -(-length // stretch)
    text_of = np.repeat(np.arange(len(length)), lanes)
    nth = np.arange(len(text_of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    start = begin[:-1][text_of] + nth * stretch
    stop = np.minimum(start + stretch, begin[1:][text_of])
    warm = np.where(nth > 0, np.minimum(model.order - 1, stretch), 0)
    at = start - warm
    rank = np.argsort(-(stop - at), kind="stable")
    at, start, stop, text_of = at[rank], start[rank], stop[rank], text_of[rank]
    state, total = np.zeros(len(at), dtype=np.int64), np.zeros(len(at))
    need = stop - at
    for step in range(int(need[0]) if len(need) else 0):
        live = int(np.searchsorted(-need, -step, side="left"))  # lanes with more than `step` tokens
        place = at[:live] + step
        word = ids[place]
        gain, now = np.zeros(live), state[:live]
        open_ = np.flatnonzero((word >= 0) & (now > 0))
        lost = np.flatnonzero((word < 0) & (now > 0))
        while len(lost):    # a rare word: failure arcs down to the root
            gain[lost] += model.backoff[now[lost]]
            now[lost] = model.fail[now[lost]]
            lost = lost[now[lost] > 0]
        to = np.where((word >= 0) & (now == 0), 1 + word, 0)
        gain += np.where((word >= 0) & (now == 0), model.root[np.maximum(word, 0)] if len(model.root) else 0.0, 0.0)
        while len(open_):
            hit = _find(model.arcs, now[open_] * size + word[open_], True)
            here = open_[hit >= 0]
            gain[here] += model.weight[hit[hit >= 0]]
            to[here] = model.target[hit[hit >= 0]]
            open_ = open_[hit < 0]
            gain[open_] += model.backoff[now[open_]]
            now[open_] = model.fail[now[open_]]
            done = open_[now[open_] == 0]
            gain[done] += model.root[word[done]]
            to[done] = 1 + word[done]
            open_ = open_[now[open_] > 0]
        state[:live] = to
        total[:live] += np.where(place >= start[:live], gain, 0.0)
    return np.bincount(text_of, total, minlength=len(length))


SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("known", pa.int64()), ("base", pa.float64()), ("walk", pa.float64()),
                    ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])


def _score(shared, joins):
    def score(batches):
        model = shared.value
        for batch in arrow.slices(batches, "text"):
            tokens, begin = sequences(batch.column("text"))
            n = batch.num_rows
            ids = model.index(tokens)
            owner = np.repeat(np.arange(n), np.diff(begin))
            base = np.where(ids >= 0, model.root[np.maximum(ids, 0)] if len(model.root) else 0.0, 0.0)
            tail = np.flatnonzero(ids < 0)
            rank = tail[np.lexsort((tokens[tail], owner[tail]))]
            word, own = tokens[rank], owner[rank]
            new = np.ones(len(rank), dtype=bool)
            new[1:] = (word[1:] != word[:-1]) | (own[1:] != own[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.concatenate([first, [len(rank)]]))
            runs = pa.array(np.searchsorted(own[first], np.arange(n + 1)).astype(np.int32))
            walk = np.zeros(n) if joins else traverse(model, ids, begin)
            grams = _keys(tokens, begin, model.order)[0][-1] if joins else tokens[:0]
            ends = pa.array((begin if joins else np.zeros(n + 1)).astype(np.int32))
            yield pa.record_batch([
                batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(begin)),
                pa.array(np.bincount(owner[ids >= 0], minlength=n).astype(np.int64)),
                pa.array(np.bincount(owner, base, minlength=n)), pa.array(walk),
                pa.ListArray.from_arrays(runs, pa.array(word[first].view(np.int64))),
                pa.ListArray.from_arrays(runs, pa.array(times.astype(np.int64))),
                pa.ListArray.from_arrays(ends, _long(grams)),
            ], schema=SCORED)

    return score


def score(documents: DataFrame, trained, *, held_out=None, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    model, table, train_tokens = trained
    joins = getattr(trained, "arcs", None) is not None
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        (F.lit(False) if held_out is None else held_out).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    walked = materialize(rows.mapInArrow(
        _score(shared, joins), "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, walk double, "
        "rare array<long>, times array<long>, grams array<long>"), "walked")
    tail = walked.select(F.col("row").alias("_row"), F.explode(F.arrays_zip("rare", "times")).alias("w")) \
        .select("_row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    tail = tail.join(table.select(F.col("word").alias("_word"), "n"), F.col("word") == F.col("_word"), "left")
    tail = tail.groupBy("_row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("_known"),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(model.denominator))).alias("_log"))
    zero = F.lit(0.0)
    found = walked.join(tail, F.col("row") == F.col("_row"), "left").drop("_row")
    walk = F.col("walk") + F.coalesce("_log", zero)
    if joins:
        grams = walked.select(F.col("row").alias("_row"), F.explode("grams").alias("_gram"))
        logs = _looked_up(rows.select("text"), trained)
        sums = grams.join(logs, F.col("_gram") == F.col("gram")).groupBy("_row").agg(F.sum("log").alias("_walk"))
        found, walk = found.join(sums, F.col("row") == F.col("_row")), F.col("_walk")
    return found.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("_log", zero)).alias("base_score"),
        walk.alias("score"))

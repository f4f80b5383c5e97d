"""A backoff automaton of the whole corpus, built block by block where the texts are scored.

Training and scoring in one go. The texts become blocks of word numbers, written once. A block
asks for what its own texts need, the whole corpus answers, and the block then holds a small
automaton: every state and arc that its texts can meet, with the weights of the whole corpus.
One traversal from left to right (``lm.traverse``) scores the block's texts.

There are two rounds of questions. First each distinct word of a block gets its count among the
training tokens and a number. Then each distinct n-gram goes, with its training count within the
block, to the part of its middle word: there all trigrams around the word, the bigrams that
open with it and the bigrams that end with it meet, which is what the discounted probabilities
and the backoff weights need. What is sent are sorted numbers in compressed byte planes, and an
answer holds values only, in the order in which the block asked.

The n-grams of a middle word with more than ``HOT`` training tokens are dealt over up to
``SALTS`` parts by their last word. Counts of n-grams stay whole there; the sums over the arcs of
a context that may lack one are asked of every part and added by the block. Nothing is dropped,
and no table of n-grams is written. Counts of the ``FREQUENT`` commonest words, at most, are
broadcast; the others travel with the questions.

The model, and its undefined and edge cases, are those of ``lm``, with order 3. A text longer than
a block continues in the next one, which first reads the two words before; its parts are added
up at the end. Rows with a null ``learn`` are not learned from.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import arrow, lm, text
from tillcast.session import materialize

BLOCK = 1 << 20         # tokens of a block, at most
SLICE = 6 << 20         # bytes of text read at once
PART = 3 << 18          # n-grams that one part answers, about
HOT = 1 << 19           # training tokens from which a middle word is dealt over several parts
SALTS = 64
FREQUENT = 1 << 20      # words whose counts are broadcast, at most
_NONE, _ASK = 0, 1      # in place of a word: no word before; a question for a context's sums
_SHIFT = 2

_BLOCKS = ("block long, tokens long, learned long, distinct long, words binary, ids binary, pieces binary, "
           "rows array<long>, doc_ids array<long>, held array<boolean>")
_ANSWER = "block long, kind int, part int, fresh long, top binary, data binary"


def pack(*columns):
    """Arrays of 64-bit values as one compressed string; whole numbers from 0 take as many bytes as they need."""
    heads, planes = [len(columns)], []
    for column in columns:
        raw = np.ascontiguousarray(column)
        kind = int(raw.dtype.kind == "f")
        raw = raw.view(np.uint64) if kind else raw.astype(np.uint64)
        width = (int(raw.max()).bit_length() + 7) // 8 if len(raw) else 0
        heads += [len(raw), width, kind]
        planes.append(raw.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.compress(np.array(heads, dtype=np.int64).tobytes() + b"".join(planes))


def unpack(data):
    """The arrays of ``pack``: uint64 or float64."""
    raw = zstandard.decompress(data)
    many = int(np.frombuffer(raw, np.int64, 1)[0])
    heads = np.frombuffer(raw, np.int64, 1 + 3 * many)[1:].reshape(-1, 3)
    at, out = 8 * (1 + 3 * many), []
    for n, width, kind in heads.tolist():
        column = np.zeros((n, 8), dtype=np.uint8)
        column[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        at += n * width
        column = column.reshape(-1).view(np.uint64)
        out.append(column.view(np.float64) if kind else column)
    return out


def _distinct(values, ordered=False):
    """Sorted distinct values; ``ordered``: they come sorted."""
    values = values if ordered else np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def _steps(sorted_values):
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def _blocks(size):
    """Texts as blocks of at most ``size`` tokens. A piece is (row of the block, start, words before that are only read)."""
    def blocks(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        for whole in batches:
            for batch in arrow.slices([whole], "text", SLICE):
                tokens, begin = lm.sequences(batch.column("text"))
                learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
                for start in range(0, len(tokens), size):
                    stop = min(start + size, len(tokens))
                    first = int(np.searchsorted(begin, start, side="right")) - 1
                    last = int(np.searchsorted(begin, stop, side="left"))
                    lead = min(2, start - int(begin[first]))
                    opens = np.maximum(begin[first:last], start - lead)
                    found, ids = np.unique(tokens[start - lead:stop], return_inverse=True)
                    lengths = np.diff(np.append(opens, stop))
                    leads = np.zeros(len(opens), dtype=np.int64)
                    leads[0] = lead
                    taught = np.repeat(learn[first:last], lengths)
                    taught[:lead] = False
                    counts = np.bincount(ids[taught], minlength=len(found))
                    own = batch.slice(first, last - first)
                    yield pa.record_batch({
                        "block": pa.array([base + number]), "tokens": pa.array([stop - start]),
                        "learned": pa.array([int(taught.sum())]), "distinct": pa.array([len(found)]),
                        "words": pa.array([pack(_steps(found), counts)], pa.binary()),
                        "ids": pa.array([pack(ids)], pa.binary()),
                        "pieces": pa.array([pack(opens - (start - lead), leads, learn[first:last])], pa.binary()),
                        "rows": _listed(own.column("row")), "doc_ids": _listed(own.column("doc_id")),
                        "held": _listed(own.column("held_out"))})
                    number += 1

    return blocks


def _listed(column):
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def _word_runs(words, parts):
    """The first of the sorted words in each part (parts + 1); a part is a range of hashes."""
    part = ((words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    return np.searchsorted(part, np.arange(parts + 1))


def _ask_words(parts):
    def ask(batches):
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("words")):
                steps, counts = unpack(data.as_py())
                words = np.cumsum(steps, dtype=np.uint64)
                runs = _word_runs(words, parts)
                rows = [(p, pack(_steps(words[a:b]), counts[a:b]))
                        for p, (a, b) in enumerate(zip(runs[:-1], runs[1:])) if b > a]
                yield pa.record_batch({"block": pa.array([block] * len(rows), pa.int64()),
                                       "part": pa.array([p for p, _ in rows], pa.int32()),
                                       "data": pa.array([d for _, d in rows], pa.binary())})

    return ask


def _answers(blocks, kind, part, data, fresh=0, top=None):
    n = len(blocks)
    return pa.table({"block": pa.array(blocks, pa.int64()), "kind": pa.array([kind] * n, pa.int32()),
                     "part": pa.array([part] * n, pa.int32()), "fresh": pa.array([fresh] + [0] * (n - 1), pa.int64()),
                     "top": pa.array([top] + [None] * (n - 1), pa.binary()), "data": pa.array(data, pa.binary())})


def _count_words(parts, frequent):
    """Answers the number of each word, and its count unless it is broadcast.

    Frequent words get small numbers. ``fresh``: the part's learned words; ``top``: the counts to be broadcast.
    """
    def count(key, table):
        asked = [unpack(x) for x in table.column("data").to_pylist()]
        words = np.concatenate([np.cumsum(s, dtype=np.uint64) for s, _ in asked])
        found, at = np.unique(words, return_inverse=True)
        n = np.bincount(at, np.concatenate([c for _, c in asked]).astype(np.float64)).astype(np.int64)
        number = np.empty(len(found), dtype=np.int64)
        order = np.argsort(-n, kind="stable")
        number[order] = np.arange(len(found))
        rare = number >= frequent // parts
        number = number * parts + key[0].as_py()
        data, end = [], 0
        for steps, _ in asked:
            own, end = at[end:end + len(steps)], end + len(steps)
            data.append(pack(number[own], n[own[rare[own]]]))
        return _answers(table.column("block").to_pylist(), 0, key[0].as_py(), data, int((n > 0).sum()),
                        pack(n[order[:frequent // parts]]))

    return count


class _Asked:
    """The words and n-grams of one block, in the order in which it asks for them.

    Words are numbered from ``_SHIFT`` in order of their number in the corpus. Each question is a trigram
    (middle, last, first), first = ``_NONE`` at the second word of a text, last = ``_ASK`` for the sums of a context.
    """

    def __init__(self, block, answers, common, parts, hot):
        n, number = [], []
        for _, data in sorted(answers):     # parts are ranges of the block's sorted words
            numbers, counts = unpack(data)
            number.append(numbers.astype(np.int64))
            n.append(_with_common(number[-1], counts, common))
        n, number = np.concatenate(n), np.concatenate(number)
        order = np.argsort(number)
        self.n, self.number, self.common = n[order], number[order], len(common)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.ids = place[unpack(block["ids"])[0].astype(np.int64)]
        self.begin, self.leads, self.learn = (x.astype(np.int64) for x in unpack(block["pieces"]))
        self.begin = np.append(self.begin, len(self.ids))
        self.size = len(order) + _SHIFT
        length = np.diff(self.begin)
        nth = np.arange(len(self.ids)) - np.repeat(self.begin[:-1], length)
        taught = np.repeat(self.learn, length) * (nth >= np.repeat(self.leads, length))
        at = np.flatnonzero(nth >= 1)
        middle, last = self.ids[at - 1] + _SHIFT, self.ids[at] + _SHIFT
        first = np.where(nth[at] >= 2, self.ids[at - 2] + _SHIFT, _NONE)
        self.pairs, pair = np.unique(middle * self.size + last, return_inverse=True)
        grams, gram = np.unique(pair * self.size + first, return_inverse=True)
        counts = np.bincount(gram, taught[at], minlength=len(grams)).astype(np.int64)
        pair, first = self.pairs[grams // self.size], grams % self.size
        middle, last = pair // self.size, pair % self.size
        salts = np.minimum(SALTS, 1 + self.n // hot)
        home = text.mix(self.number.astype(np.uint64) * np.uint64(2 * SALTS + 1))
        mixed = text.mix(self.number.astype(np.uint64) + np.uint64(1))
        salt = mixed[last - _SHIFT] % salts[middle - _SHIFT].astype(np.uint64)
        # contexts of dealt middle words that may lack an arc ask every part for their sums
        dealt = np.flatnonzero((salts[middle - _SHIFT] > 1) & (counts == 0))
        context = _distinct(np.concatenate([middle[dealt] * self.size + first[dealt], middle[dealt] * self.size + _NONE]))
        many = salts[context // self.size - _SHIFT]
        context = np.repeat(context, many)
        every = np.arange(len(context)) - np.repeat(np.cumsum(many) - many, many)
        # they go before the n-grams of their word, so that all stay in order
        at = np.searchsorted(middle * self.size + last, context // self.size * self.size + _ASK)
        middle, first = np.insert(middle, at, context // self.size), np.insert(first, at, context % self.size)
        last, counts = np.insert(last, at, _ASK), np.insert(counts, at, 0)
        salt = np.insert(salt, at, every.astype(np.uint64))
        part = (text.mix(home[middle - _SHIFT] + salt) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
        rank = np.argsort(part, kind="stable")
        self.middle, self.last, self.first, self.counts = middle[rank], last[rank], first[rank], counts[rank]
        self.runs = np.searchsorted(part[rank].astype(np.int64), np.arange(parts + 1))

    def questions(self):
        """(part, packed words and n-grams) of each part that is asked."""
        for part, (a, b) in enumerate(zip(self.runs[:-1], self.runs[1:])):
            if b > a:
                used, at = np.unique(np.concatenate([x[a:b] for x in (self.middle, self.last, self.first)]), return_inverse=True)
                middle, last, first = at.reshape(3, -1)
                words = used[used >= _SHIFT] - _SHIFT
                number = self.number[words]
                yield part, pack(np.isin([_NONE, _ASK], used), _steps(number), self.n[words[number >= self.common]],
                                 _steps(middle), last, first, self.counts[a:b])

    def contexts(self, a, b):
        """Of one part's questions: pairs, then the contexts and the middle words that may lack an arc."""
        middle, last, first = self.middle[a:b], self.last[a:b], self.first[a:b]
        open_ = self.counts[a:b] == 0
        return (_distinct(middle * self.size + last, True), _distinct(middle[open_] * self.size + first[open_]),
                _distinct(middle[open_], True))


def _with_common(number, sent, common):
    """The count of each number: broadcast, or sent in the order of the numbers."""
    known = number < len(common)
    n = np.empty(len(number), dtype=np.int64)
    n[known] = common[number[known]]
    n[~known] = sent
    return n


def _count_grams(shared, denominator, discount):
    """Answers, for each question of a part, the counts and sums over the whole corpus."""
    def count(key, table):
        columns, words, times = [[] for _ in range(4)], [], []
        for x in table.column("data").to_pylist():
            none, steps, sent, *entries = unpack(x)
            number = np.cumsum(steps).astype(np.int64)
            # a question's numbers become places in this list of words, later in the part's
            words.append(np.concatenate([np.flatnonzero(none), number + _SHIFT]))
            times.append(np.append(np.zeros(int(none.sum()), np.int64), _with_common(number, sent, shared.value)))
            entries[0] = np.cumsum(entries[0])
            for column, entry in zip(columns, entries):
                column.append(entry.astype(np.int32))
        used, at = np.unique(np.concatenate([[_NONE, _ASK], *words]), return_inverse=True)
        size = len(used)
        times_of = np.zeros(size, dtype=np.int64)
        times_of[at[2:]] = np.concatenate(times)
        ends = np.cumsum([2, *(len(w) for w in words)])
        cuts = np.cumsum([0, *(len(c) for c in columns[0])])
        middle, last, first = (np.concatenate([at[e:][c] for e, c in zip(ends, column)]) for column in columns[:3])
        counts = np.concatenate(columns[3])
        del columns, words, times, used, at
        pairs, pair = np.unique(middle * size + last, return_inverse=True)
        del middle, last
        grams, gram = np.unique(pair * size + first, return_inverse=True)
        del pair, first
        gram = gram.astype(np.int32)
        n3 = np.bincount(gram, counts, minlength=len(grams)).astype(np.int64)
        of, before = grams // size, grams % size
        del grams
        n2 = np.bincount(of, n3, minlength=len(pairs)).astype(np.int64)
        head, word = pairs // size, pairs % size
        arcs2 = n2 > 0
        p1 = (times_of[word] + 0.5) / denominator
        many1 = np.bincount(head, arcs2, minlength=size).astype(np.int64)
        rest1 = np.bincount(head, p1 * arcs2, minlength=size)
        p2 = (n2 - discount) / np.maximum(times_of[head], 1)
        arcs3 = (n3 > 0) & (before != _NONE)
        contexts, context = np.unique(head[of] * size + before, return_inverse=True)
        many = np.bincount(context, arcs3, minlength=len(contexts)).astype(np.int64)
        rest = np.bincount(context, p2[of] * arcs3, minlength=len(contexts))
        del p1, p2, arcs2, arcs3, contexts, before
        data = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            g = gram[a:b]
            open_ = g[counts[a:b] == 0]
            pair, asking, heads = _distinct(of[g]), _distinct(context[open_]), _distinct(head[of[open_]])
            data.append(pack(n3[g], n2[pair], many[asking], rest[asking], many1[heads], rest1[heads]))
        return _answers(table.column("block").to_pylist(), 1, key[0].as_py(), data)

    return count


def automaton(asked, answers, denominator, discount=lm.DISCOUNT):
    """The states and arcs that a block's texts can meet, from the answers of all parts."""
    size, words = asked.size, asked.size - _SHIFT
    n3 = np.zeros(len(asked.middle), dtype=np.int64)
    n2 = np.zeros(len(asked.pairs), dtype=np.int64)
    contexts = _distinct(asked.middle * size + asked.first)
    many, rest = np.zeros(len(contexts), np.int64), np.zeros(len(contexts))
    many1, rest1 = np.zeros(size, dtype=np.int64), np.zeros(size)
    for part, data in answers:
        a, b = int(asked.runs[part]), int(asked.runs[part + 1])
        pairs, open_, heads = asked.contexts(a, b)
        counts, seen, m, r, m1, r1 = unpack(data)
        n3[a:b] = counts
        real = pairs % size != _ASK
        n2[np.searchsorted(asked.pairs, pairs[real])] = seen[real]
        at = np.searchsorted(contexts, open_)
        many[at] += m.astype(np.int64)
        rest[at] += r
        many1[heads] += m1.astype(np.int64)
        rest1[heads] += r1

    def backoff(many, times, rest):
        left = discount * many / np.maximum(times, 1)
        return np.where((times > 0) & (many > 0), np.log10(np.maximum(left, 1e-12) / np.maximum(1 - rest, 1e-12)), 0.0)

    model = lm.Automaton(np.zeros(words, np.uint64), np.log10((asked.n + 0.5) / denominator), denominator, 3)
    # states: the root, words, pairs with an arc
    found = np.flatnonzero(n2 > 0)
    state = np.full(len(n2), -1, dtype=np.int64)
    state[found] = 1 + words + np.arange(len(found))
    head, word = asked.pairs[found] // size - _SHIFT, asked.pairs[found] % size - _SHIFT
    model.fail = np.concatenate([np.zeros(1 + words, np.int64), 1 + word])
    # of what follows a pair its last word is the middle one; each word but a text's last has one after it,
    # so a pair occurs as often as all its arcs
    at = lm._find(contexts, (word + _SHIFT) * size + head + _SHIFT, True)
    after = np.where(at >= 0, backoff(many[at], n2[found], rest[at]) if len(contexts) else 0.0, 0.0)
    model.backoff = np.concatenate([[0.0], backoff(many1[_SHIFT:], asked.n, rest1[_SHIFT:]), after])
    arcs = [(1 + head) * words + word]
    weight = [np.log10((n2[found] - discount) / asked.n[head])]
    target = [state[found]]
    three = np.flatnonzero((n3 > 0) & (asked.first != _NONE) & (asked.last != _ASK))
    middle, last, first = asked.middle[three], asked.last[three], asked.first[three]
    source = lm._find(asked.pairs, first * size + middle, True)
    known = (source >= 0) & (state[source] >= 0) if len(source) else np.zeros(0, dtype=bool)
    three, middle, last, first, source = (x[known] for x in (three, middle, last, first, source))
    arcs.append(state[source] * words + last - _SHIFT)
    weight.append(np.log10((n3[three] - discount) / n2[source]))
    target.append(state[np.searchsorted(asked.pairs, middle * size + last)])
    arcs, weight, target = (np.concatenate(x) for x in (arcs, weight, target))
    rank = np.argsort(arcs)
    model.arcs, model.weight, model.target = arcs[rank], weight[rank], target[rank]
    return model


def _read(table):
    rows = table.to_pylist()
    return rows[0] if rows else None


def _split(table, kind):
    found = table.filter(pa.array(np.asarray(table.column("kind")) == kind)) if table.num_rows else table
    return list(zip(found.column("part").to_pylist(), found.column("data").to_pylist()))


def _ask_grams(shared, parts, hot):
    def ask(left, right):
        block = _read(left)
        rows = list(_Asked(block, _split(right, 0), shared.value, parts, hot).questions()) if block else []
        return pa.table({"block": pa.array([block["block"] if block else 0] * len(rows), pa.int64()),
                         "part": pa.array([p for p, _ in rows], pa.int32()),
                         "data": pa.array([d for _, d in rows], pa.binary())})

    return ask


_PIECES = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base", pa.float64()), ("walk", pa.float64())])


def _walk(shared, parts, hot, denominator, discount):
    def walk(left, right):
        block = _read(left)
        if not block:
            return _PIECES.empty_table()
        asked = _Asked(block, _split(right, 0), shared.value, parts, hot)
        model = automaton(asked, _split(right, 1), denominator, discount)
        length = np.diff(asked.begin)
        owner = np.repeat(np.arange(len(length)), length)
        own = np.arange(len(asked.ids)) - np.repeat(asked.begin[:-1], length) >= asked.leads[owner]
        log = lm.traverse(model, asked.ids, asked.begin)
        # what the words before the piece would add by themselves
        before = np.append(0, np.cumsum(asked.leads))
        log -= lm.traverse(model, asked.ids[~own], before)
        total = lambda x: np.bincount(owner, np.where(own, x, 0), minlength=len(length))
        return pa.Table.from_arrays([
            pa.array(block["rows"], pa.int64()), pa.array(block["doc_ids"], pa.int64()), pa.array(block["held"], pa.bool_()),
            pa.array(length - asked.leads), pa.array(total(asked.n[asked.ids] > 0).astype(np.int64)),
            pa.array(total(model.root[asked.ids])), pa.array(log)], schema=_PIECES)

    return walk


def _common(words, parts):
    """Counts by number of the words below the bound, from one row of each part."""
    tops = {r.part: unpack(r.top)[0] for r in words.where("top is not null").select("part", "top").collect()}
    table = np.zeros((max((len(t) for t in tops.values()), default=0), parts), dtype=np.int64)
    for part, top in tops.items():
        table[:len(top), part] = top
    return table.reshape(-1)


def score_corpus(documents: DataFrame, learn, *, held_out=None, id_col="doc_id", text_col="text", block=BLOCK, part=PART,
                 hot=HOT, frequent=FREQUENT, discount=lm.DISCOUNT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``learn`` is a condition on the rows to learn from. ``block``: tokens of a block; ``part``: n-grams of a part.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        (F.lit(False) if held_out is None else held_out).alias("held_out"),
        F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("string").alias("text"))
    blocks = materialize(rows.mapInArrow(_blocks(block), _BLOCKS), "blocks")
    size = blocks.agg(F.count("*").alias("blocks"), F.sum("tokens").alias("tokens"), F.sum("learned").alias("learned"),
                      F.sum("distinct").alias("words")).first()
    word_parts, parts = 1 + (size.words or 0) // part, 1 + (size.tokens or 0) // part
    tasks = max(1, min(size.blocks, 64), size.blocks // 8)
    cut = blocks.drop("words", "tokens", "learned", "distinct").repartition(tasks, "block")
    asked = blocks.select("block", "words").mapInArrow(_ask_words(word_parts), "block long, part int, data binary")
    words = materialize(
        asked.repartition(word_parts, "part").groupBy("part").applyInArrow(_count_words(word_parts, frequent), _ANSWER), "words")
    distinct = words.agg(F.sum("fresh").alias("n")).first().n or 0
    denominator = (size.learned or 0) + 0.5 * (distinct + 1)
    shared = spark.sparkContext.broadcast(_common(words, word_parts))
    words = words.select("block", "kind", "part", "data")
    asked = cut.groupBy("block").cogroup(words.repartition(tasks, "block").groupBy("block")).applyInArrow(
        _ask_grams(shared, parts, hot), "block long, part int, data binary")
    grams = asked.repartition(parts, "part").groupBy("part").applyInArrow(_count_grams(shared, denominator, discount), _ANSWER)
    answers = words.unionByName(grams.select(words.columns)).repartition(tasks, "block")
    pieces = cut.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _walk(shared, parts, hot, denominator, discount),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, walk double")
    return pieces.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(size.learned or 0).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"), F.sum("walk").alias("score")).drop("row")

"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are mapped to symbols: insult, threat, target, negation, reported speech, other.
Three small transducers read a clause from left to right: one marks insults and threats in
a clause that has addressed a target, one those within reach of a negation, one those in a
clause that reports what somebody said. ``compose`` feeds each one's output to the next;
the result is one table of transitions, which emits a pattern at each insult or threat.
The word's weight is added to that pattern. So "you are a W", "not a W" and "they said W"
are different matches. The score is a logistic function of the weights matched per
pattern, and of nothing else: a word counts for no more than its clause makes of it.

The insult lexicon is learned: words and word beginnings that occur in toxic documents of
a bounded labelled sample far more often than in others, by the lower bound of their
log-odds, beside a few seeds. Near copies in the sample count as one document. What each
pattern is worth is fitted on the same sample, in order: a reported or negated match is
worth at most a plain one, and a plain one at most one with a target; where the sample says
little, worths stay near ``PRIOR``. Only seeds of the closed classes (pronouns, negations,
verbs of saying) are given.

Undefined and edge cases: a null or empty text matches nothing and gets the score of no
match. Without labels the seeds alone decide, with the prior worths. Texts and clauses may
be of any length. Every row gives a row, whatever its id. Other columns are not read. An
empty table gives an empty result.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import arrow, labelled, minhash, text
from tillcast.session import materialize

ACCEPT = 0.7
PREFIXES = (4, 5, 6)    # bytes of word beginnings in the lexicon
LEAST_DOCUMENTS = 5     # toxic sample documents that an entry occurs in, at least
LEAST_ODDS = 2.0        # lower bound of an entry's log-odds,
SURE = 2.5              # so many standard deviations below them
REACH = 3               # words that a negation reaches over

SEEDS = {
    "insult": "idiot idiots moron morons stupid fool loser losers scum trash garbage worthless pathetic disgusting imbecile "
              "dumb jerk dummkopf abschaum arschloch trottel verlierer connard imbécile abruti ordure idiota imbécil basura "
              "estúpido estúpida",
    "threat": "kill hurt destroy stab shoot beat burn murder umbringen töten schlagen zerstören vernichten tuer frapper "
              "détruire brûler matar golpear destruir quemar",
    "target": "you your yours yourself they them he him she her u du dich dir euch ihr sie ihn tu te toi vous votre ils elle "
              "lui tú ti usted ustedes vosotros ellos ella él",
    "negation": "not never isn aren don doesn won cannot nicht kein keine keinen nie niemals pas jamais aucun nunca jamás ningún",
    "report": "said says say wrote writes called calls quote quoted claimed claims told sagte sagt sagten schrieb nannte "
              "behauptet dit disait écrit appelle prétend dijo dice dicen escribió llamó afirma",
}
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CLASSES = {"insult": INSULT, "threat": THREAT, "target": TARGET, "negation": NEGATION, "report": REPORT}
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[10, 33, 46, 59, 63]] = True


#: Marks that the small transducers put on the symbol of an insult or a threat.
TARGETED, NEGATED, REPORTED = 6, 12, 24


@dataclass
class Transducer:
    """From each state and input symbol, the next state and the output symbol; state 0 opens a clause."""

    follow: np.ndarray
    out: np.ndarray


def compose(first, second):
    """The transducer that feeds the output of ``first`` to ``second``."""
    a, b = len(first.follow), len(second.follow)
    states = np.arange(a * b)
    here, there = states // b, states % b
    middle = first.out[here]
    return Transducer(first.follow[here] * b + second.follow[there[:, None], middle], second.out[there[:, None], middle])


def _marker(states, size, mark, enter, leave=None):
    """Marks hits while its state is not 0; a symbol of class ``enter`` leads to the last state.

    Other symbols lead to ``leave`` of the state, by default to where it is.
    """
    symbols = np.arange(size)
    kind = symbols % 6
    state = np.arange(states)[:, None]
    stay = state if leave is None else leave(state)
    follow = np.where(kind == enter, states - 1, stay)
    hit = (kind == INSULT) | (kind == THREAT)
    return Transducer(follow, np.where((state > 0) & hit, symbols + mark, symbols))


def grammar():
    """The composed transducer: next state and emitted pattern by (state, symbol); -1 emits nothing.

    Patterns of insults are 0 plain, 1 with a target, 2 negated, 3 reported, of threats 4 more.
    """
    target = _marker(2, 6, TARGETED, TARGET)
    negation = _marker(REACH + 1, 12, NEGATED, NEGATION, lambda state: np.maximum(state - 1, 0))
    report = _marker(2, 24, REPORTED, REPORT)
    whole = compose(compose(target, negation), report)
    kind, marks = whole.out % 6, whole.out // 6
    pattern = np.where(marks & 4, 3, np.where(marks & 2, 2, marks & 1))
    return whole.follow, np.where((kind == INSULT) | (kind == THREAT), pattern + 4 * (kind == THREAT), -1)


_FOLLOW, _EMIT = grammar()


@dataclass
class Lexicon:
    """Sorted hashes of words and word beginnings with symbol and weight."""

    words: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray

    def look_up(self, hashes, heads):
        """Symbol and weight of each word: the entry of most weight among the word and its beginnings."""
        symbol, weight = np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes))
        for own in (hashes, *heads):
            at = np.minimum(np.searchsorted(self.words, own), len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == own)
            more = hit[self.weights[at[hit]] > weight[hit]]
            symbol[more], weight[more] = self.symbols[at[more]], self.weights[at[more]]
        return symbol, weight


def seeded(learned=(), weights=()):
    """Seeds and learned insults as one lexicon; seeds of closed classes weigh little but win over nothing."""
    found = {int(h): (CLASSES[name], 1e-6 if CLASSES[name] > THREAT else 2.0)
             for name, words in SEEDS.items() for w in words.split() for h in text.word_hash(w, text.ALNUM)}
    for h, weight in zip(learned, weights):
        found[int(h)] = (INSULT, float(weight))
    words = np.array(sorted(found), dtype=np.uint64)
    return Lexicon(words, np.array([found[int(w)][0] for w in words], dtype=np.int64),
                   np.array([found[int(w)][1] for w in words]))


def matches(column, lexicon):
    """Per text the weight matched by each pattern (logarithm of one more)."""
    data, offsets = text.buffers(column)
    n = len(offsets) - 1
    hashes, docs, starts, _, heads = text.words(data, offsets, text.ALNUM, spans=True, prefixes=PREFIXES)
    symbol, weight = lexicon.look_up(hashes, heads)
    total = np.zeros((n, 8))
    hot = np.flatnonzero((symbol == INSULT) | (symbol == THREAT))
    if len(hot):
        # clauses that hold an insult or a threat, and only their symbols that change the state
        breaks = np.unique(np.concatenate([np.flatnonzero(_BREAK[data]), offsets]))
        clause = np.searchsorted(breaks, starts, side="right")
        wanted = np.flatnonzero((symbol > 0) & np.isin(clause, clause[hot]))
        state, last_clause, last = 0, -1, 0
        follow, emit = _FOLLOW.tolist(), _EMIT.tolist()
        rows = zip(wanted.tolist(), clause[wanted].tolist(), symbol[wanted].tolist(), weight[wanted].tolist(),
                   docs[wanted].tolist())
        for at, c, s, w, d in rows:
            if c != last_clause:
                state, last_clause = 0, c
            else:
                for _ in range(min(at - last - 1, REACH)):
                    state = follow[state][OTHER]
            pattern = emit[state][s]
            if pattern >= 0:
                total[d, pattern] += w
            state, last = follow[state][s], at
    return np.log1p(total)


@dataclass
class Model:
    lexicon: Lexicon
    worth: np.ndarray
    start: float

    def score(self, column):
        return 1 / (1 + np.exp(-np.clip(matches(column, self.lexicon) @ self.worth + self.start, -30, 30)))


#: Worths that the fit starts from and is drawn to: insults, then threats.
PRIOR = np.array([2.0, 2.5, 0.3, 0.3, 1.0, 2.5, 0.2, 0.2])


def _in_order(w):
    """The worths with no pattern worth more than its order allows."""
    out = np.maximum(w, 0.0)
    for k in (0, 4):
        if out[k] > out[k + 1]:
            out[k] = out[k + 1] = (out[k] + out[k + 1]) / 2
        out[k + 2:k + 4] = np.minimum(out[k + 2:k + 4], out[k])
    return out


def fit(x, y, rounds=200, penalty=0.05):
    """Logistic regression by Newton steps on the worths, held in order after each step."""
    if not len(x) or y.min() == y.max():
        return PRIOR, -3.5
    full = np.column_stack([x, np.ones(len(x))])
    prior, keep = np.append(PRIOR, 0.0), np.append(np.ones(x.shape[1]), 1e-3)
    w = np.append(PRIOR, -3.5)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        grad = full.T @ (y - p) - penalty * keep * (w - prior)
        curve = (full * (p * (1 - p))[:, None]).T @ full + np.diag(penalty * keep)
        step = np.linalg.solve(curve, grad)
        new = w + step / max(1.0, np.abs(step).max() / 0.5)
        new[:-1] = _in_order(new[:-1])
        done, w = np.abs(new - w).max() < 1e-7, new
        if done:
            break
    return w[:-1], float(w[-1])


def _entries(batches):
    """(entry, label) of each distinct word and beginning of each sample text."""
    for batch in arrow.slices(batches, "text", arrow.FINE):
        data, offsets = text.buffers(batch.column("text"))
        hashes, docs, heads = text.words(data, offsets, text.ALNUM, prefixes=PREFIXES)
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64) > 0
        for own in (hashes, *heads):
            used = own != 0
            order = np.lexsort((docs[used], own[used]))
            h, d = own[used][order], docs[used][order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            h, toxic = h[new], label[d[new]]
            word, at = np.unique(h, return_index=True)
            many = np.diff(np.append(at, len(h)))
            bad = np.add.reduceat(toxic.astype(np.int64), at) if len(at) else at
            yield pa.record_batch({"entry": pa.array(word.view(np.int64)), "toxic": pa.array(bad.astype(np.int64)),
                                   "clean": pa.array((many - bad).astype(np.int64))})


def train(documents: DataFrame, labels: DataFrame, *, rows=None, label="toxic", bound=labelled.SAMPLE) -> Model:
    """Learn the lexicon and fit the worths, on at most ``bound`` labelled documents; near copies count as one."""
    spark = documents.sparkSession
    sample = labelled.sample(documents, labels, label, rows=rows, bound=bound).where("text is not null")
    sample = materialize(sample.groupBy(F.sha2("text", 256).alias("h")).agg(
        F.first("text").alias("text"), F.max("label").alias("label")).withColumn("row", F.monotonically_increasing_id()), "labelled")
    groups = minhash.near_duplicates(sample, id_col="row").select(F.col("doc_id").alias("_row"), "component_id")
    known = materialize(sample.join(groups, F.col("row") == F.col("_row")), "grouped")
    toxic_groups = known.groupBy(F.col("component_id").alias("_group")).agg(F.max("label").alias("label"))
    sample = materialize(known.where(F.col("row") == F.col("component_id")).select("component_id", "text").join(
        toxic_groups, F.col("component_id") == F.col("_group")).select("text", "label"), "samples")
    size = sample.agg(F.sum(F.when(F.col("label") > 0, 1).otherwise(0)).alias("toxic"), F.count("*").alias("all")).first()
    toxic, clean = size.toxic or 0, size.all - (size.toxic or 0)
    counted = sample.select("text", "label").mapInArrow(_entries, "entry long, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1)) \
        - SURE * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    # the sample bounds the entries, so none is left out
    found = counted.where(F.col("a") >= LEAST_DOCUMENTS).select("entry", odds.alias("weight")) \
        .where(F.col("weight") >= LEAST_ODDS).orderBy(F.desc("weight"), "entry").toPandas()
    lexicon = seeded(found["entry"].to_numpy(dtype=np.int64).view(np.uint64), found["weight"])
    shared = spark.sparkContext.broadcast(lexicon)

    def matched(batches):
        for batch in arrow.slices(batches, "text", arrow.FINE):
            x = matches(batch.column("text"), shared.value)
            yield pa.record_batch({"label": batch.column("label"), "x": pa.array(list(x), pa.list_(pa.float64()))})

    pairs = sample.select("text", "label").mapInArrow(matched, "label int, x array<double>").toPandas()
    x = np.array(pairs["x"].tolist(), dtype=np.float64).reshape(-1, len(PRIOR))
    y = (pairs["label"].to_numpy(dtype=np.int64) > 0).astype(np.float64)
    order = np.lexsort((*x.T, y))
    return Model(lexicon, *fit(x[order], y[order]))


def score(documents: DataFrame, model: Model, *, held_out=None, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in arrow.slices(batches, "text", arrow.FINE):
            found = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= ACCEPT).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"),
        F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")

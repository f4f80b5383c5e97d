import collections
import math

import numpy as np
import pyarrow as pa
import pytest

from tillcast.llm import lm

END = b"<end>"


def _docs(seed, n=150):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(30)]
    share = 1 / np.arange(1, 31)
    return [" ".join(rng.choice(words, int(rng.integers(0, 40)), p=share / share.sum())) for _ in range(n)]


class _Backoff:
    """The same model word by word, from dictionaries."""

    def __init__(self, texts, order, gram_share, discount=lm.DISCOUNT):
        seqs = [t.encode().lower().split() + [END] for t in texts]
        self.count = [None] + [collections.Counter(tuple(s[i:i + n]) for s in seqs for i in range(len(s) - n + 1))
                               for n in range(1, order + 1)]
        self.N, self.V, self.order, self.d = sum(self.count[1].values()), len(self.count[1]), order, discount
        least = max(gram_share * self.N, 1)
        self.kept = [None, set(self.count[1])] + [
            {g for g, c in self.count[n].items() if c >= least and all(
                self.count[1][(w,)] >= least for w in g)} for n in range(2, order + 1)]
        self.after = collections.defaultdict(list)
        for n in range(2, order + 1):
            for g in self.kept[n]:
                self.after[g[:-1]].append(g[-1])

    def p(self, w, h):
        if not h:
            return (self.count[1].get((w,), 0) + 0.5) / (self.N + 0.5 * (self.V + 1))
        if w in self.after.get(h, ()):
            return (self.count[len(h) + 1][h + (w,)] - self.d) / self.count[len(h)][h]
        if not self.after.get(h):
            return self.p(w, h[1:])
        kept = sum((self.count[len(h) + 1][h + (x,)] - self.d) / self.count[len(h)][h] for x in self.after[h])
        return self.p(w, h[1:]) * (1 - kept) / (1 - sum(self.p(x, h[1:]) for x in self.after[h]))

    def score(self, t):
        s, total = t.encode().lower().split() + [END], 0.0
        for i, w in enumerate(s):
            total += math.log10(self.p(w, tuple(s[max(0, i - self.order + 1):i])))
        return total


@pytest.mark.parametrize("word_share, gram_share", [(1e-6, 1e-9), (0.01, 0.01)])
def test_scores_match_a_model_of_dictionaries(spark, word_share, gram_share):
    texts = _docs(0)
    train, unseen = texts[:120], texts[120:] + ["never seen w1 w2 w1", "", "w3"]
    frame = spark.createDataFrame(list(enumerate(train)), "doc_id long, text string")
    trained = lm.train(frame, word_share=word_share, gram_share=gram_share)
    model = _Backoff(train, lm.ORDER, gram_share)
    asked = spark.createDataFrame(list(enumerate(unseen)), "doc_id long, text string")
    for r in lm.score(asked, trained).collect():
        tokens = unseen[r.doc_id].encode().lower().split() + [END]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum((t,) in model.count[1] for t in tokens), model.N)
        assert r.base_score == pytest.approx(sum(math.log10(model.p(t, ())) for t in tokens))
        assert r.score == pytest.approx(model.score(unseen[r.doc_id])), unseen[r.doc_id]


def test_rare_ngrams_of_a_large_corpus_are_arcs(spark):
    """Of 60,000 tokens, n-grams that occur once or twice count, also where a word of theirs is rare."""
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(400)], 99)) for _ in range(600)]
    train = [*texts, "rare pair stands here", "w1 rare pair w2", "w3 w4 w3 w4 w3"]
    unseen = ["rare pair stands here", "w1 rare pair w2 rare", "never w3 w4 w3", "", *texts[:5], *_docs(3, 20)]
    model = _Backoff(train, lm.ORDER, 1e-9)
    trained = lm.train(spark.createDataFrame(list(enumerate(train)), "doc_id long, text string"))
    rows = lm.score(spark.createDataFrame(list(enumerate(unseen)), "doc_id long, text string"), trained).collect()
    assert len(rows) == len(unseen) and model.N > 60_000
    for r in rows:
        assert r.score == pytest.approx(model.score(unseen[r.doc_id])), unseen[r.doc_id]
    for n, arcs in trained.arcs.items():
        assert arcs.count() == len(model.count[n])


def test_probabilities_of_each_state_sum_to_one(spark):
    texts = _docs(1)
    model, table, n = lm.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), gram_share=0.002)
    size = len(model.words)
    assert size == table.count() and len(model.levels) == 2 and len(model.levels[1]) > 5
    unseen = 0.5 / model.denominator
    for state in range(1 + size + len(model.levels[0])):
        total = 0.0
        for w in range(size):
            now, log = state, 0.0
            while now and not len(np.flatnonzero(model.arcs == now * size + w)):
                log, now = log + model.backoff[now], model.fail[now]
            log += model.weight[np.flatnonzero(model.arcs == now * size + w)[0]] if now else model.root[w]
            total += 10 ** log
        now, log = state, math.log10(unseen)
        while now:
            log, now = log + model.backoff[now], model.fail[now]
        assert total + 10 ** log == pytest.approx(1)


@pytest.mark.parametrize("stretch", [2, 3, 7])
def test_stretches_do_not_change_scores(spark, stretch):
    texts = _docs(2, 60)
    model, _, _ = lm.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), gram_share=0.002)
    tokens, begin = lm.sequences(pa.array([*texts, "zzz w1 w2 zzz w1"]))
    ids = model.index(tokens)
    assert np.allclose(lm.traverse(model, ids, begin, stretch), lm.traverse(model, ids, begin, 10 ** 6))


def test_model_beats_the_base_on_unseen_text(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{a}{i}" for _ in range(20) for i, a in [(int(rng.integers(0, 9)), "p")] for a in ("x", "y", "z")) for _ in range(100)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trained = lm.train(frame.where("doc_id < 80"))
    rows = lm.score(frame.where("doc_id >= 80"), trained).collect()
    assert sum(r.score for r in rows) > 0.8 * sum(r.base_score for r in rows) > sum(r.base_score for r in rows)


def test_edge_cases(spark, odd, none):
    rows = lm.score(odd, lm.train(odd)).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (3, 4, 5):
        assert (by[i].n_tokens, by[i].n_known) == (1, 1)
    assert by[6].n_tokens == 180_001 and by[12].n_tokens == 2
    assert lm.score(none, lm.train(odd)).collect() == []
    rows = lm.score(odd, lm.train(none)).collect()
    assert all((r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in rows)

import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_lm import END, _Backoff, _docs
from tillcast.llm import lm, lm_blocks


def _frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


def test_packed_columns_come_back():
    columns = [np.array([0, 1, 255, 256, 1 << 40]), np.zeros(0, dtype=np.int64), np.zeros(3, dtype=np.int64),
               np.array([0.0, -1.5, 1e300]), np.array([(1 << 64) - 1], dtype=np.uint64), np.array([True, False])]
    for a, b in zip(columns, lm_blocks.unpack(lm_blocks.pack(*columns))):
        assert np.array_equal(a, b)


@pytest.mark.parametrize("block, part, hot, frequent", [(1 << 20, 1 << 20, 1 << 19, 1 << 20), (97, 50, 40, 90), (7, 200, 3, 0)])
def test_scores_match_a_model_of_dictionaries(spark, block, part, hot, frequent):
    """Whole, in small blocks that cut texts, and with most middle words dealt over many parts."""
    texts = [*_docs(0), "never seen w1 w2 w1", "", "w3", "w1 w1 w1 w1 " * 40]
    train = [t for i, t in enumerate(texts) if i % 5 != 1]
    model = _Backoff(train, lm.ORDER, 1e-9)
    rows = lm_blocks.score_corpus(_frame(spark, texts), F.col("doc_id") % 5 != 1, held_out=F.col("doc_id") % 5 == 1,
                                  block=block, part=part, hot=hot, frequent=frequent).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        tokens = texts[r.doc_id].encode().lower().split() + [END]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (r.doc_id % 5 == 1, len(tokens), model.N)
        assert r.n_known == sum((t,) in model.count[1] for t in tokens)
        assert r.base_score == pytest.approx(sum(np.log10(model.p(t, ())) for t in tokens))
        assert r.score == pytest.approx(model.score(texts[r.doc_id])), texts[r.doc_id]


def test_scores_equal_the_joined_form(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    learn = F.col("doc_id") % 3 != 0
    joined = {r.doc_id: r for r in lm.score(docs, lm.train(docs.where(learn))).collect()}
    rows = lm_blocks.score_corpus(docs, learn, block=5_000, part=3_000, hot=200).collect()
    assert len(rows) == len(joined)
    for r in rows:
        other = joined[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (other.n_tokens, other.n_known, other.train_tokens)
        assert r.score == pytest.approx(other.score) and r.base_score == pytest.approx(other.base_score)


def test_a_block_is_scored_by_the_traversal(spark, monkeypatch):
    """Without arcs in the automaton the score falls back to the base, so it comes from the walk."""
    asked = spark.createDataFrame([(0, "a b a b a b"), (1, "a b a b")], "doc_id long, text string")
    walked = []

    def empty(*args, **kwargs):
        model = real(*args, **kwargs)
        walked.append(len(model.arcs))
        model.arcs, model.weight, model.target = (x[:0] for x in (model.arcs, model.weight, model.target))
        model.backoff[:] = 0
        return model

    real = lm_blocks.automaton
    shared = types.SimpleNamespace(value=np.zeros(0, dtype=np.int64))
    full = lm_blocks._walk(shared, 1, 10, 14.0, 0.5)
    tables = _one_block(asked, shared)
    before = full(*tables).to_pydict()
    monkeypatch.setattr(lm_blocks, "automaton", empty)
    after = full(*tables).to_pydict()
    assert walked[0] > 0 and after["walk"] == pytest.approx(after["base"])
    assert all(a > b for a, b in zip(before["walk"], after["walk"]))


def _one_block(docs, shared):
    """A block and all answers to it; 12 tokens of 3 words make the denominator 14."""
    rows = docs.coalesce(1).select(F.col("doc_id").alias("row"), "doc_id", F.lit(False).alias("held_out"), F.lit(True).alias("learn"),
                                   "text")
    block = rows.mapInArrow(lm_blocks._blocks(1000), lm_blocks._BLOCKS).toArrow()
    asked = pa.Table.from_batches(lm_blocks._ask_words(1)(block.select(["block", "words"]).to_batches()))
    key = (pa.scalar(0),)
    words = lm_blocks._count_words(1, 0)(key, asked)
    grams = lm_blocks._count_grams(shared, 14.0, 0.5)(key, lm_blocks._ask_grams(shared, 1, 10)(block, words))
    return block, pa.concat_tables([words, grams])


def test_edge_cases(spark, odd, none):
    rows = lm_blocks.score_corpus(odd, F.lit(True)).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    for i in (3, 4, 5):
        assert (by[i].n_tokens, by[i].n_known) == (1, 1)
    assert by[6].n_tokens == 180_001 and by[12].n_tokens == 2
    assert lm_blocks.score_corpus(none, F.lit(True)).collect() == []
    rows = lm_blocks.score_corpus(odd, F.lit(False)).collect()
    assert len(rows) == odd.count()
    assert all((r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in rows)

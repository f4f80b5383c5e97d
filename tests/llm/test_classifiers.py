import sys
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillcast.llm import folds, labelled, langid, quality, queries, text, toxicity

LABELS = "doc_id long, quality int, toxic int, label int, text string"


@pytest.fixture(scope="module")
def base():
    return "/root/testdata/sf0.01"


def _held_out_accuracy(spark, base, out, label):
    labels = spark.read.parquet(f"{base}/labels.parquet").select(F.col("doc_id").alias("_id"), F.col(label).alias("y"))
    found = out.where("held_out").join(labels, F.col("doc_id") == F.col("_id")).toPandas()
    assert len(found) > 50
    return (found["predicted"] == found["y"]).mean()


def test_folds_match_crc32_and_pass_nulls(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 1, 77, 123456789)] + [(None,)], "doc_id long")
    found = {r.doc_id: r.f for r in rows.select("doc_id", folds.fold(5).alias("f")).collect()}
    assert found.pop(None) == -1
    assert found == {i: zlib.crc32(str(i).encode()) % 5 for i in found}


def test_language_of_held_out_documents(spark, base):
    out = queries.op3_naive_bayes_language(spark, base)
    langs = spark.read.parquet(f"{base}/documents.parquet").select(F.col("doc_id").alias("_id"), "lang")
    found = out.where("held_out").join(langs, F.col("doc_id") == F.col("_id")).toPandas()
    assert len(found) > 100 and (found["lang_pred"] == found["lang"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


def test_language_edge_cases(spark, odd, none):
    model = langid.train(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (3, 4, 5, 7))
    assert by[1].lang_pred == "en" and by[6].lang_pred == "en" and by[1].score == 1.0
    assert langid.train(none)[0] == [] and langid.predict(none, langid.train(none)).collect() == []
    assert {r.lang_pred for r in langid.predict(odd, langid.train(none)).collect()} == {"und"}


def test_every_letter_gets_a_learned_language_and_nothing_else_does(spark):
    """One text per letter of Unicode, and texts of marks, digits, symbols and spaces alone."""
    learned = spark.createDataFrame([("abc", "x"), ("жук", "y")], "text string, lang string")
    model = langid.train(learned)
    letters = [chr(i) for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == "L"]
    others = ["²", "\u0301", "१", "Ⅷ", "—", "…", "€", "😀", "1 2", "\u2028", "\u3000", "ⓐ"]
    rows = spark.createDataFrame(pd.DataFrame({"doc_id": range(len(letters) + len(others)), "text": letters + others}))
    found = langid.predict(rows, model).toPandas().sort_values("doc_id")["lang_pred"].tolist()
    assert len(letters) > 100_000 and set(found[:len(letters)]) <= {"x", "y"}
    assert set(found[len(letters):]) == {"und"}


def test_language_counts_and_scores_match_python(spark):
    docs = spark.createDataFrame([(1, "Ab, c", "x"), (2, "ba b", "y"), (3, "Abc", None)], "doc_id long, text string, lang string")
    langs, logs = langid.train(docs, buckets=1 << 12)
    assert langs == ["x", "y"]

    def buckets_of(t):
        data, offsets = text.buffers(pa.array([t]))
        return np.concatenate([b for b, _ in langid.grams(data, offsets, buckets=1 << 12)])

    # "ab c": 3 letters, 3 pairs, 2 triples (spaces count within longer n-grams only)
    assert len(buckets_of("Ab, c")) == 3 + 3 + 2 and sorted(buckets_of("Ab, c")) == sorted(buckets_of("ab--c"))
    counts = np.bincount(buckets_of("Ab, c"), minlength=1 << 12) + langid.SMOOTHING
    assert np.allclose(logs[0], np.log(counts / counts.sum()), atol=1e-5)
    best = np.argmax(logs[:, buckets_of("abc")].sum(axis=1))
    assert {r.doc_id: r.lang_pred for r in langid.predict(docs, (langs, logs)).collect()}[3] == langs[best]


def test_characters_are_decoded_and_lower_cased():
    raw = np.frombuffer("aÉ€😀ЖZ".encode(), dtype=np.uint8)
    code, at = langid.characters(raw)
    assert "".join(map(chr, code)) == "aé€😀жz" and at.tolist() == [0, 1, 3, 6, 10, 12]


def test_quality_of_held_out_documents(spark, base):
    assert _held_out_accuracy(spark, base, queries.op7_quality_trees(spark, base), "quality") > 0.95


def test_toxicity_of_held_out_documents(spark, base):
    assert _held_out_accuracy(spark, base, queries.op6_toxicity_grammar(spark, base), "toxic") > 0.93


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_edge_cases(spark, odd, none, module):
    nothing = spark.createDataFrame([], LABELS)
    some = spark.createDataFrame(
        [(1, 1, 0, 0, "x"), (2, 1, 0, 0, "x"), (2, 1, 0, 0, "x"), (5, 0, 1, 0, "x"), (7, 0, 1, 0, "x"), (6, None, None, 0, "x"),
         (None, 1, 1, 0, "x"), (999, 1, 1, 0, "x")], LABELS)
    for labels in (nothing, some):
        model = module.train(odd, labels)
        rows = module.score(odd, model, held_out=F.col("doc_id") == 1).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
        assert module.score(none, model).collect() == []
    assert module.score(none, module.train(none, some)).collect() == []


def test_sample_is_bounded_and_counts_a_document_once(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0, 0, "x") for i in range(20)] * 2, LABELS)
    rows = labelled.sample(odd, labels, "quality").collect()
    assert len(rows) == odd.where("doc_id < 20").count() and max(r.label for r in rows) == 1
    assert labelled.sample(odd.dropDuplicates(["doc_id"]), labels, "quality", bound=5).count() <= 5


def test_trees_match_a_walk_from_node_to_node():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, quality.FEATURES))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality.fit(x, y, trees=25, depth=3)
    found = model.score(x)
    for i in range(0, 600, 37):
        total = model.base
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(x[i, f[node]] > t[node])
            total += leaf[node - len(f)]
        assert found[i] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((found > 0.5) == y).mean() > 0.95


def test_statistics_of_known_texts():
    x = quality.statistics(pa.array(["Ab ab c!\n!", None, "a a a"]))
    assert np.isfinite(x).all() and x.shape == (3, quality.FEATURES) and (x[1] == 0).all()
    assert x[0, 1] == pytest.approx(np.log1p(4)) and x[0, 3] == pytest.approx(3 / 4) and x[2, 4] == 1.0
    assert x[0, 5] == pytest.approx(1 / 5) and x[2, 18] == pytest.approx(2 / 3)


def _patterns(t):
    return toxicity.matches(pa.array([t]), toxicity.seeded())[0, :8]


def test_grammar_tells_patterns_apart():
    weight = np.log1p(2.0)
    for t, pattern in (("what an idiot", 0), ("you are an idiot", 1), ("he is not an idiot", 2), ("she said you are an idiot", 3),
                       ("kill", 4), ("i will kill", 4), ("you will be hurt", 5), ("never hurt", 6), ("he said kill", 7)):
        found = _patterns(t)
        assert found[pattern] == pytest.approx(weight) and found.sum() == pytest.approx(weight), t
    # a clause ends the reach of what stands before, and a negation reaches over three words
    assert _patterns("they said so. idiot")[0] > 0 and _patterns("not here\nidiot")[0] > 0
    assert _patterns("not a b idiot")[2] > 0 and _patterns("not a b c idiot")[0] > 0
    assert _patterns("a fine day, says nobody").sum() == 0


def test_matches_against_a_word_by_word_automaton():
    rng = np.random.default_rng(7)
    words = ["idiot", "kill", "you", "not", "said", "tree", "stone", "lake", "."]
    follow, emit = toxicity.grammar()
    lexicon = toxicity.seeded()
    for _ in range(200):
        picked = [words[i] for i in rng.integers(0, len(words), 25)]
        state, total = 0, np.zeros(8)
        for w in picked:
            if w == ".":
                state = 0
                continue
            symbol, weight = lexicon.look_up(text.word_hash(w, text.ALNUM), [])
            if emit[state, symbol[0]] >= 0:
                total[emit[state, symbol[0]]] += weight[0]
            state = follow[state, symbol[0]]
        found = toxicity.matches(pa.array([" ".join(picked)]), lexicon)[0, :8]
        assert np.allclose(found, np.log1p(total))


def test_composition_feeds_one_transducer_to_the_next():
    rng = np.random.default_rng(3)
    one = toxicity.Transducer(rng.integers(0, 3, (3, 4)), rng.integers(0, 5, (3, 4)))
    two = toxicity.Transducer(rng.integers(0, 2, (2, 5)), rng.integers(0, 7, (2, 5)))
    both, word = toxicity.compose(one, two), rng.integers(0, 4, 200)
    a = b = c = 0
    for symbol in word:
        middle = one.out[a, symbol]
        assert both.out[c, symbol] == two.out[b, middle]
        a, b, c = one.follow[a, symbol], two.follow[b, middle], both.follow[c, symbol]
    follow, emit = toxicity.grammar()
    assert len(follow) == 2 * (toxicity.REACH + 1) * 2 and set(emit.ravel()) == set(range(-1, 8))


def test_worths_keep_their_order():
    rng = np.random.default_rng(4)
    x = rng.random((400, 8)) * (rng.random((400, 8)) < 0.4)
    y = ((x[:, 2] + x[:, 3] > 0.3) | (rng.random(400) < 0.1)).astype(float)      # the sample says that negated matches count most
    w, _ = toxicity.fit(x, y)
    for k in (0, 4):
        assert w[k + 1] >= w[k] >= max(w[k + 2], w[k + 3]) >= 0


def test_the_trained_model_reads_clauses(spark, base):
    """Not words: the same insult counts when it is addressed, and not when it is denied or reported."""
    labels = spark.read.parquet(f"{base}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{base}/documents.parquet"), labels, rows=folds.fold(3) != 1)
    texts = ["You idiot", "you are an idiot", "what an idiot you are", "he is not an idiot", "they said he is an idiot", "a fine day",
             "she is not stupid. She is kind.", "he wrote that you are a moron"]
    found = model.score(pa.array(texts))
    assert (found[:3] >= 0.7).all() and (found[3:] < 0.7).all(), dict(zip(texts, found))

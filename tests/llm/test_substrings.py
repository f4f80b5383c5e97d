import random

import numpy as np
import pytest

from tillcast.llm import substrings, text

SMALL = {"words": 6, "gram": 3, "segment": 8}


def brute(rows, words):
    """(id, n_words, n_removed, text) of each row, from all windows of all texts."""
    import re

    cut = [(i, None if t is None else re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in rows]
    first = {}
    for i, w in cut:
        for s in range(len(w or ()) - words + 1):
            if i is not None:
                key = tuple(w[s:s + words])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in cut:
        gone = set()
        for s in range(len(w or ()) - words + 1):
            if i is not None and first[tuple(w[s:s + words])] < i:
                gone.update(range(s, s + words))
        out.append((i, len(w or ()), len(gone), None if w is None else " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in substrings.remove_repeats(frame, **options).collect()), key=str)


@pytest.mark.parametrize("seed, letters", [(1, 2), (2, 3), (3, 30), (4, 300)])
def test_equals_brute_force_on_small_alphabets(spark, seed, letters):
    """Few different words make windows that part from their pivot everywhere."""
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        if texts and rng.random() < 0.6:
            own = rng.choice(texts).split()
            a = rng.randrange(len(own) + 1)
            part = own[a:a + rng.randrange(40)]
            fresh = [f"w{rng.randrange(letters)}" for _ in range(rng.randrange(20))]
            at = rng.randrange(len(fresh) + 1)
            texts.append(" ".join(fresh[:at] + part + fresh[at:]))
        else:
            texts.append(" ".join(f"w{rng.randrange(letters)}" for _ in range(rng.randrange(60))))
    ids = [rng.randrange(50) for _ in texts]                # ids repeat
    assert run(spark, list(zip(ids, texts)), **SMALL) == brute(list(zip(ids, texts)), 6)


def test_shared_passages_of_fifty_words(spark):
    rng = np.random.default_rng(3)
    word = lambda n: [f"x{k}" for k in rng.integers(0, 5000, n)]
    passage, other = word(60), word(50)
    rows = [(i, " ".join(word(rng.integers(0, 700)) + passage + word(rng.integers(0, 30)) + other[:49 + i % 2])) for i in range(40)]
    rows += [(100 + i, rows[3][1].replace(" ", "\n", 5)) for i in range(50)]    # copies but for white space
    rows += [(200, " ".join(passage[:49])), (201, " ".join(w.upper() for w in passage)), (202, " ".join(passage[5:55]))]
    assert run(spark, rows) == brute(rows, 50)


def test_one_word_over_and_over_and_long_texts(spark):
    long = [f"y{i}" for i in range(30_000)]
    rows = [(1, "a " * 300), (2, "a " * 120 + "b " + "a " * 60), (3, "a " * 49), (4, " ".join(long)), (5, " ".join(long[20_000:])),
            (6, " ".join(long[:20_050] + ["z"] + long[20_000:])), (7, "x" * 300_000)]
    assert run(spark, rows) == brute(rows, 50)


def test_odd_rows_and_empty_tables(spark, odd, none):
    found = {(r.doc_id, r.text) for r in substrings.remove_repeats(odd, **SMALL).collect()}
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(found, key=str) == sorted({(i, t) for i, _, _, t in brute(rows, 6)}, key=str)
    assert substrings.remove_repeats(odd, **SMALL).count() == len(rows)
    assert substrings.remove_repeats(none).collect() == [] and substrings.remove_repeats(none).columns == ["doc_id", "n_words", "n_removed", "text"]


def test_every_window_holds_its_seed():
    rng = np.random.default_rng(1)
    data = " ".join(f"w{k}" for k in rng.integers(0, 4, 500)).encode()
    hashes, docs = text.words(np.frombuffer(data, dtype=np.uint8), np.array([0, 700, len(data)]), letters=text.EXACT)
    grams, at, first = substrings._chosen(hashes, docs, 10, 4)
    for a, s in zip(at, first):
        own = grams[s:s + 7]
        assert s <= a <= s + 6 and grams[a] == own.min() and not (grams[a + 1:s + 7] == own.min()).any()
    assert (docs[first] == docs[first + 9]).all()


def test_words_keep_their_case():
    one, two = text.word_hash("Ab ab"), None
    assert one[0] == one[1]
    raw = np.frombuffer(b"Ab ab Ab", dtype=np.uint8)
    two = text.words(raw, np.array([0, len(raw)]), letters=text.EXACT)[0]
    assert two[0] != two[1] and two[0] == two[2]

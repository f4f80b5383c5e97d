import re

import numpy as np
import pyarrow as pa
import pytest

from tillcast.llm import arrow, text

TEXTS = ["The cat  sat\non the CAT", None, "", "   ", "été l'été ÉTÉ", "a b", "x" * 5000, "tail\t", "a\x0bb\x0cc\rd"]


def _python_words(t):
    return (t or "").encode().lower().split()


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_words_match_python_for_any_block_size(size, monkeypatch):
    monkeypatch.setattr(text, "BLOCK", size)
    monkeypatch.setattr(text.blocks, "__defaults__", (size,))
    data, offsets = text.buffers(pa.array(TEXTS))
    hashes, docs, starts, ends = text.words(data, offsets, spans=True)
    expected = [(i, w) for i, t in enumerate(TEXTS) for w in _python_words(t)]
    assert docs.tolist() == [i for i, _ in expected]
    assert [bytes(data[a:b]).lower() for a, b in zip(starts, ends)] == [w for _, w in expected]
    by_word = {}
    for h, (_, w) in zip(hashes.tolist(), expected):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_sliced_arrow_column():
    column = pa.array(TEXTS).slice(4, 3)
    data, offsets = text.buffers(column)
    assert bytes(data).decode() == "".join(t or "" for t in TEXTS[4:7]) and offsets[0] == 0


def test_word_beginnings():
    data, offsets = text.buffers(pa.array(["loweian lowe low Loweitum"]))
    _, _, (four, five) = text.words(data, offsets, prefixes=(4, 5))
    assert four[0] == four[1] == four[3] != 0 and four[2] == 0
    assert five[0] == five[3] != 0 and five[1] == 0


@pytest.mark.parametrize("k", [1, 2, 5])
def test_shingles_match_python(k):
    data, offsets = text.buffers(pa.array(TEXTS))
    hashes, docs = text.words(data, offsets)
    values, owners, at = text.shingles(hashes, docs, k)
    expected = []
    for i, t in enumerate(TEXTS):
        w = _python_words(t)
        expected += [(i, tuple(w[j:j + k])) for j in range(max(1, len(w) - k + 1))] if w else []
    assert owners.tolist() == [i for i, _ in expected]
    names = {}
    for v, (_, s) in zip(values.tolist(), expected):
        assert names.setdefault(s, v) == v
    assert len(set(names.values())) == len(names)


def test_alnum_words():
    data, offsets = text.buffers(pa.array(["Hé, it's 3.5|x"]))
    _, _, a, b = text.words(data, offsets, text.ALNUM, spans=True)
    found = [bytes(data[i:j]).decode() for i, j in zip(a, b)]
    assert found == re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", "Hé, it's 3.5|x")


def test_random_bytes_of_all_kinds():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("ab \n\té€"), 40)) for _ in range(200)]
    data, offsets = text.buffers(pa.array(texts))
    hashes, docs = text.words(data, offsets)
    assert docs.tolist() == [i for i, t in enumerate(texts) for _ in _python_words(t)]


def test_slices_bound_bytes_and_keep_rows():
    batch = pa.record_batch({"text": pa.array(["a" * n for n in (5, 50, 1, 1, 1, 100, 2)] + [None])})
    parts = list(arrow.slices([batch], "text", 10))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column("text").to_pylist()) <= 10 for p in parts)

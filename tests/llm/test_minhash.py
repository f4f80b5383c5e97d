import numpy as np
import pytest

from tillcast.llm import minhash


def _sets(rows, k):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.setdefault(i, []).append({tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    return out


def _brute(rows, k):
    sets = {i: s[0] for i, s in _sets(rows, k).items()}
    comp = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        new = dict(comp)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == comp:
            break
        comp = new
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def _near_copies(seed, groups=40, words=60):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{x}" for x in rng.integers(0, 500, words)]
        for _ in range(int(rng.integers(1, 6))):
            copy = list(base)
            for at in rng.integers(0, words, int(rng.integers(0, 6))):
                copy[at] = f"new{rng.integers(0, 10 ** 6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_against_all_pairs(spark, k):
    rows = _near_copies(k)
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == _brute(rows, k)


def test_similarity_of_exactly_four_fifths_links(spark):
    # 9 and 9 shingles, 8 shared: 8 / 10
    a = "a b c d e f g h i j"
    b = "a b c d e f g h i k"
    rows = [(1, a), (2, b), (3, " ".join(a.split()[:8]) + " x y")]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {r.doc_id: r.component_id for r in out} == {1: 1, 2: 1, 3: 3}


def test_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(400):
        copy = list(base)
        copy[int(rng.integers(0, 100))] = f"n{i}"
        rows.append((i, " ".join(copy)))
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert {r.component_id for r in out} == {0}


def test_edge_cases(spark, odd, none):
    out = minhash.near_duplicates(odd, words=2).collect()
    assert len(out) == odd.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1][0][1:] == (1, True) and by[2][0][1:] == (1, False)
    assert [x[1] for x in by[9]] == [1, 1] and by[9][0] == by[9][1]
    for i in (3, 4, 5):
        assert by[i] == [(0, i, True)]
    assert by[10] == [(1, 10, True)] and by[12] == [(1, 12, True)]
    assert sorted(by[None], key=str) == [(0, None, False), (by[1][0][0], 1, False)]
    assert minhash.near_duplicates(none).collect() == []


def test_circulant_coordinates():
    """Coordinate k is the smallest value of one permutation at places shifted by k."""
    values = np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64) * 2
    begin = np.array([0, 0, 120, 121, 500])
    found = minhash.signatures(values, begin, 7)
    place = (values >> np.uint64(32)).astype(np.uint32)
    for i in range(4):
        for k in range(7):
            own = place[begin[i]:begin[i + 1]] + np.uint32(k)
            assert found[i, k] == (minhash._permute(own.copy()).min() if len(own) else 0xFFFFFFFF)
    # the estimate of similarity is unbiased enough
    rng = np.random.default_rng(5)
    both = rng.integers(0, 1 << 63, 8000, dtype=np.uint64) * 2
    a, b = both[:7200], both[800:]
    s = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 512)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.08


def test_long_sets_are_worked_in_parts(monkeypatch):
    values = np.random.default_rng(4).integers(0, 1 << 63, 1000, dtype=np.uint64)
    begin = np.array([0, 700, 710, 1000])
    whole = minhash.signatures(values, begin, 9)
    monkeypatch.setattr(minhash, "_PART", 64)
    assert (minhash.signatures(values, begin, 9) == whole).all()

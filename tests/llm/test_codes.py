import hashlib
import math

import numpy as np
import pytest

from tillcast.llm import codes


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The whole iteration over Python numbers; ``rows`` are (id, label, vector), in order of id."""
    kept = [(i, label, v) for i, label, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    first = min(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = sorted((r for r in kept if len(r[2]) == len(first[2])), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = -(-len(first[2]) // parts)
    cut = []
    for _, _, v in kept:
        whole = [math.floor(scale * x) for x in v] + [0] * (parts * width - len(v))
        cut.append([whole[p * width:(p + 1) * width] for p in range(parts)])
    book = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(part, own):
        apart = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in own]
        return min(range(len(own)), key=lambda e: (apart[e], e)), min(apart)

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in book[p]]
            for c in cut:
                held[near(c[p], book[p])[0]].append(c[p])
            book[p] = [[sum(x) // len(own) for x in zip(*own)] if own else book[p][e] for e, own in enumerate(held)]
    out, by = [], {}
    for (i, label, _), c in zip(kept, cut):
        found = [near(c[p], book[p]) for p in range(parts)]
        error = sum(f[1] for f in found)
        by[label] = by.get(label, 0) + error
        out.append((i, label, "".join(f"{f[0]:02x}" for f in found), error))
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    return sorted(((i, code, error, by[label]) for i, label, code, error in out), key=str), digest


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = codes.compress(frame.repartition(3), **options).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=str), {r.codebooks_sha256 for r in found}


@pytest.mark.parametrize("size, seed", [(16, 1), (20, 2), (3, 3)])
def test_equals_brute_force(spark, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, size))
    rows = [(i, None if i % 7 == 0 else i % 3, [float(x) for x in centres[rng.integers(30)] + rng.normal(size=size) / 9])
            for i in range(300)]
    rows += [(400 + i, 1, rows[5][2]) for i in range(100)]          # a large group of copies
    rows += [(600, 1, None), (601, 1, [None] * size), (602, 1, [float("nan")] * size), (603, 1, [float("inf")] * size),
             (None, 2, rows[9][2]), (7, 2, rows[11][2]), (7, 2, rows[11][2]), (604, 0, [0.5] * (size + 1)), (605, 0, [])]
    expected, digest = brute(rows)
    found, digests = run(spark, rows)
    assert found == expected and digests == {digest}


def test_members_change_owners_over_all_rounds(spark):
    """Seeds far from where the mass lies, so that members leave, come back and entries stay unused."""
    rng = np.random.default_rng(5)
    rows = [(i, 0, [float(x) for x in rng.normal(size=8) * 0.01]) for i in range(16)]
    rows += [(i, 1, [float(x) for x in rng.normal(size=8) * 3]) for i in range(16, 400)]
    expected, digest = brute(rows)
    assert run(spark, rows) == (expected, {digest})


def test_large_numbers_ties_and_few_rows(spark):
    rows = [(1, 0, [1e5] * 8), (2, 0, [-1e5] * 8), (3, None, [0.0] * 8)]
    expected, digest = brute(rows)
    assert run(spark, rows) == (expected, {digest})
    same = [(i, i % 2, [0.25] * 8) for i in range(40)]              # all entries equal: the first one wins
    found, _ = run(spark, same)
    assert {r[1] for r in found} == {"00" * 8} and {r[2] for r in found} == {0}
    huge, _ = run(spark, [(1, 0, [1e300] * 8), (2, 0, [-1e300] * 8), (3, 0, [0.0] * 8)])
    assert len(huge) == 3 and all(r[2] >= 0 for r in huge)


def test_empty_and_clashing_columns(spark):
    frame = spark.createDataFrame([], "vec_id long, label string, embedding array<float>")
    assert codes.compress(frame).collect() == []
    assert dict(codes.compress(frame).dtypes)["label_error"] == "bigint"
    odd = spark.createDataFrame([(1, "a", [0.5] * 8, 3, 4)], "vec_id long, label string, embedding array<float>, code int, pos int")
    assert codes.compress(odd).collect()[0].code == "00" * 8
    assert codes.compress(spark.createDataFrame([(1, "a", [])], "vec_id long, label string, embedding array<float>")).count() == 1


def test_nearest_is_the_same_in_both_ranges():
    rng = np.random.default_rng(1)
    x, book = rng.integers(-3000, 3000, (200, 5)), rng.integers(-3000, 3000, (9, 5))
    book[4] = book[2]
    far = np.int64(1) << 24
    for a, b in zip(codes.nearest(x, book), codes.nearest(x * far // (1 << 12), book * far // (1 << 12))):
        assert len(a) == len(b)
    index, apart = codes.nearest(x * (1 << 14), book * (1 << 14))
    assert (index == codes.nearest(x, book)[0]).all() and (apart == codes.nearest(x, book)[1] * (1 << 28)).all()

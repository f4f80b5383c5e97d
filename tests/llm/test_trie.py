import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tillcast.llm import queries, trie

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(r[2], r[4]) for r in sorted(own)] for c, own in by.items()}
    again = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        again[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in again.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0)
        below = [sums[k] for k in kids.get(path, [])]
        sums[path] = (sum(b[0] for b in below) if below else 1, own + sum(b[1] for b in below))
    out = []
    for path, own in members.items():
        done = sorted(c for c in own if len(again[c]) == len(path))
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(kids.get(path, [])), *sums[path],
                    hashlib.sha256(",".join(map(str, done)).encode()).hexdigest()))
    return sorted(out)


def run(spark, rows, local=trie.LOCAL):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = trie.prefix_trie(*trie.rebuilt(trie.numbered_turns(frame)), local)
    return sorted(tuple(r) for r in found.collect())


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    for c in range(-30, n):
        same = rng.choice([c, c // 7, 3])
        own = random.Random(same)
        length = own.randrange(7)
        for t in range(length):
            rows.append((c, t, own.choice(["user", "assistant", None]), own.choice(["a b", "a  b", "", None, "c d e", "f\ng"])))
        if rng.random() < 0.2:
            rows.append((c, None, "user", "first"))
        if rng.random() < 0.2:
            rows += [(c, 1, "user", rng.choice("xyz"))] * rng.randrange(3)
    return rows + [(None, 1, "user", "no id"), (10 ** 15, 0, None, None), (10 ** 15 + 21, 0, None, "lone")]


@pytest.mark.parametrize("seed, local", [(1, trie.LOCAL), (2, 12), (3, 1)])
def test_equals_brute_force(spark, seed, local):
    """With small components in tasks, and with rounds of joins only."""
    rows = conversations(seed, 150)
    assert run(spark, rows, local) == brute(rows)


def test_one_long_conversation_and_a_common_one(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "IDS", 2)
    rows = [(40, t, "user", f"t{t % 5} w") for t in range(300)]
    rows += [(c, t, "user", f"t{t % 5} w") for c in range(41, 60) for t in range(c)]
    rows += [(c, 0, "user", "hello there") for c in range(100, 180)]
    assert run(spark, rows, 50) == brute(rows)


def test_turnless_conversations_and_empty_table(spark):
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    assert run(spark, [(lone, 0, "user", "a")]) == brute([(lone, 0, "user", "a")]) == [
        (lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert run(spark, []) == []


def test_split_sums_equals_plain_sums():
    rng = np.random.default_rng(1)
    for shape in ("bush", "path", "star", "forest"):
        n = 400
        up = {"bush": [-1] + [int(rng.integers(0, i)) for i in range(1, n)], "path": list(range(-1, n - 1)),
              "star": [-1] + [0] * (n - 1), "forest": [int(rng.integers(-1, i)) if i else -1 for i in range(n)]}[shape]
        values = rng.integers(0, 9, (n, 2))
        plain, weight = values.copy(), np.ones(n, dtype=np.int64)
        for i in reversed(range(n)):
            if up[i] >= 0:
                plain[up[i]] += plain[i]
                weight[up[i]] += weight[i]
        assert (trie.split_sums(np.array(up), weight, values) == plain).all()


def test_rounds_halve_the_largest_component(spark, monkeypatch):
    """A path of turns, the deepest of forests, needs about as many rounds as its length has bits."""
    made = []
    real = trie.materialize
    monkeypatch.setattr(trie, "materialize", lambda frame, name: made.append(name) or real(frame, name))
    rows = [(20, t, "user", f"turn {t}") for t in range(64)]
    assert run(spark, rows, 4) == brute(rows)
    assert made.count("centres") <= 6


def test_query_ignores_other_columns(spark, tmp_path):
    rows = [(c, t, "user", f"x {t}", 1, "n") for c in range(5) for t in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA + ", depth int, node string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_centroid_trie(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == brute([r[:4] for r in rows])

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.oracle_check import compare, connect
from pyspark.sql import functions as F

from tillcast.llm import decontam, lines, queries, sharding


# line windows

def _brute_lines(docs):
    """Kept lines of each (id, text), by the definition."""
    windows = []
    solid = {}
    for i, t in docs:
        own = solid[i] = [(k, x.strip(" ")) for k, x in enumerate(t.split("\n")) if x.strip(" ")]
        size = min(3, len(own))
        windows += [(tuple(s for _, s in own[k:k + size]), i, k) for k in range(len(own) - size + 1) if own]
    first = {}
    for w, i, k in sorted(windows, key=lambda x: x[1:]):
        first.setdefault(w, (i, k))
    gone = set()
    for w, i, k in windows:
        if first[w] != (i, k):
            gone.update((i, solid[i][k + j][0]) for j in range(len(w)))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in docs}


def test_lines_against_brute_force(spark):
    rng = np.random.default_rng(0)
    docs = []
    for i in range(120):
        own = [f"line {x}" if x else rng.choice(["", "  "]) for x in rng.integers(0, 9, int(rng.integers(0, 14)))]
        docs.append((i, "\n".join(own)))
    out = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    expected = _brute_lines(docs)
    assert {r.doc_id: r.text for r in out} == expected
    for r in out:
        text = dict(docs)[r.doc_id]
        assert r.n_lines == (len(text.split("\n")) if text else 0)
        if r.n_removed < r.n_lines:
            assert r.n_removed == r.n_lines - len(r.text.split("\n"))


def test_a_repeated_passage_stays_whole_once(spark):
    passage = [f"passage line {i}" for i in range(6)]
    docs = [(i, "\n".join([f"own {i} a", f"own {i} b", *passage, f"own {i} c"])) for i in range(5)]
    out = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[0] == docs[0][1]
    assert all(out[i] == f"own {i} a\nown {i} b\nown {i} c" for i in range(1, 5))


def test_a_short_passage_goes_from_hosts_that_have_copies(spark):
    """Windows that mix a passage with its host occur first in the host, which does not keep the passage there."""
    passage = [f"passage line {i}" for i in range(3)]
    host = "\n".join(["own b a", *passage, "own b c"])
    docs = [(0, "\n".join(["own a", *passage, "end a"])), (1, host), (2, host)]
    out = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out == {0: docs[0][1], 1: "own b a\nown b c", 2: ""} == _brute_lines(docs)


def test_whole_copies_can_be_left_as_they_are(spark):
    text = "\n".join(f"some longer line {i} of the text" for i in range(20))
    docs = [(0, text), (1, text), (2, "x\n" + text), (3, text + "\n" + "new words " * 30), (4, None)]
    out = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), leave=0.9).collect()}
    assert [out[i].text for i in (0, 1, 2, 4)] == [docs[i][1] for i in (0, 1, 2, 4)]
    assert [out[i].n_removed for i in range(5)] == [0, 0, 0, 20, 0] and out[3].text == "new words " * 30


def test_lines_keep_other_columns_and_rows(spark, odd, none):
    out = lines.dedup_lines(odd)
    assert out.columns == [*odd.columns, "n_lines", "n_removed"]
    assert out.drop("text", "n_lines", "n_removed").exceptAll(odd.drop("text")).count() == 0 and out.count() == odd.count()
    by = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by[3].text is None and by[4].text == "" and by[3].n_lines == by[4].n_lines == 0
    null = [r for r in out.collect() if r.doc_id is None and r.text is not None]
    assert null[0].n_removed == 0 and by[1].n_removed == 4 and by[1].text == ""      # the null id comes first
    assert by[11].text == "\n\n\nonly\n\n" and by[9].n_lines == 4
    assert lines.dedup_lines(none).collect() == []


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    base = "/root/testdata/sf0.001"
    rows, problems = compare(spark, connect(base), base, queries.QUERIES[name], queries.SQL[name])
    assert rows and not problems, problems


# decontamination

def _words(t):
    return [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (t or "").encode())]


def _brute_matches(docs, items, least=0.8):
    found = {}
    for i, t in docs:
        x = _words(t)
        for j, u in items:
            y = _words(u)
            k = min(5, len(y))
            if not k or not x:
                continue
            want = Counter(tuple(y[a:a + k]) for a in range(len(y) - k + 1))
            for a in range(max(1, len(x) - len(y) + 1)):
                own = x[a:a + len(y)]
                have = Counter(tuple(own[b:b + k]) for b in range(len(own) - k + 1))
                low = sum((have & want).values())
                if low:
                    sure = low / (have.total() + want.total() - low)
                    if sure >= least:
                        found[i, j] = max(sure, found.get((i, j), 0))
    return found


def test_decontamination_against_all_windows(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"v{i}" for i in range(40)]
    words = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    items = [(j, " ".join(words(int(rng.integers(1, 60))))) for j in range(30)] + [(30, ""), (31, "…"), (32, "v1 v2")]
    docs = []
    for i in range(200):
        own = words(int(rng.integers(0, 120)))
        if i % 2:
            y = items[int(rng.integers(0, 30))][1].split()
            if rng.random() < 0.5 and len(y) > 12:
                y = y[:-int(rng.integers(1, 5))] if rng.random() < 0.5 else [*y[:3], "new", *y[3:]]
            at = int(rng.integers(0, len(own) + 1))
            own[at:at] = [w.upper() + "," if rng.random() < 0.3 else w for w in y]
        docs.append((i, " ".join(own)))
    found = decontam.find_matches(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    assert got == pytest.approx(_brute_matches(docs, items))
    blocks = decontam.find_matches(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(items, "item_id long, text string"), items=10)
    assert {(r.doc_id, r.item_id): r.similarity for r in blocks.collect()} == got


def test_hamming_tables_return_all_within_the_radius():
    rng = np.random.default_rng(2)
    index = decontam.Index(list(range(50)), [" ".join(f"w{x}" for x in rng.integers(0, 90, 30)) for _ in range(50)])
    items, own, _ = index.sizes[30]
    prints = own[rng.integers(0, 50, 400)].copy()
    for i in range(400):
        for bit in rng.choice(64, int(rng.integers(0, 30)), replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(bit)
    window, item = index.near(30, prints)
    expected = {(w, int(items[j])) for w in range(400) for j in range(50) if bin(int(prints[w] ^ own[j])).count("1") <= index.radius}
    assert set(zip(window.tolist(), item.tolist())) == expected and len(expected) > 150


def test_decontamination_edge_cases(spark, odd, none):
    items = spark.createDataFrame([(1, "ONE two; three four five six seven eight nine ten"), (1, "the second line here third line there"),
                                   (2, None), (3, " "), (None, "a")], "item_id long, text string")
    found = decontam.find_matches(odd, items).collect()
    same = [r.doc_id for r in odd.collect() if r.text and r.text.startswith("one two")]
    assert sorted(str(r.doc_id) for r in found if r.item_id == 1) == sorted(map(str, same))
    assert {r.doc_id for r in found if r.item_id is None} == {10}
    kept = decontam.clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - len(same) - 1
    nothing = items.limit(0)
    assert decontam.find_matches(odd, nothing).collect() == [] and decontam.clean(odd, nothing).count() == odd.count()
    assert decontam.find_matches(none, items).collect() == [] and decontam.clean(none, items).count() == 0


# sharding

def _check_shards(rows, docs, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(shards))
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(docs)
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


@pytest.mark.parametrize("wide", [1, 260])
def test_shards(spark, wide):
    rng = np.random.default_rng(4)
    docs = [(i, f"single {i}") for i in range(400)]
    docs += [(1000 + 10 * g + k, f"group {g}") for g in range(60) for k in range(int(rng.integers(2, 6)))]
    docs += [(5000 + i, "wide") for i in range(wide)]
    rows = sharding.shard(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), shards=8).collect()
    _check_shards(rows, docs, 8)
    shard = {r.doc_id: r.shard for r in rows}
    cut = [t for t in {t for _, t in docs} if t.startswith("group") and len({shard[i] for i, u in docs if u == t}) > 1]
    assert len(cut) <= 3
    runs = len({shard[i] for i, t in docs if t == "wide"})
    assert runs <= 1 + -(-wide * 8 // len(docs))


def _places(spark, tight):
    """Groups of links in shards by hash; with ``tight`` nearly all rows are linked."""
    rng = np.random.default_rng(11)
    rows = [(g, 3 * g + 1, int(s)) for g in range(90) for s in rng.integers(0, 6, int(rng.integers(2, 7)))]
    place = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, g long, h long, shard int")
    total = len(rows) + (1 if tight else 200)
    return place, rows, [total // 6 + (s < total % 6) for s in range(6)], total


@pytest.mark.parametrize("tight", [False, True])
def test_a_round_moves_groups_as_brute_force_does(spark, tight):
    place, rows, quota, _ = _places(spark, tight)
    for turn in range(3):
        marked = place.withColumn("chance", sharding._chance(turn)).withColumn(
            "ties", F.array(*[F.xxhash64("g", F.lit(s)) for s in range(6)])).collect()
        groups = {}
        for r in marked:
            groups.setdefault(r.g, []).append(r)
        wish = {g: max((sum(r.shard == s for r in m), m[0].ties[s], s) for s in {r.shard for r in m})[2] for g, m in groups.items()}
        come = [sum(wish[r.g] == s != r.shard for r in marked) for s in range(6)]
        stay = [sum(wish[r.g] == s == r.shard for r in marked) for s in range(6)]
        expected = {}
        for r in marked:
            to = wish[r.g]
            ratio = min(1.0, max(0.0, (quota[to] - stay[to]) / come[to])) if come[to] else 0.0
            expected[r.row] = to if r.chance < ratio else r.shard
        placed, wishing, _ = sharding.propagate(place, quota, turn)
        assert {r.row: r["shard"] for r in placed.collect()} == expected and wishing == sum(come)
        place = spark.createDataFrame([(i, *rows[i][:2], s) for i, s in expected.items()], place.schema)


def test_rounds_end_when_no_group_moves(spark):
    place, rows, quota, _ = _places(spark, tight=False)
    found, left = sharding.settle(place, quota, sharding.ROUNDS)
    shards = {}
    for r in found.collect():
        shards.setdefault(r.g, set()).add(r["shard"])
    cut = sum(len(s) > 1 for s in shards.values())
    assert left == 0 and cut == 0
    assert sharding.settle(place, quota, 0)[1] > 0      # what is left is counted


@pytest.mark.parametrize("tight", [False, True])
def test_quotas_are_filled_as_brute_force_does(spark, tight):
    place, rows, quota, total = _places(spark, tight)
    every = spark.range(total).select(F.col("id").alias("row"))
    run = F.when(F.col("row") % 7 == 0, 0).otherwise(1)
    found = {r.row: (r["shard"], r.slot) for r in sharding.fill(every, place, quota, run, 3).collect()}
    part = F.pmod(F.xxhash64("row"), F.lit(sharding.PARTS))
    marked = place.select("*", (F.pmod(F.xxhash64("g", "h"), F.lit(3)) * sharding.PARTS + part).alias("block")).collect()
    expected = {}
    for s, q in enumerate(quota):
        inside = sorted((r for r in marked if r["shard"] == s), key=lambda r: (r.block, r.g, r.h, r.row))
        expected |= {r.row: (s, k) for k, r in enumerate(inside[:q])}
    used = [sum(s == t for t, _ in expected.values()) for s in range(6)]
    places = [(s, k) for s, q in enumerate(quota) for k in range(used[s], q)]
    others = every.select("row", run.alias("run"), F.pmod(F.xxhash64("row"), F.lit(3)).alias("block")).collect()
    others = sorted((r for r in others if r.row not in expected), key=lambda r: (r.run, r.block, r.row))
    assert found == expected | {r.row: p for r, p in zip(others, places)} and len(others) == len(places)


def test_shards_edge_cases(spark, odd, none):
    _check_shards(sharding.shard(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()], 40)
    assert sharding.shard(none).collect() == []


def test_shards_use_dataframe_operations_only(spark, odd):
    plan = sharding.shard(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

import pytest

import corpus_pipeline
from tillcast.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables, with planted copies, passages and odd rows, and columns of their own."""
    base, out = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{base}/documents.parquet")
    good = docs.where("lang = 'en' and n_chars between 800 and 1500").orderBy("doc_id").limit(3).collect()
    item = spark.read.parquet(f"{base}/benchmark.parquet").orderBy("item_id").first().text
    extra = [(10_000 + i, r.text.replace(".", ",", 1), "en", "s", len(r.text)) for i, r in enumerate(good)]
    extra += [(10_010, good[0].text + "\n" + item, "en", "s", 0), (10_011, None, None, None, None), (None, "", "en", "s", 0)]
    docs.union(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{base}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.fixture(scope="module")
def results(spark, folder, tmp_path_factory):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_keep_columns_and_hand_on(results):
    for frame in results[1:5]:
        assert frame.columns == results[0].columns and frame.dtypes == results[0].dtypes
    counts = [frame.count() for frame in results[:5]]
    assert counts[0] > counts[1] == counts[2] > counts[3] > counts[4] > 0


def test_decisions(results):
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    quality, fresh, single, clean, packed = map(ids, results[1:])
    assert len({10_000, 10_001, 10_002} & quality) >= 2 and 10_010 in quality
    assert not {10_000, 10_001, 10_002} & single
    assert 10_010 in single and 10_010 not in clean
    assert packed == clean
    for r in results[2].where("n_chars is not null and doc_id < 10000").collect():
        assert r.n_chars == len(r.text)


def test_one_row_of_each_group_stays(spark, odd, folder):
    words = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(1, words("a")), (1, words("a")), (None, words("a")), (2, words("b")), (2, words("a")), (3, words("c")),
            (None, words("d")), (None, words("d")), (4, None), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(((r.doc_id, r.text) for r in corpus_pipeline.one_of_each(spark, docs, folder).collect()), key=str)
    assert left == sorted([(1, words("a")), (2, words("b")), (3, words("c")), (None, words("d")), (4, None), (4, None), (5, "")], key=str)
    assert corpus_pipeline.one_of_each(spark, odd, folder).columns == odd.columns


def test_run_gives_the_last_stage(spark, folder, results):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert corpus_pipeline.run(spark, folder).select(key).exceptAll(results[5].select(key)).count() == 0


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_dealt_operator_is_registered():
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None

"""A corpus pipeline: quality filter, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; extra columns pass through. Rows with nulls, empty texts, repeated rows and
empty tables are handled as the operators' modules say.
"""

from pyspark.sql import functions as F

from tillcast.llm import decontam, lines, minhash, packing, quality
from tillcast.session import materialize, shared_path


def _table(spark, base, name):
    return spark.read.parquet(f"{base}/{name}.parquet")


def good_quality(spark, docs, sf_dir):
    """Documents that the quality trees accept; fitted on labelled documents of ``docs``."""
    return quality.accepted(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


#: A document that would lose so much of its text to line dedup is a copy as a whole.
WHOLE_COPY = 0.9


def fresh_lines(spark, docs, sf_dir):
    """Documents without later occurrences of repeated three-line windows; ``n_chars`` follows.

    Whole copies keep their lines, so that near-dedup, which comes next, sees them as they
    are and can drop them, not an emptied or mutilated rest of them.
    """
    found = lines.dedup_lines(docs, lines_col="_t_lines", removed_col="_t_removed", leave=WHOLE_COPY)
    length = F.when(F.col("_t_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", length).select([F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark, docs, sf_dir):
    """One row of each group of near-duplicates, the first by id and place (five words, 0.8).

    Rows are numbered and linked by number, so repeated rows, rows without id and texts that
    share an id are rows of their own. Rows without id come last in a group.
    """
    rows = materialize(docs.withColumn("_t_row", F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(rows, id_col="_t_row").select(F.col("doc_id").alias("_t_at"), "component_id")
    found = materialize(found.join(rows.select("_t_row", "doc_id"), F.col("_t_at") == F.col("_t_row")), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("_t_row").alias("row"))
    first = found.groupBy(F.col("component_id").alias("_t_group")).agg(F.min(place).alias("first"), F.count("*").alias("many"))
    gone = found.join(first.where("many > 1"), F.col("component_id") == F.col("_t_group")).where("_t_row <> first.row")
    kept = rows.join(gone.select(F.col("_t_row").alias("_t_gone")), F.col("_t_row") == F.col("_t_gone"), "left_anti")
    return kept.select([F.col(f"`{c}`") for c in docs.columns])


def no_benchmark(spark, docs, sf_dir):
    """Documents that hold no passage of the benchmark."""
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark, docs, sf_dir):
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_quality), ("line dedup", fresh_lines), ("near-dedup", one_of_each),
    ("decontamination", no_benchmark), ("packing", packed),
]

#: Trees, signatures, fingerprints and token ids have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return found
        path = shared_path(spark, "stage")
        found.write.parquet(path)
        docs = spark.read.parquet(path)

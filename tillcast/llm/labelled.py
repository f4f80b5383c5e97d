"""Bounded samples of labelled documents, to fit classifiers on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000     # labelled documents that a classifier is fitted on, at most


def sample(documents: DataFrame, labels: DataFrame, label: str, *, rows=None, bound=SAMPLE, id_col="doc_id",
           text_col="text") -> DataFrame:
    """(text, label) of at most ``bound`` labelled documents, chosen by a hash of the id.

    ``rows`` is a condition on ``labels`` that says which may be learned from. Null ids
    and labels are left out; a document labelled twice counts once, as 1 if any label is.
    The chosen labels are few enough to broadcast by construction.
    """
    chosen = labels if rows is None else labels.where(rows)
    chosen = chosen.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("label")) \
        .where("_id is not null and label is not null")
    chosen = chosen.groupBy("_id").agg(F.max("label").alias("label")) \
        .orderBy(F.xxhash64("_id", F.lit(label)), "_id").limit(bound)
    return documents.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("text", "label")

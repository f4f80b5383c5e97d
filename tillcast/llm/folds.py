"""Folds by a hash of the id."""

from pyspark.sql import functions as F


def fold(divisor, id_col="doc_id"):
    """crc32 of the id as text, modulo ``divisor``; -1 for a null id, which is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor, F.lit(-1))

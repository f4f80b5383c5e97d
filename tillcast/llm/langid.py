"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased, runs of other characters than letters count as one space, and
every run of one to three characters is hashed into a fixed number of buckets. Counts per
language come from all training texts: each task adds up its own counts and Spark sums
them. The matrix of log-probabilities, languages times buckets, is broadcast (its size is
checked) and texts are scored in batches, as sums of gathered rows over each text.

Undefined and edge cases: a null text, or one without any letter, is ``und`` with score 0.
So is every text when nothing could be learned. Letters are Unicode's; every other text gets a learned language. Texts without a language are not learned
from. Equal scores go to the language that is first in alphabetical order. The score is
the posterior probability of the predicted language, with equal priors, over the mean of
the text's n-grams times ``evidence``. Repeated rows are scored one by one; every row
gives a row, whatever its id. An empty table gives an empty result.
"""

import sys
import unicodedata
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import text
from tillcast.session import materialize

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
EVIDENCE = 50.0              # n-grams that a text's mean counts for in the score, at most
MATRIX_BYTES = 256 << 20     # largest matrix that is broadcast
_PART = 1 << 20              # bytes of text per block


def characters(data):
    """Code points of UTF-8 bytes, lower-cased, and the byte where each starts."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.uint32)
    padded = np.concatenate([data, np.zeros(3, dtype=np.uint8)])
    tail = [padded[at + i].astype(np.uint32) & 0x3F for i in (1, 2, 3)]
    code = np.where(lead < 0xE0, (lead & 0x1F) << 6 | tail[0], np.where(
        lead < 0xF0, (lead & 0x0F) << 12 | tail[0] << 6 | tail[1],
        (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]))
    code = np.where(lead < 0x80, lead, code)
    upper = ((code >= 65) & (code <= 90)) | ((code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)) \
        | ((code >= 0x391) & (code <= 0x3A9)) | ((code >= 0x410) & (code <= 0x42F))
    return np.where(upper, code + np.uint32(32), code), at


@cache
def _is_letter():
    """Which code points are letters of Unicode."""
    return np.array([unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)])


def _letters(code, true):
    """Other characters than letters become a space; ``true`` letters count, and above Latin-1 all but general punctuation."""
    letter = ((code >= 97) & (code <= 122)) | ((code >= 0xAA) & (code != 0xD7) & (code != 0xF7) & (code != 0xAB) & (code != 0xBB))
    letter &= ~((code >= 0x2000) & (code <= 0x2BFF)) & ~((code >= 0x3000) & (code <= 0x303F))
    return np.where(letter | true, code, np.uint32(32))


def grams(data, offsets, orders=ORDERS, buckets=BUCKETS, lettered=None):
    """Blocks of (bucket, text) of all n-grams of all texts; blocks end between words.

    ``lettered``, an array of one flag per text, is set for the texts that hold a letter.
    """
    for a, b in text.blocks(data, offsets, text.PLAIN, _PART):
        code, at = characters(data[a:b])
        owner = np.searchsorted(offsets, at + a, side="right") - 1
        true = _is_letter()[code]
        if lettered is not None:
            lettered[owner[true]] = True
        code = _letters(code, true)
        keep = np.ones(len(code), dtype=bool)  # one space for a run of them
        keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (owner[1:] != owner[:-1])
        code, owner = code[keep].astype(np.uint64), owner[keep]
        for n in orders:
            if len(code) < n:
                continue
            key = np.full(len(code) - n + 1, np.uint64(n))
            for i in range(n):
                key = key * np.uint64(0x100000001B3 + 2 * 0x9E3779B9) + code[i:len(code) - n + 1 + i]
            key = text.mix(key)
            same = owner[:len(code) - n + 1] == owner[n - 1:]
            if n == 1:
                same = same & (code != 32)
            yield (key[same] & np.uint64(buckets - 1)).astype(np.int32), owner[:len(code) - n + 1][same]


def _counts(buckets):
    def counts(batches):
        total = {}
        for batch in batches:
            langs, names = pd.factorize(batch.column("lang").to_pandas())
            data, offsets = text.buffers(batch.column("text"))
            for name in names:
                total.setdefault(name, np.zeros(buckets, dtype=np.int64))
            for bucket, owner in grams(data, offsets, buckets=buckets):
                table = np.bincount(langs[owner].astype(np.int64) * buckets + bucket, minlength=len(names) * buckets)
                for i, name in enumerate(names):
                    total[name] += table[i * buckets:(i + 1) * buckets]
        for name, table in total.items():
            at = np.flatnonzero(table)
            yield pa.record_batch({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at.astype(np.int32)),
                                   "n": pa.array(table[at])})

    return counts


def train(documents: DataFrame, *, text_col="text", lang_col="lang", buckets=BUCKETS):
    """Languages in order and their log-probabilities (languages x buckets), from all rows."""
    rows = documents.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("lang is not null and text is not null")
    table = materialize(rows.mapInArrow(_counts(buckets), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")), "counts")
    langs = [r.lang for r in table.select("lang").distinct().limit(MATRIX_BYTES // (4 * buckets) + 1).collect()]
    if len(langs) * buckets * 4 > MATRIX_BYTES:
        raise ValueError(f"too many languages for a matrix of {MATRIX_BYTES} bytes; use fewer buckets")
    langs.sort()
    found = table.toPandas()
    counts = np.zeros((len(langs), buckets))
    counts[found["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64), found["bucket"]] = found["n"]
    counts += SMOOTHING
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _score(shared, buckets):
    def score(batches):
        langs, logs = shared.value
        names = np.array([*langs, "und"], dtype=object)
        for batch in batches:
            n = batch.num_rows
            data, offsets = text.buffers(batch.column("text"))
            total, seen, ok = np.zeros((len(langs), n)), np.zeros(n), np.zeros(n, dtype=bool)
            for bucket, owner in grams(data, offsets, buckets=buckets, lettered=ok) if langs else ():
                if not len(owner):
                    continue
                first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                own = owner[first]
                seen[own] += np.diff(np.concatenate([first, [len(owner)]]))
                for i in range(len(langs)):
                    total[i, own] += np.add.reduceat(logs[i][bucket], first, dtype=np.float64)
            best = np.where(ok, total.argmax(axis=0) if langs else 0, len(langs))
            if langs:
                gap = (total - total.max(axis=0)) * (np.minimum(seen, EVIDENCE) / np.maximum(seen, 1))
                sure = np.where(ok, 1 / np.exp(gap).sum(axis=0), 0.0)
            else:
                sure = np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()),
                 pa.array(sure, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return score


def predict(documents: DataFrame, model, *, held_out=None, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; ``held_out`` is passed through."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"),
        F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score(shared, model[1].shape[1]), "doc_id long, held_out boolean, lang_pred string, score double")

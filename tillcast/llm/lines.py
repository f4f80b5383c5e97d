"""Line dedup over overlapping windows of three lines.

Every run of three consecutive lines that are not blank is a window. Windows are hashed
(128 bits) and counted over the whole corpus; the first occurrence of a repeated window,
by document id and place, stays and all later ones are covered. The lines that later
windows cover are merged and removed, also where another window occurs there for the first
time: every removed line still stands at an earlier place.

All steps are DataFrame operations. A window that a third of all documents hold is summed
up before the shuffle and joined from one row, which adaptive execution splits.

Undefined and edge cases: lines are compared without spaces at their ends. A text with
one or two lines that are not blank is one shorter window, which matches only equal ones.
Blank lines are never removed. A null text stays null and an empty one empty, without
lines. A text whose lines are all covered becomes empty or blank; no row is ever dropped.
Rows with equal id and text are one document; a null id comes first in the order. Other
columns are kept as they are; columns named as the two counts are replaced. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialize

WINDOW = 3


def _solid(lines):
    """(place, hashes) of the lines that are not blank."""
    marked = F.transform(lines, lambda x, i: F.struct(i.alias("at"), F.trim(x).alias("s")))
    return F.transform(F.filter(marked, lambda x: x["s"] != ""), lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["s"]).alias("a"), F.xxhash64(F.lit(7), x["s"]).alias("b")))


def _windows(solid, size):
    """(first, hashes, size) of each window, as places among the lines that are not blank."""
    def window(i):
        lines = [F.get(solid, i + j) for j in range(size)]      # NULL beyond the last, which hashes skip
        return F.struct(i.alias("first"), F.xxhash64(*[x["a"] for x in lines]).alias("a"),
                        F.xxhash64(F.lit(7), *[x["b"] for x in lines]).alias("b"),
                        F.least(F.size(solid), F.lit(size)).alias("size"))

    return F.when(F.size(solid) > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(solid) - size, F.lit(0))), window))


def dedup_lines(documents: DataFrame, *, window: int = WINDOW, id_col="doc_id", text_col="text",
                lines_col="n_lines", removed_col="n_removed", leave=None) -> DataFrame:
    """``documents`` with shorter texts and the numbers of lines before and removed.

    With ``leave`` a text that would lose at least this share of its characters stays as it
    is: it is a copy as a whole, for whoever removes whole documents.
    """
    text = F.col(text_col)
    key, mark = F.col(id_col).alias("_t_id"), F.xxhash64(text).alias("_t_text")
    cut = F.split(text, "\n", -1)
    found = documents.select(key, mark, _solid(cut).alias("solid")).select(
        "_t_id", "_t_text", F.explode(_windows(F.col("solid"), window)).alias("w"))
    found = materialize(found.select("_t_id", "_t_text", "w.first", "w.size", "w.a", "w.b"), "windows")
    place = F.struct("_t_id", "_t_text", "first")
    many = found.groupBy(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("size").alias("_size")).agg(
        F.min(place).alias("_from"), F.max(place).alias("_to")).where(~F.col("_from").eqNullSafe(F.col("_to")))
    again = found.join(many, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")) & (F.col("size") == F.col("_size")))
    span = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("size") - 1)).alias("at")
    covered = again.where(~place.eqNullSafe(F.col("_from"))).select("_t_id", "_t_text", span).distinct() \
        .groupBy(F.col("_t_id").alias("_t_doc"), F.col("_t_text").alias("_t_same")).agg(
            F.sort_array(F.collect_list("at")).alias("_t_gone"))
    # a hash join leaves the texts unsorted; what is covered is small beside them
    joined = documents.withColumn("_t_hash_", F.xxhash64(text)).join(
        covered.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("_t_doc")) & (F.col("_t_hash_") == F.col("_t_same")), "left")
    kinds = dict(documents.dtypes)
    left = F.when(F.col("_t_gone").isNull(), text).otherwise(_without(text, F.col("_t_gone")))
    joined = joined.withColumn("_t_left", left)
    stays = F.col("_t_gone").isNull()
    if leave is not None:
        stays = stays | (F.length("_t_left") <= (1 - leave) * F.length(text))
    columns = [F.when(stays, text).otherwise(F.col("_t_left")).cast(kinds[c]).alias(c)
               if c == text_col else F.col(f"`{c}`") for c in documents.columns if c not in (lines_col, removed_col)]
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    lines = F.when(F.length(text) > 0, breaks + 1).otherwise(0).cast("long")
    return joined.select(*columns, lines.alias(lines_col), F.when(stays, 0).otherwise(F.size("_t_gone")).cast("long").alias(removed_col))


def _without(text, gone):
    """The text without the given places (sorted) among its lines that are not blank."""
    lines = F.split(text, "\n", -1)
    solid = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("at"), F.trim(x).alias("s"))), lambda x: x["s"] != "")
    # the kept lines are the runs between removed ones
    cuts = F.transform(gone, lambda i: F.get(solid, i)["at"])
    whole = F.struct(lines.alias("lines"), cuts.alias("cuts"))

    def kept(w):
        runs = F.transform(F.sequence(F.lit(0), F.size(w["cuts"])), lambda j: F.struct(
            F.when(j == 0, 0).otherwise(F.get(w["cuts"], j - 1) + 1).alias("lo"),
            F.coalesce(F.get(w["cuts"], j), F.size(w["lines"])).alias("hi")))
        return F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(w["lines"], r["lo"] + 1, r["hi"] - r["lo"]))), "\n")

    return F.get(F.transform(F.array(whole), kept), F.lit(0))   # lines and cuts are worked out once


SQL = """
WITH l AS (
  SELECT doc_id, i - 1 AS place, t.line AS line, trim(t.line, ' ') AS s
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) t),
solid AS (
  SELECT doc_id, place, s, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS p,
         count(*) OVER (PARTITION BY doc_id) AS n,
         lead(s, 1) OVER (PARTITION BY doc_id ORDER BY place) AS s1, lead(s, 2) OVER (PARTITION BY doc_id ORDER BY place) AS s2
  FROM l WHERE s <> ''),
win AS (
  SELECT doc_id, p, least(n, 3) AS size, [s, s1, s2] AS w FROM solid WHERE p <= greatest(n - 3, 0)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY size, w ORDER BY doc_id, p) AS k, count(*) OVER (PARTITION BY size, w) AS m FROM win),
gone AS (
  SELECT doc_id, q FROM (SELECT doc_id, k, unnest(range(p, p + size)) AS q FROM ranked WHERE m > 1)
  GROUP BY doc_id, q HAVING max(k) > 1),
lost AS (SELECT s.doc_id, s.place FROM solid s JOIN gone g ON s.doc_id = g.doc_id AND s.p = g.q),
kept AS (
  SELECT l.doc_id, string_agg(CASE WHEN x.place IS NULL THEN line END, chr(10) ORDER BY l.place) AS text,
         count(*) AS n, count(x.place) AS r
  FROM l LEFT JOIN lost x ON l.doc_id = x.doc_id AND l.place = x.place GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN length(d.text) > 0 THEN k.n ELSE 0 END AS n_lines, coalesce(k.r, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

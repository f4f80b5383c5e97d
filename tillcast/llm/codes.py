"""Vector code compression: product codes from a member-resident Lloyd iteration.

Vectors become whole numbers and are cut into equal parts. The parts are members of the
owner (position, entry) whose entry is nearest, and they live with it: the first round
deals every part to its owner, salted, so that an entry that attracts a third of all parts
is shared by many tasks. In every later round each owner checks its members where they
lie. Members that stay are summed there and sent nowhere; only members whose nearest entry
has changed go through the shuffle, to their new owner, as one more segment of the
written state. A member of an older segment is still resident if every codebook since has
sent it to the same entry, which its owner works out anew, so no segment is ever rewritten
and a lost executor costs a re-read.

The codebooks (entries x vector length numbers) are the only data on the driver and in
the tasks besides a batch. All arithmetic is on whole numbers, so sums do not depend on
the order of rows.

Undefined and edge cases: a vector that is null or holds a null or non-finite component
is dropped, and so is one that has another length than the vector of the smallest id. A
length that the number of parts does not divide is filled up with zeros at the end.
Numbers are held within the range in which every error fits in a long. Ids may be null
(last in the order) or repeat (equal ids stand in order of their vectors); every row is
coded. With fewer rows than entries there are fewer entries. A sum of errors beyond a long
is the largest long. Other columns are not read. An empty table gives an empty result.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MEMBERS = 50_000        # members of an owner that one salt holds, about

STATE = "pos int, entry int, many long, moved boolean, since int, part array<long>"
_STATE = pa.schema([("pos", pa.int32()), ("entry", pa.int32()), ("many", pa.int64()), ("moved", pa.bool_()),
                    ("since", pa.int32()), ("part", pa.list_(pa.int64()))])


class _Shape:
    """How a vector of ``size`` components becomes ``parts`` parts of whole numbers."""

    def __init__(self, size, parts, scale):
        self.size, self.parts, self.scale = size, parts, scale
        self.width = -(-size // parts)
        self.most = math.isqrt(((1 << 63) - 1) // max(1, size)) // 2

    def cut(self, column, rows):
        """Parts (rows, parts, width) of a column of vectors."""
        found = column.flatten().to_numpy(zero_copy_only=False).reshape(rows, self.size)
        whole = np.zeros((rows, self.parts * self.width), dtype=np.int64)
        whole[:, :self.size] = np.clip(np.floor(found * float(self.scale)), -self.most, self.most)
        return whole.reshape(rows, self.parts, self.width)


def nearest(parts, book):
    """The nearest entry of each part (the first of equal ones) and its squared distance, exactly."""
    most = max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0))
    if 4 * parts.shape[1] * int(most) ** 2 < 1 << 53:           # whole numbers that doubles hold exactly
        x, c = parts.astype(np.float64), book.astype(np.float64)
        apart = (c * c).sum(1) - 2 * (x @ c.T)
        best = apart.argmin(1)
        return best, (apart[np.arange(len(x)), best] + (x * x).sum(1)).astype(np.int64)
    best, least = np.zeros(len(parts), dtype=np.int64), None
    for e, entry in enumerate(book):
        apart = ((parts - entry) ** 2).sum(1)
        if least is None:
            least = apart
        else:
            best, least = np.where(apart < least, e, best), np.minimum(apart, least)
    return best, least


def _rows(pos, entry, many, moved, since, parts):
    n, width = parts.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(parts.ravel()))
    fill = lambda value, kind: pa.array(np.broadcast_to(value, n).astype(kind))
    return pa.record_batch([fill(pos, "i4"), fill(entry, "i4"), fill(many, "i8"), fill(moved, bool), fill(since, "i4"), lists],
                           schema=_STATE)


def _deal(shape, book):
    """Every part with its first owner."""
    def deal(batches):
        for batch in batches:
            parts = shape.cut(batch.column("vector"), batch.num_rows)
            for pos in range(shape.parts):
                own = np.ascontiguousarray(parts[:, pos])
                yield _rows(pos, nearest(own, book[pos])[0], 1, True, 0, own)

    return deal


def _check(shape, books):
    """The sums of the members that stay under the last codebook, and the members that leave."""
    now = len(books) - 1

    def check(batches):
        sums = np.zeros((*books[0].shape[:2], shape.width + 1), dtype=np.int64)
        for batch in batches:
            pos, entry, since = (batch.column(c).to_numpy() for c in ("pos", "entry", "since"))
            parts = batch.column("part").flatten().to_numpy().reshape(batch.num_rows, shape.width)
            for p in range(shape.parts):
                at = np.flatnonzero(pos == p)
                for book in range(1, now):                  # whoever left before lies in a later segment
                    old = since[at] < book
                    at = at[~old | (nearest(parts[at], books[book][p])[0] == entry[at])]
                to = nearest(parts[at], books[now][p])[0]
                stay = to == entry[at]
                np.add.at(sums[p], to[stay], np.column_stack([np.ones(stay.sum(), dtype=np.int64), parts[at[stay]]]))
                if not stay.all():
                    yield _rows(p, to[~stay], 1, True, now, parts[at[~stay]])
        p, e = np.nonzero(sums[..., 0])
        if len(p):
            yield _rows(p, e, sums[p, e, 0], False, now, sums[p, e, 1:])

    return check


def _means(members, book):
    """The next codebook: floors of the means of all members, old entries where there are none."""
    columns = [F.sum(F.get("part", F.lit(i))).alias(f"x{i}") for i in range(book.shape[2])]
    out = book.copy()
    for row in members.groupBy("pos", "entry").agg(F.sum("many").alias("many"), *columns).collect():
        out[row.pos, row.entry] = [row[f"x{i}"] // row.many for i in range(book.shape[2])]
    return out


def _vectors(rows, vector_col):
    kept = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.withColumn("vector", F.col(vector_col).cast("array<double>")).where(F.col("vector").isNotNull() & kept)


def train(vectors: DataFrame, *, parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE, id_col="vec_id",
          vector_col="embedding"):
    """(shape, codebooks of shape (parts, entries, width)) after ``rounds`` rounds, or None without vectors."""
    rows = _vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("given")), "given")
    place = F.struct(F.col("id").isNull(), "id", "vector")
    size = rows.agg(F.count("*").alias("rows"), F.min_by(F.size("vector"), place).alias("size")).first()
    if not size.rows:
        return None
    rows, shape = rows.where(F.size("vector") == size["size"]), _Shape(size["size"], parts, scale)
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    seeds = pa.array([r.vector for r in seeds], pa.list_(pa.float64()))
    books = [np.ascontiguousarray(shape.cut(seeds, len(seeds)).transpose(1, 0, 2))]
    salts = max(1, -(-size.rows // MEMBERS))
    segments = []
    for turn in range(rounds):
        if not segments:
            found = rows.select("vector").mapInArrow(_deal(shape, books[0]), STATE)
        else:
            members = segments[0]
            for segment in segments[1:]:
                members = members.unionByName(segment)
            found = members.mapInArrow(_check(shape, books), STATE)
        salted = found.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
        found = materialize(salted.repartition("pos", "entry", "_salt").drop("_salt"), "members")
        segments.append(found.where("moved"))
        books.append(_means(found, books[-1]))
    return shape, books[-1]


def compress(vectors: DataFrame, *, parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE, id_col="vec_id",
             vector_col="embedding", label_col="label") -> DataFrame:
    """One row per kept vector: id, code, error, error of all vectors with its label, digest of the codebooks."""
    given = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("given"))
    kinds = dict(given.dtypes)
    fitted = train(vectors, parts=parts, entries=entries, rounds=rounds, scale=scale, id_col=id_col, vector_col=vector_col)
    if fitted is None:
        empty = f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    shape, book = fitted
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()

    def code(batches):
        for batch in batches:
            cut = shape.cut(batch.column("vector"), batch.num_rows)
            found = [nearest(np.ascontiguousarray(cut[:, p]), book[p]) for p in range(shape.parts)]
            marks = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
            error = np.sum([f[1] for f in found], axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes().hex() for row in marks], pa.string()),
                 pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    rows = _vectors(given, "given").where(F.size("vector") == shape.size).select("vec_id", "label", "vector")
    coded = materialize(rows.mapInArrow(
        code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    labels = coded.groupBy(F.col("label").alias("_label")).agg(total.cast("long").alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql():
    steps = ["""
kept AS (SELECT vec_id, label, embedding FROM embeddings
         WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, list_transform(embedding[p * (len(embedding) // 8) + 1 : (p + 1) * (len(embedding) // 8)],
         lambda x: CAST(floor(4096.0 * x) AS BIGINT)) AS v FROM kept, range(8) r(p)),
b0 AS MATERIALIZED (
  SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 16)"""]
    apart = "list_sum(list_transform(list_zip(t.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(v) AS v, min(d * 16 + e) % 16 AS e, min(d) AS d
  FROM (SELECT t.vec_id, t.label, t.p, t.v, b.e, {apart} AS d FROM parts t JOIN b{i} b ON t.p = b.p) GROUP BY vec_id, label, p)""")
        if i < ROUNDS:
            steps.append(f"""
m{i} AS (
  SELECT p, e, list(CAST(m AS BIGINT) ORDER BY i) AS v
  FROM (SELECT p, e, i, floor(sum(x) / count(*)) AS m
        FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{i}) GROUP BY p, e, i) GROUP BY p, e),
b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN m{i} m ON b.p = m.p AND b.e = m.e)""")
    return "WITH" + ",".join(steps) + f""",
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id, label),
book AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
         FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM b{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, book
"""


SQL = _sql()

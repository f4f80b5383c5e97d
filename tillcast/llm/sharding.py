"""Shards by balanced label propagation over linked documents.

Documents with equal texts are linked. Each linked document starts in a shard by hash. In
every round each group of linked documents counts its members per shard, and members move
towards the shard that holds most of them, as far as the shard's quota admits; groups are
admitted whole. Rounds go on until no group wishes to move or none is admitted, ``ROUNDS``
at most; documents that still wished to move then are logged. Documents without links then fill the shards up to their quotas, so the
numbers of rows are at most one apart, and a group is cut only where it must be.

A group of more than half a shard takes no part in the rounds: it is laid out in one run
over as many shards as it needs. There are fewer than two such groups per shard.

Only DataFrame operations are used. Groups are summed up before each shuffle; the joins
back to their members have one row per group on one side, so a group that holds a third of
all rows is split by adaptive execution. What comes to the driver is a table of shards.

Undefined and edge cases: a null text is empty, and empty texts are equal. Every row gets
a shard, rows without id or with a repeated one as well. Other columns are not read. With
fewer rows than shards some shards stay empty. An empty table gives an empty result.
"""

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import numbering
from tillcast.session import materialize

SHARDS = 40
ROUNDS = 20     # at most; full shards turn groups away, which try again
PARTS = 16      # blocks that one group is numbered in


log = logging.getLogger(__name__)


def _by_shard(values, column, kind="double"):
    """A literal table over shards as an expression."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), column)


def _chance(turn):
    """A number from 0 to 1 for each group, another one in each round."""
    return F.pmod(F.xxhash64("g", "h", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))


def propagate(place: DataFrame, quota: list, turn: int):
    """One round over (row, g, h, shard): the new places, the rows that wish to move, and whether any may.

    A group wishes for the shard that holds most of it, equal numbers by hash. A shard admits
    the part of the groups that come for which it has room beside the rows that stay.
    """
    held = place.groupBy("g", "h", "shard").agg(F.count("*").alias("n"))
    wish = held.groupBy(F.col("g").alias("_g"), F.col("h").alias("_h")).agg(F.max(F.struct(
        "n", F.xxhash64("g", "shard").alias("tie"), "shard")).alias("_most")).select("_g", "_h", F.col("_most.shard").alias("to"))
    moving = materialize(place.join(wish, (F.col("g") == F.col("_g")) & (F.col("h") == F.col("_h"))).drop("_g", "_h"), "moving")
    away = F.col("to") != F.col("shard")
    there = {r.to: r for r in moving.groupBy("to").agg(
        F.count(F.when(away, 1)).alias("come"), F.count(F.when(~away, 1)).alias("stay")).collect()}     # one row per shard
    come = [there[s].come if s in there else 0 for s in range(len(quota))]
    stay = [there[s].stay if s in there else 0 for s in range(len(quota))]
    admit = [min(1.0, max(0.0, (q - n) / c)) if c else 0.0 for q, n, c in zip(quota, stay, come)]
    placed = moving.select("row", "g", "h", F.when(
        _chance(turn) < _by_shard(admit, F.col("to")), F.col("to")).otherwise(F.col("shard")).alias("shard"))
    return placed, sum(come), any(admit)


def settle(place: DataFrame, quota: list, rounds: int):
    """Rounds until no group moves: the places and the number of rows that still wish to move."""
    for turn in range(rounds):
        placed, wishing, admitted = propagate(place, quota, turn)
        if not wishing or not admitted:
            return place, wishing
        place = materialize(placed, "place")
    return place, propagate(place, quota, rounds)[1]


def fill(rows: DataFrame, place: DataFrame, quota: list, run, blocks: int) -> DataFrame:
    """(row, shard, slot): placed rows first, up to each shard's quota; the others fill what is left, run by run."""
    numbered = numbering.running_sum(
        place.withColumn("block", F.pmod(F.xxhash64("g", "h"), F.lit(blocks)) * PARTS + F.pmod(F.xxhash64("row"), F.lit(PARTS)))
        .withColumn("one", F.lit(1)), "shard", "block", ["g", "h", "row"], "one", "slot")
    settled = materialize(numbered.where(F.col("slot") < _by_shard(quota, F.col("shard"), "long")).select("row", "shard", "slot"), "settled")
    used = {r["shard"]: r.n for r in settled.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    room = [q - used.get(s, 0) for s, q in enumerate(quota)]
    upto = [sum(room[:s + 1]) for s in range(len(quota))]
    free = rows.select("row", run.alias("run")).join(settled.select(F.col("row").alias("_row")), F.col("row") == F.col("_row"), "left_anti")
    free = free.withColumn("block", F.col("run") * blocks + F.pmod(F.xxhash64("row"), F.lit(blocks))) \
        .withColumn("one", F.lit(1)).withColumn("all", F.lit(0))
    free = numbering.running_sum(free, "all", "block", ["row"], "one", "place")
    to = F.size(F.filter(F.array(*[F.lit(u).cast("long") for u in upto]), lambda u: u <= F.col("place")))
    free = free.withColumn("shard", to).select(
        "row", "shard", (F.col("place") - _by_shard([u - r for u, r in zip(upto, room)], F.col("shard"), "long")
                         + _by_shard([used.get(s, 0) for s in range(len(quota))], F.col("shard"), "long")).alias("slot"))
    return settled.union(free)


def shard(documents: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialize(documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g"), F.xxhash64(F.lit(7), text).alias("h")), "rows")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    blocks = numbering.block_count(total)
    groups = materialize(rows.groupBy("g", "h").agg(F.count("*").alias("n")).where("n > 1"), "groups")
    wide = groups.where(F.col("n") > max(quota[-1] // 2, 1)).orderBy("g", "h").select("g", "h").collect()  # < 2 per shard
    spread = F.coalesce(*[F.when((F.col("g") == w.g) & (F.col("h") == w.h), i) for i, w in enumerate(wide)], F.lit(len(wide)))
    spread = spread.cast("int")
    linked = rows.join(groups.select(F.col("g").alias("_g"), F.col("h").alias("_h")),
                       (F.col("g") == F.col("_g")) & (F.col("h") == F.col("_h")), "left_semi").where(spread == len(wide))
    place = materialize(linked.select("row", "g", "h", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")), "place")
    place, left = settle(place, quota, rounds)
    if left:
        log.warning("%d of %d documents wished for a shard that had no room", left, total)
    found = fill(rows, place, quota, spread, blocks).select(F.col("row").alias("_row"), "shard", "slot")
    return rows.join(found, F.col("row") == F.col("_row")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

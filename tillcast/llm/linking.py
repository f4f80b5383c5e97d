"""From shared keys to verified links to connected components, all as Spark joins.

Candidates are rows that share a key (a band of a signature, a table of a code). A key
may hold a third of all rows, so pairs within a key are never listed: each row is first
held against one pivot of its key, and links found that way merge rows into components.
Where a key still holds several components, the rows outside its largest one are held
against all that share it, in tiles of bounded size that return links only.

Two rows in one component need no test, as only the components are asked for. No pair of
rows that share a key and lie in different components is left untested.
"""

import itertools

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialize

PIVOT_ROUNDS = 2
TILE = 256      # rows of one side of a tile


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (id, comp): the smallest id that each id reaches.

    Every round each component hooks onto its smallest neighbour, chains of hooks are
    followed by self-joins, and edges are contracted, so the edge table shrinks by a
    constant factor at least. Tables are written each round.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    label = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("id"), F.least("a", "b").alias("up"))
        hook = materialize(hook, "hooks")
        while True:
            above = hook.select(F.col("id").alias("_id"), F.col("up").alias("_up"))
            further = hook.join(above, F.col("up") == F.col("_id")).select(
                "id", F.col("_up").alias("up"), (F.col("_up") != F.col("up")).alias("moved"))
            further = materialize(further, "hooks")
            moved = not further.where("moved").isEmpty()
            hook = further.select("id", "up")
            if not moved:
                break
        if label is None:
            label = hook.select("id", F.col("up").alias("comp"))
        else:
            label = label.join(hook.select(F.col("id").alias("_id"), "up"), F.col("comp") == F.col("_id"), "left") \
                .select("id", F.coalesce("up", "comp").alias("comp"))
        label = materialize(label, "labels")
        for side in ("a", "b"):
            edges = edges.join(hook.select(F.col("id").alias("_id"), "up"), F.col(side) == F.col("_id"), "left") \
                .withColumn(side, F.coalesce("up", side)).drop("_id", "up")
        edges = materialize(edges.where("a <> b").distinct(), "edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("comp")) if label is None else label


def link(keys: DataFrame, near, verify, load, kernel, tile: int = TILE) -> DataFrame:
    """Components of the rows of ``keys`` (key, id and columns for ``near`` and ``kernel``).

    ``near(x, y)`` is a cheap condition that no link fails, on functions from column names
    to columns; ``load(ids)`` gives what links are tested on, as a written table (id, load),
    and is asked once; ``verify(pairs, loads)`` returns the pairs (a, b) that are links;
    ``kernel(left, right)`` takes two pandas frames of rows with their load and returns the
    matrix of links between them. Joins with loads are merge joins at every size. A row
    that shares no key with another may be missing from the result (id, comp): it is its
    own component.
    """
    extra = [c for c in keys.columns if c not in ("key", "id")]
    many = keys.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("key").alias("_key"))
    keys = materialize(keys.join(many, F.col("key") == F.col("_key")).drop("_key"), "keys")
    if keys.isEmpty():
        return keys.select("id", F.col("id").alias("comp"))
    loads = load(keys.select("id").distinct()).hint("merge")
    edges = comps = None
    for turn in range(PIVOT_ROUNDS):
        members = keys if comps is None else _undecided(keys, comps)
        if comps is not None and members.isEmpty():
            return comps
        row = F.struct("id", *extra, *([] if comps is None else ["comp"]))
        pivots = members.groupBy(F.col("key").alias("_key")).agg(
            F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), row.alias("p"))).alias("_p"))
        pairs = members.join(pivots, F.col("key") == F.col("_key")).where(F.col("id") != F.col("_p.p.id"))
        if comps is not None:
            pairs = pairs.where(F.col("comp") != F.col("_p.p.comp"))
        pairs = pairs.where(near(lambda c: F.col(c), lambda c: F.col(f"_p.p.{c}"))).select(
            F.least("id", "_p.p.id").alias("a"), F.greatest("id", "_p.p.id").alias("b"))
        found = verify(materialize(pairs.distinct(), "pairs"), loads)
        edges = found if edges is None else edges.union(found)
        edges = materialize(edges, "links")
        comps = components(edges)
    members = _undecided(keys, comps)
    if members.isEmpty():
        return comps
    return components(edges.union(_rest(materialize(members, "members"), extra, loads, kernel, tile)))


def _rest(members, extra, loads, kernel, tile):
    """Links between components that share a key, by tiles.

    The rows outside a key's largest component are gathered by that component. Every pair
    that shares an undecided key is then a gathered row and a row of the component, or
    two rows gathered by the same component.
    """
    held = members.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = held.groupBy(F.col("key").alias("_key")).agg(F.max(F.struct("n", -F.col("comp"))).alias("_m")).select(
        "_key", (-F.col("_m.col2")).alias("home"))
    outside = members.join(main, F.col("key") == F.col("_key")).where("comp <> home") \
        .select("home", "id", "comp", *extra).distinct().withColumn("outer", F.lit(True))
    outside = materialize(outside, "outside")
    homes = outside.select(F.col("home").alias("_home")).distinct()
    inside = members.select("id", "comp", *extra).distinct().join(homes, F.col("comp") == F.col("_home")) \
        .select(F.col("_home").alias("home"), "id", "comp", *extra, F.lit(False).alias("outer"))
    rows = materialize(outside.union(inside), "gathered")
    blocks = lambda n: F.ceil(n / F.lit(tile)).cast("int")
    sizes = rows.groupBy(F.col("home").alias("_home")).agg(
        blocks(F.count(F.when(F.col("outer"), 1))).alias("_i"), blocks(F.count("*")).alias("_j"))
    rows = rows.join(sizes, F.col("home") == F.col("_home"))
    place = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    left = F.when(F.col("outer"), F.transform(upto(F.col("_j")), lambda j: F.struct(
        place(F.col("_i")).alias("i"), j.alias("j"), F.lit(True).alias("left"))))
    right = F.transform(upto(F.col("_i")), lambda i: F.struct(
        i.alias("i"), place(F.col("_j")).alias("j"), F.lit(False).alias("left")))
    dealt = rows.withColumn("t", F.explode(F.concat(F.coalesce(left, F.filter(right, lambda x: F.lit(False))), right))).select(
        F.xxhash64("home", "t.i", "t.j").alias("tile"), "t.left", "id", "comp", *extra)
    dealt = dealt.join(loads.select(F.col("id").alias("_id"), "load").hint("merge"), F.col("id") == F.col("_id")).drop("_id")
    dealt = dealt.repartition("tile").sortWithinPartitions("tile")

    def test(batches):
        for frame in runs(batches, "tile"):
            left, right = frame[frame["left"]], frame[~frame["left"]]
            near = kernel(left, right)
            mine, theirs = left["comp"].to_numpy(), right["comp"].to_numpy()
            near &= mine[:, None] != theirs
            i, j = near.nonzero()
            pairs = pd.DataFrame({"a": left["id"].to_numpy()[i], "b": right["id"].to_numpy()[j], "c": theirs[j]})
            yield pairs.drop_duplicates(["a", "c"])[["a", "b"]]     # one link to a component will do

    return dealt.mapInPandas(test, "a long, b long")


def runs(batches, key):
    """Batches sorted by ``key`` as one frame per value of it."""
    held = None
    for frame in itertools.chain(batches, [None]):
        if frame is not None:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            change = (held[key] != held[key].iloc[-1]).to_numpy().nonzero()[0] if len(held) else []
            cut = int(change[-1]) + 1 if len(change) else 0
            ready, held = held.iloc[:cut], held.iloc[cut:]
        else:
            ready = held
        if ready is not None and len(ready):
            yield from (own for _, own in ready.groupby(key, sort=False))


def _undecided(keys, comps):
    """The members of keys that hold rows of several components, with their component."""
    members = keys.join(comps.select(F.col("id").alias("_id"), "comp"), F.col("id") == F.col("_id"), "left") \
        .withColumn("comp", F.coalesce("comp", "id")).drop("_id")
    # a key of two rows was decided by its pivot
    open_ = members.groupBy(F.col("key").alias("_key")).agg(
        F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count("*").alias("_n"))
    return members.join(open_.where("_lo <> _hi and _n > 2").select("_key"), F.col("key") == F.col("_key")).drop("_key")


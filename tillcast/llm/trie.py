"""Conversation prefix trie, rolled up by centroid decomposition.

A conversation is a path of turns, and equal prefixes are one node. A prefix is known by
the exclusive or of its turns' hashes, each hashed with its place, so prefixes of any
length come from running sums over blocks of turns; places come from a range-partitioned
sort. A conversation of any length is thus spread over many tasks. A node is named by its
smallest member and its depth; ``members`` lists the node of every conversation at every
depth.

Rollup: the forest of parent edges is split at centroids. Of each component, the centroid
is the deepest node that holds more than half of the component's weight, where a node
weighs as many conversations as pass it: the weights of whole subtrees then follow from
the lengths of the members, and each split at least halves them, however deep or wide the
forest is. What lies below the centroid is summed up, and that total is added to every
node on the path from the centroid up to the component's top. The centroid leaves, its
children become tops of components of their own, and the path's weights shrink by what
was cut off. A component that is small enough is finished by one task in the same way;
larger ones go through another round of joins. Rounds grow with the logarithm of the
number of turns.

Undefined and edge cases: rows without conversation id belong to none. Turns of equal
number (or without one, which come first) stand in order of role and of the digest of
their text; repeated rows are turns of their own. Null role and text are empty. Ids are
whole numbers. Other columns are not read. An empty table gives an empty result.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import materialize

LOCAL = 20_000          # nodes of a component that one task finishes
BLOCK = 4096            # turns of a conversation that one running sum sees
IDS = 12                # ids that agree but for so many bits are listed together
WORD = r"[^\x20\x09-\x0D]+"
VALUES = ["leaves", "saved"]


def numbered_turns(conversations: DataFrame, *, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(conv, at, one, two, words): every turn with its place from 0, two hashes and its words."""
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    digest = F.md5(text.cast("binary"))
    turns = materialize(conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), digest.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row")), "turns")
    order = ["conv", "turn", "role", "digest", "row"]
    # numbers within a partition follow its order, and partitions follow one another
    placed = materialize(turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.xxhash64("role", "digest").alias("one"), F.xxhash64(F.lit(7), "role", "digest").alias("two"), "words",
        F.monotonically_increasing_id().alias("place")), "sorted")
    part = F.shiftright("place", 33).alias("_part")
    runs = placed.groupBy("conv", part).agg(F.min("place").alias("_first"), F.count("*").alias("_many"))
    before = Window.partitionBy("conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("conv").alias("_conv"), "_part", (F.col("_first") - F.coalesce(F.sum("_many").over(before), F.lit(0))).alias("_from"))
    joined = placed.join(runs, (F.col("conv") == F.col("_conv")) & (F.shiftright("place", 33) == F.col("_part")))
    return joined.select("conv", (F.col("place") - F.col("_from")).alias("at"), "one", "two", "words")


def rebuilt(turns: DataFrame, spread=20, heads=4):
    """(convs, turns) of conversations that open with turns of the first conversation of their group of ids.

    A conversation's head is as long as a hash of its id says; it comes from the
    conversation whose id is the next multiple of ``spread`` towards zero.
    """
    turns = materialize(turns, "turns")
    sizes = turns.groupBy("conv").agg(F.count("*").alias("own"))
    base = F.col("conv") - F.col("conv") % spread
    convs = sizes.select("conv", "own", base.alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("cut"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("own").alias("_own")), "base", "left").select(
        "conv", "base", "cut", F.least("cut", F.coalesce("_own", F.lit(0))).alias("head"), "own")
    length = F.col("head") + F.greatest(F.col("own") - F.col("cut"), F.lit(0))
    convs = materialize(convs.withColumn("length", length), "convs")
    own = turns.join(convs, "conv").where("at >= cut").withColumn("depth", F.col("at") - F.col("cut") + F.col("head") + 1)
    first = turns.where((F.col("conv") % spread == 0) & (F.col("at") < heads)).withColumnRenamed("conv", "base")
    head = first.join(convs, "base").where("at < head").withColumn("depth", F.col("at") + 1)
    columns = ["conv", "depth", "one", "two", "words", "length"]
    return convs.select("conv", "length"), own.select(columns).unionByName(head.select(columns))


def _prefixes(turns):
    """Turns with the hashes of the prefix that they end and of the one before."""
    turns = turns.withColumns({
        "a": F.xxhash64("depth", "one"), "b": F.xxhash64(F.lit(3), "depth", "two"), "block": F.floor(F.col("depth") / BLOCK)})
    turns = materialize(turns.select("conv", "block", "depth", "a", "b", "words", "length"), "placed")
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = turns.where(F.col("length") >= BLOCK).groupBy("conv", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    long = long.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"),
                       F.bit_xor("a").over(before).alias("_a"), F.bit_xor("b").over(before).alias("_b"))
    summed = turns.withColumns({"to_a": F.bit_xor("a").over(inside), "to_b": F.bit_xor("b").over(inside)}).join(
        long, (F.col("conv") == F.col("_conv")) & (F.col("block") == F.col("_block")), "left")
    for c in "ab":
        summed = summed.withColumn(f"to_{c}", F.col(f"to_{c}").bitwiseXOR(F.coalesce(f"_{c}", F.lit(0))))
    return summed.select("conv", "depth", F.col("to_a").alias("a"), F.col("to_b").alias("b"), F.col("to_a").bitwiseXOR(F.col("a")).alias("up_a"),
                         F.col("to_b").bitwiseXOR(F.col("b")).alias("up_b"), "words", "length")


def build(convs: DataFrame, turns: DataFrame):
    """(nodes, members) of the trie.

    ``nodes``: conv and depth (its name), parent (name of its parent, one depth above), many
    (members), words (of its last turn), weight (of its subtree), children.
    ``members``: the node and its parent at each depth of each conversation, and whether it ends there.
    """
    spark = convs.sparkSession
    paths = materialize(_prefixes(turns), "paths")
    known = materialize(paths.groupBy("depth", "a", "b", "up_a", "up_b").agg(
        F.min("conv").alias("node"), F.count("*").alias("many"), F.min("words").alias("words"),
        (F.sum("length") - F.count("*") * (F.col("depth") - 1)).alias("weight")), "prefixes")
    whole = convs.agg(F.min("conv").alias("root"), F.count("*").alias("many"), F.sum("length").alias("turns")).first()
    up = known.select((F.col("depth") + 1).alias("_depth"), F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("node").alias("parent"))
    nodes = known.where("depth > 1").join(
        up, (F.col("depth") == F.col("_depth")) & (F.col("up_a") == F.col("_a")) & (F.col("up_b") == F.col("_b")))
    nodes = nodes.unionByName(known.where("depth = 1").withColumn("parent", F.lit(whole.root)), allowMissingColumns=True)
    nodes = materialize(nodes.select("node", "depth", "parent", "many", "words", "weight", "a", "b"), "linked")
    passed = paths.select("conv", "depth", "a", "b", "length").join(
        nodes.select(F.col("depth").alias("_depth"), F.col("a").alias("_a"), F.col("b").alias("_b"), "node", "parent"),
        (F.col("depth") == F.col("_depth")) & (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
    top = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(whole.root).cast("long").alias("node"),
                       F.lit(None).cast("long").alias("parent"), "length")
    members = materialize(passed.select("conv", "depth", "node", "parent", "length").unionByName(top).select(
        "conv", "depth", "node", "parent", (F.col("depth") == F.col("length")).alias("ends")), "members")
    root = spark.createDataFrame(
        [(whole.root, 0, None, whole.many, 0, whole.turns + whole.many)] if whole.many else [],
        "conv long, depth long, parent long, many long, words long, weight long")
    nodes = nodes.drop("a", "b").withColumnRenamed("node", "conv").unionByName(root)
    below = nodes.where("depth > 0").groupBy(F.col("parent").alias("_conv"), (F.col("depth") - 1).alias("_depth")).agg(F.count("*").alias("children"))
    nodes = nodes.join(below, (F.col("conv") == F.col("_conv")) & (F.col("depth") == F.col("_depth")), "left").drop("_conv", "_depth")
    return materialize(nodes.withColumn("children", F.coalesce("children", F.lit(0))), "nodes"), members


def split_sums(up, weight, values):
    """Sums over the subtrees of a forest, by centroids.

    ``up`` is each node's parent (-1 for a top), ``weight`` what its subtree weighs,
    ``values`` has a row per node. All components are split at once.
    """
    up, weight, out = up.copy(), weight.copy(), np.zeros_like(values)
    alive, nodes = np.ones(len(up), dtype=bool), np.arange(len(up))

    def climb(step):
        while True:
            further = step[step]
            if (further == step).all():
                return step
            step = further

    while alive.any():
        top = climb(np.where(up < 0, nodes, up))
        heavy = alive & (2 * weight > weight[top])
        deeper = np.zeros(len(up), dtype=bool)
        deeper[up[heavy & (up >= 0)]] = True
        centre = np.flatnonzero(heavy & ~deeper)
        stops = np.where(up < 0, nodes, up)
        stops[centre] = centre
        under = climb(stops)
        total = np.zeros_like(values)
        chosen = np.zeros(len(up), dtype=bool)
        chosen[centre] = True
        inside = np.flatnonzero(alive & chosen[under])
        np.add.at(total, under[inside], values[inside])
        at, source = centre, centre
        cut = weight[centre]
        while len(at):
            out[at] += total[source]
            on = up[at] >= 0
            at, source, cut = up[at[on]], source[on], cut[on]
            weight[at] -= cut
        up[(up >= 0) & chosen[np.maximum(up, 0)]] = -1
        up[centre], alive[centre] = -1, False
    return out


def _finish(batches):
    """The sums of whole components, which lie in order one after another."""
    def sums(part):
        names = pd.MultiIndex.from_arrays([part["conv"], part["depth"]])
        up = names.get_indexer(pd.MultiIndex.from_arrays([part["parent"].fillna(0).astype("int64"), part["depth"] - 1]))
        up[((part["conv"] == part["top"]) & (part["depth"] == part["top_depth"])).to_numpy()] = -1
        found = split_sums(up, part["weight"].to_numpy(), part[VALUES].to_numpy())
        return pa.RecordBatch.from_pandas(part[["conv", "depth"]].assign(**dict(zip(VALUES, found.T))), preserve_index=False)

    rest = None
    for batch in batches:
        frame = batch.to_pandas()
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        last = frame.iloc[-1]
        whole = ((frame["top"] != last["top"]) | (frame["top_depth"] != last["top_depth"])).to_numpy()
        rest = frame[~whole].reset_index(drop=True)
        if whole.any():
            yield sums(frame[whole].reset_index(drop=True))
    if rest is not None and len(rest):
        yield sums(rest)


def rollup(nodes: DataFrame, members: DataFrame, local: int = LOCAL) -> DataFrame:
    """(conv, depth, *VALUES): the sums of the values over every node's subtree.

    ``nodes`` has conv, depth, parent, weight and the values; see ``build`` for ``members``.
    """
    if nodes.isEmpty():
        return nodes.select("conv", "depth", *VALUES)
    root = nodes.where("depth = 0").first().conv
    state = nodes.select("conv", "depth", "parent", "weight", *VALUES,
                         F.lit(root).alias("top"), F.lit(0).cast("long").alias("top_depth"))
    small, added = [], []
    passed = members.select(F.col("conv").alias("_conv"), F.col("depth").alias("_depth"), "node", F.col("parent").alias("above"))
    while True:
        state = materialize(state, "components")
        sizes = materialize(state.groupBy(F.col("top").alias("_top"), F.col("top_depth").alias("_top_depth")).agg(
            F.max("weight").alias("total"), F.count("*").alias("size")), "sizes")
        same = (F.col("top") == F.col("_top")) & (F.col("top_depth") == F.col("_top_depth"))
        small.append(state.join(sizes.where(F.col("size") <= local), same, "left_semi"))
        if sizes.where(F.col("size") > local).isEmpty():
            break
        large = state.join(sizes.where(F.col("size") > local), same)
        centre = F.max(F.struct("depth", "conv", "weight")).alias("centre")
        centres = materialize(large.where(2 * F.col("weight") > F.col("total")).groupBy("_top", "_top_depth").agg(centre).select(
            "_top", "_top_depth", F.col("centre.conv").alias("c_conv"), F.col("centre.depth").alias("c_depth"),
            F.col("centre.weight").alias("c_weight")), "centres")
        path = materialize(centres.join(passed, (F.col("c_conv") == F.col("_conv")) & F.col("_depth").between(
            F.col("_top_depth"), F.col("c_depth"))).select(
                "_top", "_top_depth", F.col("node").alias("_node"), F.col("_depth").alias("_at"),
                F.when(F.col("_depth") < F.col("c_depth"), F.col("c_weight")).otherwise(0).alias("cut")), "path")
        # the conversation that names a node also tells which child of the centroid lies above the node
        marked = large.select(state.columns + ["_top", "_top_depth"]).join(centres, ["_top", "_top_depth"]).join(
            passed.where("_depth > 0"), (F.col("conv") == F.col("_conv")) & (F.col("_depth") == F.col("c_depth") + 1), "left")
        is_centre = (F.col("conv") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        under = F.coalesce((F.col("depth") > F.col("c_depth")) & (F.col("above") == F.col("c_conv")), F.lit(False))
        marked = marked.select(*state.columns, is_centre.alias("is_centre"), under.alias("under"), "node", "c_depth").join(
            path.select("_node", "_at", "cut"), (F.col("conv") == F.col("_node")) & (F.col("depth") == F.col("_at")), "left")
        marked = materialize(marked.drop("_node", "_at"), "split")
        totals = marked.where("under or is_centre").groupBy("top", "top_depth").agg(*[F.sum(v).alias(v) for v in VALUES])
        added.append(materialize(path.join(totals, same).select(F.col("_node").alias("conv"), F.col("_at").alias("depth"), *VALUES), "added"))
        state = marked.where("not is_centre").select(
            "conv", "depth", "parent", (F.col("weight") - F.coalesce("cut", F.lit(0))).alias("weight"), *VALUES,
            F.when(F.col("under"), F.col("node")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("under"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"))
    rest = small[0]
    for frame in small[1:]:
        rest = rest.unionByName(frame)
    rest = rest.repartition("top", "top_depth").sortWithinPartitions("top", "top_depth")
    found = rest.mapInArrow(_finish, "conv long, depth long, " + ", ".join(f"{v} long" for v in VALUES))
    for frame in added:
        found = found.unionByName(frame)
    return found.groupBy("conv", "depth").agg(*[F.sum(v).alias(v) for v in VALUES])


def _digests(batches):
    """SHA-256 of texts that lie in pieces, in order, one node after another."""
    key, state = None, None
    names = ["conv", "depth", "digest"]
    for batch in batches:
        out = []
        for own, piece in zip(zip(batch.column("conv").to_pylist(), batch.column("depth").to_pylist()), batch.column("ids").to_pylist()):
            if own != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, state.hexdigest())], names)


def ends(members: DataFrame) -> DataFrame:
    """(conv, depth, digest): SHA-256 of the ids of the conversations that end in each node.

    Ids are joined into pieces that hold a bounded range of ids each. Only a node with several
    pieces is hashed piece by piece, as its digest is one chain.
    """
    piece = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))).alias("ids")
    pieces = materialize(members.where("ends").groupBy("node", "depth", F.shiftright("conv", IDS).alias("block")).agg(piece).select(
        F.col("node").alias("conv"), "depth", "block", "ids"), "ends")
    many = pieces.groupBy("conv", "depth").agg(F.count("*").alias("pieces"), F.min("ids").alias("ids"))
    one = many.where("pieces = 1").select("conv", "depth", F.sha2("ids", 256).alias("digest"))
    chains = pieces.join(many.where("pieces > 1").select("conv", "depth"), ["conv", "depth"], "left_semi")
    chains = chains.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "block")
    return one.unionByName(chains.select("conv", "depth", "ids").mapInArrow(_digests, "conv long, depth long, digest string"))


def prefix_trie(convs: DataFrame, turns: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie of the given turns; see the module."""
    nodes, members = build(convs, turns)
    valued = nodes.withColumns({"leaves": (F.col("children") == 0).cast("long"), "saved": (F.col("many") - 1) * F.col("words")})
    sums = rollup(valued, members, local)
    joined = nodes.join(sums, ["conv", "depth"]).join(ends(members), ["conv", "depth"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("many").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.lit(none)).alias("ends_sha256"))


SQL = r"""
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i]::BIGINT[] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
           lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc),
turns AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text)) - 1 AS p
  FROM (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (
  SELECT c, c - c % 20 AS base,
         xor(list_reduce([4294967295]::BIGINT[] || list_transform(range(1, length(c::VARCHAR) + 1), lambda k: ascii(substr(c::VARCHAR, k, 1))::BIGINT),
             lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), t),
again AS (
  SELECT ids.c, 0 AS own, r.p, r.role, r.text FROM ids JOIN turns r ON r.c = ids.base AND r.p < ids.h
  UNION ALL
  SELECT ids.c, 1, r.p, r.role, r.text FROM ids JOIN turns r ON r.c = ids.c AND r.p >= ids.h),
placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, p) AS depth, md5(role) || md5(text) AS k,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM again),
paths AS MATERIALIZED (
  SELECT c, depth, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY depth)) AS k, words FROM placed
  UNION ALL SELECT c, 0, '', 0 FROM ids),
known AS (SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY depth, k),
members AS MATERIALIZED (SELECT p.c, p.depth, n.conv_id FROM paths p JOIN known n ON p.depth = n.depth AND p.k = n.k),
nodes AS MATERIALIZED (
  SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, n.words
  FROM known n LEFT JOIN members m ON m.c = n.conv_id AND m.depth = n.depth - 1),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
valued AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.conv_id = k.conv_id AND n.depth = k.depth),
sums AS (
  SELECT m.conv_id, m.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM valued v JOIN members m ON m.c = v.conv_id AND m.depth <= v.depth GROUP BY 1, 2),
stops AS (
  SELECT m.conv_id, m.depth, sha256(string_agg(m.c::VARCHAR, ',' ORDER BY m.c)) AS ends_sha256
  FROM members m JOIN (SELECT c, max(depth) AS depth FROM paths GROUP BY c) l ON m.c = l.c AND m.depth = l.depth GROUP BY 1, 2)
SELECT v.conv_id, v.depth, v.parent_conv_id, v.n_convs, v.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM valued v JOIN sums s ON v.conv_id = s.conv_id AND v.depth = s.depth
LEFT JOIN stops e ON v.conv_id = e.conv_id AND v.depth = e.depth
"""

"""Conversation prefix trie by the Euler-tour technique.

A node is a sequence of first turns that conversations share; it is named by the smallest conversation that begins with
it and its depth. The tour enters a node, tours its children by ascending conversation, and leaves the node again; what
lies in a subtree is what the tour meets between the two arcs of its top, so a sum over a subtree is the difference of
two prefix sums along the tour.

The nodes that have the same smallest conversation lie on one path downward. The arcs that enter a path follow each other
in the tour, and so do the arcs that leave it between two paths attached to it. The list that is ranked therefore has two
elements per path: E, the arcs from entering the path down to its end and back up to the last path attached, and A, the
arcs up the parent's path that follow when the tour has left the path. Elements are ranked by pointer jumping: every round
doubles what an element has summed up, as a join of the list with itself on distinct keys. No node's children, members or
conversation's turns meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import discard, stored
from .ordering import CHUNK, numbered, running

#: Every conversation begins with the first turns of the one whose number is the next lower multiple of SHARE, up to MOST.
SHARE, MOST = 5, 8
#: A node's key: sums over its turns of four 32-bit parts of a digest of place and turn, so the key of a prefix
#: is the key of the next longer one less a turn.
LANES = [f"k{i}" for i in range(4)]
PARENT_LANES = [f"p{i}" for i in range(4)]
VALUES = ["length", "leaves", "saved"]


def _lane(digest: Column, i: int) -> Column:
    return F.conv(F.substr(digest, F.lit(1 + 8 * i), F.lit(8)), 16, 10).cast("long")


def shared_head(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST + 1)


def rebuilt_turns(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns (conv_id, turn, role, text) → all conversations (conv_id, place, length), and their rebuilt turns (conv_id,
    depth from 1, digest, n_bytes). ``place`` rises with conv_id and counts turns, so a span of places bounds conversations."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256).alias("digest"))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    rows = numbered(spark, narrow, order, "place", "turns")
    convs = rows.groupBy("conv_id").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    convs = stored(spark, convs.withColumn("head", shared_head(F.col("conv_id")))
                   .withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARE), "convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("n_base", F.lit(0))))
    convs = stored(spark, convs.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("head")))
                   .select("conv_id", "place", "base", "head", "taken", "length"), "convs")

    at = rows.withColumnRenamed("place", "row").join(convs.withColumnRenamed("place", "first"), "conv_id")
    at = at.withColumn("nth", F.col("row") - F.col("first"))
    own = at.filter("nth >= head").select("conv_id", (F.col("taken") + F.col("nth") - F.col("head") + 1).alias("depth"),
                                          "digest", "n_bytes")
    heads = at.filter(F.col("nth") < MOST).select(F.col("conv_id").alias("base"), "nth", "digest", "n_bytes")
    given = heads.join(convs.select("conv_id", "base", "taken"), "base").filter("nth < taken")
    rebuilt = own.unionByName(given.select("conv_id", (F.col("nth") + 1).alias("depth"), "digest", "n_bytes"))
    return convs.select("conv_id", "place", "length"), rebuilt


def prefix_nodes(spark: SparkSession, convs: DataFrame, rebuilt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (conv_id, depth, n_convs, n_bytes, keys of node and parent) with the root, and where conversations end
    (conv_id, place, depth, key)."""
    turn = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "digest"), 256)
    lanes = rebuilt.withColumn("__turn", turn).select(
        "conv_id", "depth", "n_bytes", (F.col("depth") - 1).alias("at"), *[_lane(F.col("__turn"), i).alias(f"t{i}") for i in range(4)])
    keyed = running(lanes, "conv_id", "at", {k: f"t{i}" for i, k in enumerate(LANES)})
    keyed = stored(spark, keyed.select("conv_id", "depth", "n_bytes", *LANES, *[
        (F.col(k) - F.col(f"t{i}")).alias(p) for i, (k, p) in enumerate(zip(LANES, PARENT_LANES))]), "keyed")
    nodes = keyed.groupBy("depth", *LANES).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        *[F.max(p).alias(p) for p in PARENT_LANES])
    zero = F.lit(0).cast("long")
    root = (convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
            .select(zero.alias("depth"), *[zero.alias(k) for k in LANES], "conv_id", "n_convs", zero.alias("n_bytes"),
                    *[F.lit(None).cast("long").alias(p) for p in PARENT_LANES]))
    ends = keyed.join(convs, "conv_id").filter("depth = length").select("conv_id", "place", "depth", *LANES).unionByName(
        convs.filter("length = 0").select("conv_id", "place", zero.alias("depth"), *[zero.alias(k) for k in LANES]))
    return stored(spark, nodes.unionByName(root), "nodes"), ends


def end_digests(ends: DataFrame) -> DataFrame:
    """ends → (depth, key, ends_sha256): the digest of the ascending conversation numbers with commas.

    A digest reads its input in order, so one task reads what belongs to one node; it reads pieces that CHUNK places
    wide groups have joined before, one after the other, and keeps none.
    """
    pieces = ends.groupBy("depth", *LANES, F.floor(F.col("place") / CHUNK).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    keys = ["depth", *LANES]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*[batch.column(i).to_pylist() for i in range(len(keys) + 1)]):
                if key == now:
                    state.update(("," + ids).encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            yield _batch(done)
        if now is not None:
            yield _batch([(*now, state.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(keys))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([r[-1] for r in rows], pa.string())], names=[*keys, "ends_sha256"])

    dealt = pieces.repartition(*keys).sortWithinPartitions(*keys, "piece").select(*keys, "ids")
    return dealt.mapInArrow(hashed, ", ".join(f"{k} long" for k in keys) + ", ends_sha256 string")


def list_ranks(spark: SparkSession, elements: DataFrame, label: str) -> DataFrame:
    """elements (id, next, values...) of one list, whose last has no next → (id, values...): sums from the element to the end.

    Pointer jumping: in round k every element adds what its next one has summed up, which covers 2^k elements.
    Each table is dropped when the next one stands, so two are kept.
    """
    folder, now = stored(spark, elements, label, with_folder=True)
    while not now.filter("next IS NOT NULL").isEmpty():
        ahead = now.select(F.col("id").alias("next"), F.col("next").alias("__next"), *[F.col(v).alias(f"__{v}") for v in VALUES])
        jumped = now.join(ahead, "next", "left").select(
            "id", F.col("__next").alias("next"), *[(F.col(v) + F.coalesce(f"__{v}", F.lit(0))).alias(v) for v in VALUES])
        older = folder
        folder, now = stored(spark, jumped, label, with_folder=True)
        discard(spark, older)
    return now.drop("next")


def prefix_trie(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text, ...) → per node (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, enter_at, exit_at).

    ``enter_at`` and ``exit_at`` are the places of the node's arcs in the tour, from 0. Rows without conv_id belong to no
    conversation. A null turn comes first; rows of a conversation with the same turn follow each other by a digest of role
    and text, and repeated rows are repeated turns. Null role and text are empty. The remainder of a negative conv_id
    is negative, as in SQL. Other columns are ignored. A table without
    conversations has no nodes.
    """
    convs, rebuilt = rebuilt_turns(spark, turns)
    nodes, ends = prefix_nodes(spark, convs, rebuilt)

    # Paths: the nodes of one smallest conversation, from top to bottom; and the parent path each hangs on.
    tops = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"),
        *[F.min_by(p, "depth").alias(p) for p in PARENT_LANES])
    above = nodes.select(F.col("conv_id").alias("parent"), F.col("depth").alias("hook"),
                         *[F.col(k).alias(p) for k, p in zip(LANES, PARENT_LANES)])
    tops = tops.withColumn("hook", F.col("top") - 1).join(above, ["hook", *PARENT_LANES], "left").drop(*PARENT_LANES)
    # In this order the paths of one parent stand together, as the tour visits them.
    paths = stored(spark, numbered(spark, tops, [F.col("parent").asc_nulls_first(), F.col("hook").desc(), F.col("conv_id").asc()],
                                   "nth", "paths"), "paths")
    hooked = paths.filter("parent IS NOT NULL")
    hung = hooked.groupBy(F.col("parent").alias("conv_id"), F.col("hook").alias("depth")).agg(
        F.count(F.lit(1)).alias("n_hung"), F.max("nth").alias("last_hung"))
    first = hooked.groupBy(F.col("parent").alias("conv_id")).agg(F.min("nth").alias("first_hung"), F.max("hook").alias("first_hook"))

    bottoms = paths.select("conv_id", "bottom")
    facts = (nodes.select("conv_id", "depth", "n_convs", "n_bytes").join(bottoms, "conv_id")
             .join(hung, ["conv_id", "depth"], "left"))
    n_children = (F.col("depth") < F.col("bottom")).cast("long") + F.coalesce("n_hung", F.lit(0))
    facts = stored(spark, facts.withColumn("n_children", n_children)
                   .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
                   .withColumn("own", (F.col("n_convs") - 1) * F.col("n_bytes")).drop("bottom", "n_hung"), "facts")

    # The list: E has number 2 * nth, A has 2 * nth + 1.
    sums = facts.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"), F.sum("own").alias("saved"))
    own = paths.join(sums, "conv_id").join(first, "conv_id", "left")
    height = F.col("bottom") - F.col("top") + 1
    entering = own.select(
        (2 * F.col("nth")).alias("id"),
        F.coalesce(2 * F.col("first_hung"), F.when(F.col("parent").isNotNull(), 2 * F.col("nth") + 1)).alias("next"),
        (height + F.col("bottom") - F.coalesce("first_hook", F.col("top") - 1)).alias("length"), "leaves", "saved")
    following = hooked.select((F.col("nth") - 1).alias("nth"), F.col("parent").alias("next_parent"), F.col("hook").alias("next_hook"))
    siblings = hooked.join(following, "nth", "left").withColumn("more", F.coalesce(F.col("parent") == F.col("next_parent"), F.lit(False)))
    last = siblings.filter("NOT more").join(paths.select(
        F.col("conv_id").alias("parent"), F.col("nth").alias("parent_nth"), F.col("top").alias("parent_top"),
        F.col("parent").alias("grand")), "parent")
    zero = F.lit(0).cast("long")
    leaving = siblings.filter("more").select(
        (2 * F.col("nth") + 1).alias("id"), (2 * F.col("nth") + 2).alias("next"), (F.col("hook") - F.col("next_hook")).alias("length"),
        zero.alias("leaves"), zero.alias("saved")).unionByName(last.select(
            (2 * F.col("nth") + 1).alias("id"), F.when(F.col("grand").isNotNull(), 2 * F.col("parent_nth") + 1).alias("next"),
            (F.col("hook") - F.col("parent_top") + 1).alias("length"), zero.alias("leaves"), zero.alias("saved")))
    ranks = list_ranks(spark, entering.unionByName(leaving), "tour")
    # Sums to the end become sums before: the first element has everything behind it.
    whole = ranks.filter("id = 0").select(*[F.col(v).alias(f"all_{v}") for v in VALUES]).first()
    if whole is None:
        whole = [0] * len(VALUES)
    before = stored(spark, ranks.select("id", *[(F.lit(t) - F.col(v)).alias(v) for v, t in zip(VALUES, whole)]), "before")

    # Down a path: what was met above a node, and the last path that is attached to it or below it.
    along = running(facts.join(paths.select("conv_id", "top", "bottom", "nth", "parent", "hook"), "conv_id")
                    .withColumn("at", F.col("depth") - F.col("top")),
                    "conv_id", "at", {"met_leaves": "leaf", "met_saved": "own"}, {"anchor": "last_hung"})
    entered = before.filter("id % 2 = 0").select((F.col("id") / 2).cast("long").alias("nth"), *[F.col(v).alias(f"e_{v}") for v in VALUES])
    path_sums = entered.join(paths.select("nth", "conv_id"), "nth").join(sums, "conv_id").drop("conv_id")
    left = before.filter("id % 2 = 1").select(((F.col("id") - 1) / 2).cast("long").alias("anchor"), *[F.col(v).alias(f"a_{v}") for v in VALUES])
    hooks = hooked.select(F.col("nth").alias("anchor"), F.col("hook").alias("anchor_hook"))
    placed = along.join(path_sums, "nth").join(left.join(hooks, "anchor"), "anchor", "left")
    no_anchor = F.col("anchor").isNull()

    def under(value: str, own: str) -> Column:
        """The prefix sum where the node is left, less that before it is entered."""
        entry = F.col(f"met_{value}") - F.col(own)
        return F.when(no_anchor, F.col(value) - entry).otherwise(F.col(f"a_{value}") - F.col(f"e_{value}") - entry)

    climbed = F.when(no_anchor, F.col("e_length") + F.col("bottom") - F.col("top") + 1 + F.col("bottom") - F.col("depth")).otherwise(
        F.col("a_length") + F.col("anchor_hook") - F.col("depth"))
    result = placed.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", "n_children", under("leaves", "leaf").alias("n_leaves"), under("saved", "own").alias("saved_tokens"),
        (F.col("e_length") + F.col("at")).alias("enter_at"), climbed.alias("exit_at"))
    digests = nodes.select("conv_id", "depth", *LANES).join(end_digests(ends), ["depth", *LANES], "left").select(
        "conv_id", "depth", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    return result.join(digests, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "enter_at", "exit_at")

"""Prefix trie of conversations, from whole sequences collapsed into weighted ones.

A node of depth ``d`` stands for one sequence of ``d`` turns with which at least
one conversation begins. Turns are reduced to hashes at once, so texts are read
once and never shuffled:

1. Identical conversations become one weighted sequence, represented by its
   smallest id, with the list of ids that end there.
2. Each sequence is spread to its prefixes. A prefix is known by its length and a
   sum of 128 hash bits over its turns and their places, which equal prefixes
   share and others do by chance only.
3. Sequences that are proper prefixes of others are dropped by an anti-join;
   what is left are the leaves.
4. Weighted prefixes are aggregated to nodes. A node belongs to the sequence of
   its smallest id, and every sequence owns the prefixes from some depth on. So
   what a subtree sums over its nodes is a sum over the sequences that pass
   through its top, and one more aggregate gives it.

Groups that grow with the data (the root, a common first turn) are aggregated
partly where the rows are, and joins towards them have one row a node on the
other side, so that adaptive execution can split them. A long conversation is
numbered by a range sort and summed in blocks of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrule.llm.common import staged
from tallyrule.llm.sharding import numbered

HALF = 0xFFFFFFFF
LANES = ("a", "b", "c", "d")
BLOCK = 1024  # turns of one conversation that one window sums
IDS = 4096  # ids from one stretch of numbers that one list holds


def turn_rows(turns: DataFrame, id: str, order: str, role: str, text: str) -> DataFrame:
    """``(id, at, h1, h2, bytes)``: every turn at its place, from 0, in its conversation.

    Null roles and texts are empty. Turns go by ``order``, null first; turns that
    tie go by their hashes, repeated rows stand side by side. Rows without an id
    belong to no conversation and are left out; other columns are ignored. An
    empty table gives an empty result.
    """
    r, t = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    rows = turns.filter(F.col(f"`{id}`").isNotNull()).select(
        F.col(f"`{id}`").cast("long").alias("id"),
        F.col(f"`{order}`").alias("turn"),
        F.xxhash64(F.lit(1), r, F.octet_length(r), t).alias("h1"),
        F.xxhash64(F.lit(2), t, F.octet_length(r), r).alias("h2"),
        F.octet_length(t).cast("long").alias("bytes"),
    )
    laid, _ = numbered(rows, ["id", "turn"], "n")
    first = laid.groupBy("id").agg(F.min("n").alias("first"))
    return laid.join(first, "id").select("id", (F.col("n") - F.col("first")).alias("at"), "h1", "h2", "bytes")


def with_shared_heads(rows: DataFrame, head: Column, donor: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Rebuild each conversation: the first ``head`` turns of ``donor``, then its own after its first ``head``.

    ``head`` and ``donor`` are expressions on ``id``, ``head`` from 0 to
    ``most``. A donor with fewer turns gives all, one that is absent none.
    Returns the rows and all ids; an id may be left without rows. Only the first
    ``most`` turns of a donor are sent to the ids it serves.
    """
    ids = rows.groupBy("id").agg((F.max("at") + 1).alias("size"))
    given = ids.select("id", head.cast("long").alias("head"), donor.cast("long").alias("donor"))
    given = given.join(ids.withColumnsRenamed({"id": "donor"}), "donor", "left")
    given = given.withColumn("given", F.least(F.coalesce("size", F.lit(0)), "head")).drop("size")
    firsts = rows.filter(F.col("at") < most).withColumnRenamed("id", "donor")
    lent = firsts.join(given.select("id", "donor", "given"), "donor").filter("at < given")
    own = rows.join(given.select("id", "head", "given"), "id").filter("at >= head")
    own = own.withColumn("at", F.col("at") - F.col("head") + F.col("given"))
    columns = ["id", "at", "h1", "h2", "bytes"]
    return lent.select(*columns).unionByName(own.select(*columns)), ids.select("id")


def _placed(rows: DataFrame) -> DataFrame:
    """The four lanes of a turn at its place, each below 2**32."""
    x = F.xxhash64("at", "h1", "h2")
    y = F.xxhash64("h2", "at", "h1")
    halves = [x.bitwiseAND(F.lit(HALF)), F.shiftrightunsigned(x, 32), y.bitwiseAND(F.lit(HALF)), F.shiftrightunsigned(y, 32)]
    return rows.select("id", "at", "bytes", *[h.alias(n) for h, n in zip(halves, LANES)])


def _keyed(sums: DataFrame, *columns: str) -> DataFrame:
    """Lane sums modulo 2**32, two in each of the longs ``k1, k2``."""
    k1, k2 = (
        F.shiftleft(F.col(a), 32).bitwiseOR(F.col(b).bitwiseAND(F.lit(HALF))) for a, b in (LANES[:2], LANES[2:])
    )
    return sums.select(*columns, k1.alias("k1"), k2.alias("k2"))


def _prefixes(rows: DataFrame) -> DataFrame:
    """``(id, depth, k1, k2, bytes, sofar)`` of every prefix of at least one turn; ``sofar`` sums its bytes."""
    sums = [*LANES, "sofar"]
    rows = rows.withColumn("sofar", F.col("bytes")).withColumn("block", F.floor(F.col("at") / BLOCK))
    # Conversations longer than a block are few rows here: one a block.
    blocks = rows.groupBy("id", "block").agg(*[F.sum(c).alias(c) for c in sums])
    long_ids = rows.filter(F.col("at") == BLOCK).select("id")
    before = Window.partitionBy("id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.join(long_ids, "id", "left_semi").select(
        F.col("id").alias("oid"), F.col("block").alias("oblock"), *[F.sum(c).over(before).alias(f"o{c}") for c in sums]
    )
    within = Window.partitionBy("id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("id", "block", "at", "bytes", *[F.sum(c).over(within).alias(c) for c in sums])
    run = run.join(offsets, (F.col("id") == F.col("oid")) & (F.col("block") == F.col("oblock")), "left")
    run = run.withColumns({c: F.col(c) + F.coalesce(f"o{c}", F.lit(0)) for c in sums})
    return _keyed(run.withColumn("depth", F.col("at") + 1), "id", "depth", "bytes", "sofar")


def _digests(ends: DataFrame) -> DataFrame:
    """``(id, ends_sha256)`` from ``(id, stretch, ids)``: the stretches' lists in order, joined by commas.

    The hash runs over them in one pass, so a list of any length is never held.
    """
    laid = ends.repartition("id").sortWithinPartitions("id", "stretch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []
        for batch in batches:
            for id, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is not None and id == now:
                    digest.update(b"," + ids.encode())
                    continue
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = id, hashlib.sha256(ids.encode())
            if len(done) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["id", "ends_sha256"])
                done = []
        if digest is not None:
            done.append((now, digest.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in done], pa.int64()), pa.array([d for _, d in done])], names=["id", "ends_sha256"]
            )

    return laid.mapInArrow(run, "id long, ends_sha256 string")


def collapse(placed: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Identical conversations as one: ``(id, weight, size, k1, k2)``, and ``(id, ends_sha256)``.

    ``id`` is the smallest of those that are equal. Every id of ``ids`` counts,
    those without rows as the empty sequence.
    """
    sums = placed.groupBy("id").agg(F.count("*").alias("size"), *[F.sum(c).alias(c) for c in LANES])
    sums = ids.join(sums, "id", "left").na.fill(0, ["size", *LANES])
    whole = staged(_keyed(sums, "id", "size"), "whole_sequences")
    same = ["size", "k1", "k2"]
    sequences = whole.groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    stretches = whole.withColumn("stretch", F.floor(F.col("id") / IDS)).groupBy(*same, "stretch")
    # ids are distinct, so a list holds at most as many as its stretch has numbers
    lists = stretches.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda i: i.cast("string")), ",").alias("ids")
    )
    ends = lists.join(sequences.select(*same, "rep"), same).select(F.col("rep").alias("id"), "stretch", "ids")
    return sequences.select(F.col("rep").alias("id"), "weight", *same), _digests(ends)


def prefix_trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row a node, from rows ``(id, at, h1, h2, bytes)`` and all conversation ids.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the
    subtree, members less one times bytes of the last text) and ``ends_sha256``.

    A conversation without turns ends at the root. Without conversations there
    are no nodes, not even a root. Ids are unique in ``ids`` and not null.
    """
    placed = staged(_placed(rows), "placed_turns")
    sequences, digests = collapse(placed, ids)
    sequences = staged(sequences, "sequences")
    digests = staged(digests, "ends")
    kept = placed.join(sequences.select("id"), "id", "left_semi")
    paths = _prefixes(kept)
    root = sequences.select(
        "id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("bytes", "sofar", "k1", "k2")]
    )
    paths = staged(paths.unionByName(root), "paths")
    node = ["depth", "k1", "k2"]
    # Sequences that another one continues end inside the trie; the rest are its leaves.
    longer = paths.join(sequences.select("id", "size"), "id").filter("depth < size").select(*node).distinct()
    whole = sequences.withColumn("depth", F.col("size"))
    leaves = whole.join(longer, node, "left_anti").select("id", F.lit(1).cast("long").alias("leaf"))
    weighted = sequences.join(leaves, "id", "left").na.fill(0, ["leaf"])
    each = paths.join(weighted.select("id", "size", "weight", "leaf"), "id")
    nodes = each.groupBy(*node).agg(
        F.min("id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.max("bytes").alias("bytes")
    )
    nodes = staged(nodes, "nodes")
    # Along a path the smallest member rises until it is the sequence itself.
    seen = staged(each.join(nodes.select(*node, "conv_id"), node), "seen")
    mine, before = F.col("conv_id") == F.col("id"), F.col("sofar") - F.col("bytes")
    owner = seen.groupBy("id").agg(
        F.max(F.when(~mine, F.col("conv_id"))).alias("above"),
        F.min(F.when(mine, F.col("depth"))).alias("from"),
        # a sequence that a smaller id's continues owns nothing
        F.coalesce(F.min(F.when(mine, before)), F.max("sofar")).alias("shared"),
        F.max("sofar").alias("total"),
    )
    # Each member but the first saves a turn's bytes: below a node a path brings its bytes
    # once a member, and those of its own nodes are taken off once.
    saved = F.col("weight") * (F.col("total") - before) - (F.col("total") - F.greatest(before, "shared"))
    parent = F.when(F.col("depth") > F.col("from"), F.col("id")).otherwise(F.col("above"))
    tops = seen.join(owner, "id").groupBy(*node).agg(
        F.sum(saved).alias("saved_tokens"),
        F.max(F.when(mine, parent)).alias("parent_conv_id"),
        F.max(F.when(F.col("depth") == F.col("size"), F.col("id"))).alias("ending"),
    )
    out = staged(nodes.join(tops, node), "summed_nodes")
    # A node's depth and smallest member name it.
    below = out.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    out = out.join(below.agg(F.count("*").alias("n_children")), ["conv_id", "depth"], "left")
    # Where no sequence ends, any id spreads the rows as well as the ending one.
    out = out.withColumn("id", F.coalesce("ending", "conv_id")).join(digests, "id", "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.when(F.col("ending").isNotNull(), F.col("ends_sha256"))
        .otherwise(F.lit(hashlib.sha256(b"").hexdigest()))
        .alias("ends_sha256"),
    )

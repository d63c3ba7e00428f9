"""Conversation prefix trie by fixed-length block hashing.

Conversations are cut into blocks of ``BLOCK_TURNS`` turns.  Every turn has a
128-bit hash of its place, role and text; the exclusive or of the hashes up to
a place names the prefix that ends there, and since it can be taken over any
stretch of turns separately, prefixes of a conversation of any length come
from block sums and sums of ``_STRETCH`` blocks, never from one pass over it.

1. Conversations are grouped by the names of their successive blocks: those
   that agree up to and including a block are one row from there on, with
   counts made before the shuffle, so a beginning that very many share is
   small work.
2. Where a block has no sibling (no other block follows the same prefix), its
   turns are nodes as they stand.  Only blocks with siblings are taken apart:
   their turns are grouped by prefix again, which finds where they diverge.
3. What a subtree adds up comes from its members: each conversation knows the
   length of the beginning it shares with a smaller one, and whether it stands
   for a leaf; both are summed along steps 1 and 2.  Hashes of the ids that end
   in a node are fed by sorted chunks, whatever their number.

Defined results: rows without a conversation id are left out; a null role or
text is empty; turns are ordered by number, null first, and equal numbers by a
hash of role and text; repeated rows are turns of their own; a conversation
may be rebuilt without turns and then ends at the root; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.broadcast import broadcast_if_small
from .common import written

BLOCK_TURNS = 4
_STRETCH = 512
# Ids of one chunk of a node's member list.
_CHUNK_IDS = 4096
# Parents of more children than this, or this share of all nodes, are joined
# by broadcast; at most ``_HOT_PARENTS`` can be.
_MANY_CHILDREN, _HOT_PARENTS = 1000, 10000


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), two hashes ``g1``, ``g2`` and the number
    ``size`` of code points of every turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = written(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("g1"), F.xxhash64(F.lit(2), role, text).alias("g2"),
        F.length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("nth")), "turns")
    order = ["conv_id", F.asc_nulls_first("turn"), "g1", "g2", "nth"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            place = np.arange(len(ids))
            begins = np.concatenate([[True], ids[1:] != ids[:-1]])
            pos = place - np.maximum.accumulate(np.where(begins, place, 0)) + 1
            if ids[0] == last:
                pos[:int(np.argmax(begins[1:])) + 1 if begins[1:].any() else len(ids)] += seen
            last, seen = ids[-1], int(pos[-1])
            yield batch.append_column("i", pa.array(pos, pa.int64()))

    # turns of one conversation may lie in several partitions, next to each other
    run = written(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("conv_id", "g1", "g2", "size", F.spark_partition_id().alias("part"))
                  .mapInArrow(number, "conv_id long, g1 long, g2 long, size long, part int, i long"), "turns-sorted")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (run.groupBy("conv_id", "part").agg(F.max("i").alias("n"))
               .select("conv_id", "part", F.sum("n").over(before).alias("earlier")).where("earlier is not null"))
    # at most one conversation per partition goes on from the one before
    return run.join(broadcast_if_small(earlier), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("i") + F.coalesce("earlier", F.lit(0))).alias("pos"), "g1", "g2", "size")


def shared_heads(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first ``head`` turns (at most ``most``) of
    conversation ``base``, then the own turns after the first ``head``.
    Returns the rebuilt turns (``pos`` is the place in the rebuilt one) and all
    ids."""
    ids = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), head.alias("head"))
    heads = (turns.where(F.col("pos") <= most)
             .join(ids.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi")
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "g1", "g2", "size"))).alias("turns"))
             .withColumnRenamed("conv_id", "base"))
    borrows = (F.col("head") > 0) & (F.col("base") != F.col("conv_id"))
    # up to as many conversations borrow from a base as ``base`` maps to it
    plan = written(ids.where(borrows).join(heads, "base", "left")
                   .select("conv_id", "head", F.expr("slice(turns, 1, head)").alias("turns"))
                   .select("conv_id", "head", F.coalesce(F.size("turns"), F.lit(0)).alias("shift"), "turns")
                   .unionByName(ids.where(~borrows).select(
                       "conv_id", F.lit(0).cast(ids.schema["head"].dataType).alias("head")), allowMissingColumns=True),
                   "heads")
    own = (turns.join(plan.select("conv_id", "head", F.greatest("shift", F.lit(0)).alias("shift")), "conv_id")
           .where("pos > head")
           .select("conv_id", (F.col("pos") - F.col("head") + F.coalesce("shift", F.lit(0))).alias("pos"),
                   "g1", "g2", "size"))
    borrowed = plan.select("conv_id", F.explode("turns").alias("t")).select("conv_id", "t.*")
    return own.unionByName(borrowed), plan.select("conv_id")


def _blocks(turns: DataFrame) -> DataFrame:
    """Blocks of the conversations: ``k``, its ``turns``, and the name of the
    prefix before (``b1``, ``b2``; ``before`` code points) and after it
    (``e1``, ``e2``; ``after``)."""
    place = F.struct("pos", F.xxhash64("pos", "g1", "g2").alias("f1"), F.xxhash64("g2", "pos", "g1").alias("f2"), "size")
    k = F.expr(f"(pos - 1) div {BLOCK_TURNS}")
    blocks = (turns.select("conv_id", k.alias("k"), place.alias("t"))
              .groupBy("conv_id", "k")
              .agg(F.bit_xor("t.f1").alias("x1"), F.bit_xor("t.f2").alias("x2"), F.sum("t.size").alias("size"),
                   F.sort_array(F.collect_list("t")).alias("turns"))
              .withColumn("stretch", F.expr(f"k div {_STRETCH}")))
    blocks = written(blocks, "blocks")

    def up_to(w) -> list[Column]:
        w = w.rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(c.over(w), F.lit(0)) for c in (F.bit_xor("x1"), F.bit_xor("x2"), F.sum("size"))]

    first = [c.alias(n) for c, n in zip(up_to(Window.partitionBy("conv_id").orderBy("stretch")), ("s1", "s2", "s"))]
    ahead = (blocks.groupBy("conv_id", "stretch")
             .agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("size").alias("size"))
             .select("conv_id", "stretch", *first).where("stretch > 0"))
    inner = [c.alias(n) for c, n in zip(up_to(Window.partitionBy("conv_id", "stretch").orderBy("k")), ("w1", "w2", "w"))]
    placed = blocks.select("*", *inner).join(ahead, ["conv_id", "stretch"], "left")
    b = {n: F.col(f"w{i}").bitwiseXOR(F.coalesce(f"s{i}", F.lit(0))) for i, n in ((1, "b1"), (2, "b2"))}
    before = F.col("w") + F.coalesce("s", F.lit(0))
    return written(placed.select(
        "conv_id", "k", "turns", b["b1"].alias("b1"), b["b2"].alias("b2"), before.alias("before"),
        b["b1"].bitwiseXOR(F.col("x1")).alias("e1"), b["b2"].bitwiseXOR(F.col("x2")).alias("e2"),
        (before + F.col("size")).alias("after")), "blocks-placed")


_SELF, _PARENT = ["depth", "x1", "x2"], ["depth", "p1", "p2"]


def _taken_apart(classes: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Nodes of the classes' turns: those of a block without siblings as they
    are, others grouped by prefix, with ``sums`` of the classes' columns."""
    fields = []
    for name, of, start in (("x1", "f1", "b1"), ("x2", "f2", "b2")):
        for out, upto in ((name, "j"), ("p" + name[1], "j - 1")):
            fields.append(f"'{out}', aggregate(slice(turns, 1, {upto}), {start}, (a, t) -> a ^ t.{of})")
    fields.append("'before', aggregate(slice(turns, 1, j - 1), before, (a, t) -> a + t.size)")
    step = F.expr("transform(sequence(1, size(turns)), j -> named_struct('depth', turns[j - 1].pos, "
                  + ", ".join(fields) + "))")
    rows = classes.select("alone", *sums, F.explode(step).alias("t")).select("alone", *sums, "t.*")
    kept = [*_SELF, "p1", "p2", "before"]
    grouped = rows.where("not alone").groupBy(*_SELF).agg(
        *[F.first(c).alias(c) for c in ("p1", "p2", "before")], *[f.alias(n) for n, f in sums.items()])
    return rows.where("alone").select(*kept, *sums).unionByName(grouped.select(*kept, *sums))


def _ends_hashes(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of the ids that end there, ascending and joined by
    commas; a node's ids are spread over tasks and hashed chunk by chunk."""
    order = ["x1", "x2", "depth", "conv_id"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(node: tuple, ids: list[int]) -> tuple:
            return (*node, ids[0], ",".join(map(str, ids)))

        node, ids = None, []
        for batch in batches:
            out = []
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in order)):
                if tuple(at) != node or len(ids) == _CHUNK_IDS:
                    if ids:
                        out.append(chunk(node, ids))
                    node, ids = tuple(at), []
                ids.append(conv)
            yield _batch(out)
        if ids:
            yield _batch([chunk(node, ids)])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          ["x1", "x2", "depth", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in ("x1", "x2", "depth", "ids"))):
                if tuple(at) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = tuple(at), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _hash_batch(out)
        if node is not None:
            yield _hash_batch([(*node, state.hexdigest())])

    def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          ["x1", "x2", "depth", "ends_sha256"])

    chunks = (ends.repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(joined, "x1 long, x2 long, depth long, first long, ids string"))
    return (chunks.repartition("x1", "x2", "depth").sortWithinPartitions("x1", "x2", "depth", "first")
            .mapInArrow(hashed, "x1 long, x2 long, depth long, ends_sha256 string"))


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations ``ids`` with turns
    ``turns`` (``conv_id``, ``pos``, ``g1``, ``g2``, ``size``)."""
    blocks = _blocks(turns)
    key = ["k", "e1", "e2"]
    grouped = blocks.groupBy("k", "b1", "b2", "e1", "e2").agg(
        F.first("turns").alias("turns"), F.first("before").alias("before"),
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    grouped = written(grouped, "block-classes")
    single = (grouped.groupBy("k", "b1", "b2").agg(F.count(F.lit(1)).alias("n"), F.min("e1").alias("e1"),
                                                   F.min("e2").alias("e2")).where("n = 1").select(*key))
    classes = written(grouped.join(single.withColumn("alone", F.lit(True)), key, "left")
                      .withColumn("alone", F.coalesce("alone", F.lit(False))), "block-classes")

    counts = {"n_convs": F.sum("n_convs"), "conv_id": F.min("conv_id")}
    zero = F.lit(0).cast("long")
    root = (ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
            .select(*[zero.alias(c) for c in (*_SELF, "p1", "p2", "before")], "n_convs", "conv_id"))
    nodes = written(_taken_apart(classes, counts).unionByName(root), "nodes")
    kids = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"),
                                             F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children")))
    nodes = written(nodes.join(kids, _SELF, "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

    # what each conversation shares with a smaller one, and whether it is a leaf's smallest
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("shared"),
                                         F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    last = blocks.groupBy("conv_id").agg(F.max(F.struct(
        "k", "e1", "e2", F.col("turns")[F.size("turns") - 1]["pos"].alias("depth"), "after")).alias("last"))
    convs = written(ids.join(last, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"last.{c}", zero).alias(n) for c, n in (("depth", "depth"), ("e1", "x1"), ("e2", "x2"))],
        F.coalesce("shared", "last.after", zero).alias("shared"), F.coalesce("leaf", zero).alias("n_leaves")), "convs")
    sums = {"shared": F.sum("shared"), "n_leaves": F.sum("n_leaves"), "top": F.min("top")}
    top = F.struct("conv_id", "shared").alias("top")
    weighed = (blocks.select("conv_id", *key).join(convs.select("conv_id", "shared", "n_leaves"), "conv_id")
               .select(*key, "shared", "n_leaves", top).groupBy(*key).agg(*[f.alias(n) for n, f in sums.items()]))
    below = _taken_apart(classes.drop("n_convs", "conv_id").join(weighed, key), sums).select(*_SELF, *sums)
    below = below.unionByName(convs.select("shared", "n_leaves", top).agg(*[f.alias(n) for n, f in sums.items()])
                              .where("top is not null").select(*[zero.alias(c) for c in _SELF], *sums))

    known = written(nodes.join(below, _SELF).join(
        _ends_hashes(convs.select(*_SELF, "conv_id")), _SELF, "left"), "nodes")
    many = max(_MANY_CHILDREN, known.count() // _HOT_PARENTS)
    parents = known.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"),
                                                   F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"),
                                                   "n_children")
    # bounded: children of different parents differ, so few parents have many
    hot = F.broadcast(parents.where(F.col("n_children") > many).drop("n_children"))
    met = known.join(hot, _PARENT, "left")
    rest = (met.where("parent_conv_id is null").drop("parent_conv_id")
            .join(parents.where(F.col("n_children") <= many).drop("n_children"), _PARENT, "left"))
    saved = F.col("shared") - F.col("top.shared") - (F.col("n_convs") - 1) * F.col("before")
    none = hashlib.sha256(b"").hexdigest()
    return met.where("parent_conv_id is not null").unionByName(rest).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def shared_prefixes(conversations: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """Trie of the conversations rebuilt on family heads: conversation ``c``
    begins with the first ``h`` turns of ``c - c % family``, where ``h`` is the
    checksum of its number modulo ``most + 1``."""
    own = F.col("conv_id")
    head = (F.crc32(own.cast("string").cast("binary")) % (most + 1)).cast("int")
    return trie(*shared_heads(numbered_turns(conversations), own - own % family, head, most))

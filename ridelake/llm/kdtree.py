"""Exact top-k search by inner product in KD-trees, one per shard.

Vectors are quantised to integers.  A small KD-tree fitted on a bounded sample
deals all rows into cells of nearby vectors; a cell with more rows than a
shard holds is dealt over several shards, so many copies of one vector spread
too.  Each shard has a KD-tree of its own: median splits of the widest
dimension, tight bounding boxes, rows ordered by id among equal values.

A query is answered in its own shard first, best-first by the greatest inner
product a box allows.  The kth result found there goes with the query to the
other cells: cells whose box cannot reach it are not visited, and in a shard
the traversal starts from it and ends at the first box that cannot.  A box
that only ties is left out where its least id is larger.  The sample and the
shards set the work only: every row is indexed and every bound is exact, so
the result equals comparing all pairs.

Defined results: a row whose vector is null, or holds a null or a component
that is not finite, takes no part, neither as query nor as candidate; a query
never finds its own row, but finds repeated rows; of equal scores the smaller
id goes first, a null id last; a row with a null id is no query; vectors are
compared with vectors of their own length only (an empty vector has score 0
with any other empty one); a component is clipped to +-2**53 after scaling and
a score to 64 bits; fewer than k candidates give all; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.broadcast import broadcast_if_small
from .common import written

SCALE = 1024
TOP = 10
SHARD_ROWS = 16384
LEAF_ROWS = 128
# Rows the dealing tree is fitted on, and its greatest number of cells for
# vectors of one length.
SAMPLE_ROWS = 8192
MOST_CELLS = 256
# Queries that visit a shard together.
BLOCK_QUERIES = 1024

_EXACT = 1 << 53
_LAST = np.iinfo(np.int64).max  # stands for a null id: behind all others


# --- one KD-tree

def split_order(v: np.ndarray, ids: np.ndarray, least: int) -> tuple[np.ndarray, list]:
    """Order of the rows in which every node is a range, and the nodes
    ``(from, to, left, right)``, children after their parent; a leaf has no
    children (-1).  Nodes of more than ``least`` rows are split at the median
    of their widest dimension."""
    order = np.argsort(ids, kind="stable")
    nodes, todo = [[0, len(v), -1, -1]], [0]
    while todo:
        at = todo.pop()
        a, b = nodes[at][:2]
        if b - a <= least:
            continue
        part = v[order[a:b]]
        widest = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if part.shape[1] else None
        if widest is not None:  # a stable sort keeps equal values in order of id
            order[a:b] = order[a:b][np.argsort(part[:, widest], kind="stable")]
        middle = (a + b) // 2
        for side, (x, y) in ((2, (a, middle)), (3, (middle, b))):
            nodes[at][side] = len(nodes)
            todo.append(len(nodes))
            nodes.append([x, y, -1, -1])
    return order, nodes


class Tree:
    """A KD-tree over the rows of a shard."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, nodes: list):
        self.v, self.ids, self.nodes = v, ids, nodes
        ranges = [(a, b) for a, b, _, _ in nodes]
        d = v.shape[1]
        self.low = np.array([v[a:b].min(axis=0) for a, b in ranges]).reshape(len(ranges), d)
        self.high = np.array([v[a:b].max(axis=0) for a, b in ranges]).reshape(len(ranges), d)
        self.least = [int(ids[a:b].min()) for a, b in ranges]
        self.most = float(np.abs(v).max()) if v.size else 0.0

    def search(self, queries: np.ndarray, k: int, start: list[tuple[int, int]], own: list[int]) -> list[list]:
        """For each query the up to ``k`` best rows ``(score, -id, row)`` that
        beat its ``start`` (score, -id), never row ``own``."""
        exact = bool(queries.size == 0 or np.abs(queries).max() * max(1.0, self.most) * v_dim(self.v) < _EXACT)
        if exact:
            bounds = (np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T).tolist()
        out = []
        for i, q in enumerate(queries):
            best: list[tuple[int, int, int]] = []
            floor = start[i]
            bound = bounds[i] if exact else [_LAST] * len(self.nodes)
            if not exact:
                q = np.array([int(x) for x in q], object)
            heap = [(-bound[0], self.least[0], 0)]
            while heap:
                top, least, at = heapq.heappop(heap)
                if (-top, -least) <= floor:
                    break  # no box left can do better
                a, b, left, right = self.nodes[at]
                if left >= 0:
                    for child in (left, right):
                        if (bound[child], -self.least[child]) > floor:
                            heapq.heappush(heap, (-bound[child], self.least[child], child))
                    continue
                if exact:
                    scores = self.v[a:b] @ q
                    rows = np.flatnonzero(scores >= floor[0])
                else:
                    block = self.v[a:b].astype(np.int64).astype(object)
                    scores = [min(max(int(s), -_LAST - 1), _LAST) for s in (block * q).sum(axis=1)] if len(q) \
                        else [0] * (b - a)
                    rows = range(b - a)
                for r in rows:
                    if a + r == own[i]:
                        continue
                    found = (int(scores[r]), -int(self.ids[a + r]), a + int(r))
                    if found[:2] > floor or (found[:2] == floor and len(best) < k):
                        heapq.heappush(best, found) if len(best) < k else heapq.heappushpop(best, found)
                        if len(best) == k:
                            floor = max(floor, best[0][:2])
            out.append(sorted(best, reverse=True))
        return out


def v_dim(v: np.ndarray) -> int:
    return max(1, v.shape[1])


# --- vectors as bytes

def packed(v: np.ndarray) -> bytes:
    """Integers in as few bytes as hold all, their width first."""
    most = int(np.abs(v).max()) if v.size else 0
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    return struct.pack("<B", np.dtype(kind).itemsize) + v.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {2: np.int16, 4: np.int32, 8: np.int64}[data[0]], offset=1).astype(np.float64)


def quantised(values: list[np.ndarray]) -> list[np.ndarray]:
    return [np.clip(np.floor(v.astype(np.float64) * SCALE), -_EXACT, _EXACT) for v in values]


# --- dealing rows into cells

def _usable(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _rows(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """The vectors of a batch, without a Python object per component."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    return np.split(flat, ends[:-1]) if len(ends) else []


def _dealing_trees(vectors: DataFrame, rows: dict[int, int], vector: str) -> dict[int, list]:
    """Per vector length a tree that names a cell: ``(dimension, value, left,
    right)`` or the cell's number."""
    wanted = F.lit(None).cast("double")
    for d, n in rows.items():
        wanted = F.when(F.size(vector) == d, F.lit(min(1.0, SAMPLE_ROWS / n))).otherwise(wanted)
    place = F.shiftrightunsigned(F.xxhash64(vector, F.lit(7)), 11) / F.lit(float(1 << 53))
    # bounded: at most twice the sample of each length
    got = vectors.where(place < wanted).select(vector).limit(2 * SAMPLE_ROWS * len(rows)).toArrow()
    by_length: dict[int, list] = {}
    for batch in got.combine_chunks().to_batches():
        for v in quantised(_rows(batch, vector)):
            by_length.setdefault(len(v), []).append(v)
    out = {}
    for d, n in rows.items():
        cells, tree = min(MOST_CELLS, max(1, -(-n // SHARD_ROWS))), []
        sample = np.unique(np.array(sorted(map(tuple, by_length.get(d, [])))).reshape(-1, d), axis=0) \
            if d and by_length.get(d) else np.zeros((0, d))

        def grow(v: np.ndarray, wanted: int, first: int) -> int:
            at = len(tree)
            tree.append(None)
            spread = v.max(axis=0) - v.min(axis=0) if len(v) > 1 and v.shape[1] else np.zeros(0)
            if wanted < 2 or not spread.any():
                tree[at] = first
                return at
            dim = int(spread.argmax())
            cut = float(np.median(v[:, dim]))
            low = v[:, dim] < cut
            if not low.any():
                cut = float(v[:, dim].min()) + 0.5
                low = v[:, dim] < cut
            half = wanted // 2
            left = grow(v[low], half, first)
            tree[at] = (dim, cut, left, grow(v[~low], wanted - half, first + half))
            return at

        grow(sample, cells, 0)
        out[d] = tree
    return out


def _cells_of(tree: list, v: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(v), np.int32), [(0, np.arange(len(v)))]
    while todo:
        at, rows = todo.pop()
        if isinstance(tree[at], tuple):
            dim, cut, left, right = tree[at]
            low = v[rows, dim] < cut
            todo += [(left, rows[low]), (right, rows[~low])]
        else:
            out[rows] = tree[at]
    return out


def _dealt(vectors: DataFrame, trees: dict[int, list]) -> DataFrame:
    """``id``, ``query``, ``size``, ``cell``, ``v`` (bytes) and ``nth``, a
    running number in its task."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for batch in batches:
            vs = quantised(_rows(batch, "vector"))
            sizes = np.array([len(v) for v in vs], np.int32)
            cell = np.zeros(len(vs), np.int32)
            for d in set(sizes.tolist()):
                rows = np.flatnonzero(sizes == d)
                cell[rows] = _cells_of(trees[d], np.array([vs[i] for i in rows]).reshape(len(rows), d))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("query"), pa.array(sizes), pa.array(cell),
                 pa.array([packed(v) for v in vs], pa.binary()), pa.array(np.arange(nth, nth + len(vs)))],
                ["id", "query", "size", "cell", "v", "nth"])
            nth += len(vs)

    return vectors.mapInArrow(deal, "id long, query boolean, size int, cell int, v binary, nth long")


# --- shards

_SHARD = "size int, cell int, piece int, ids binary, v binary, queries binary, nodes binary, low array<long>, high array<long>"


def _shard(key: tuple, rows: pa.Table) -> pa.Table:
    """One shard: its rows in the order of its tree, and its box."""
    ids = rows.column("id").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
    size = key[0].as_py()
    v = np.array([unpacked(x.as_py()) for x in rows.column("v")]).reshape(len(ids), size)
    order, nodes = split_order(v, ids, LEAF_ROWS)
    asked = np.flatnonzero(rows.column("query").combine_chunks().to_numpy(zero_copy_only=False)[order])
    v = v[order]
    row = [size, key[1].as_py(), key[2].as_py(), ids[order].tobytes(), packed(v), asked.astype(np.int32).tobytes(),
           np.array(nodes, np.int32).tobytes(), v.min(axis=0).astype(np.int64), v.max(axis=0).astype(np.int64)]
    fields = [f.split() for f in _SHARD.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.Table.from_arrays([pa.array([x], kinds[t]) for x, (_, t) in zip(row, fields)],
                                [n for n, _ in fields])


def _tree(row: dict) -> Tree:
    ids = np.frombuffer(row["ids"], np.int64)
    return Tree(unpacked(row["v"]).reshape(len(ids), row["size"]), ids,
                np.frombuffer(row["nodes"], np.int32).reshape(-1, 4).tolist())


_HOME = ("size int, cell int, piece int, row int, query_id long, v binary, kth_score long, kth_id long, "
         "scores array<long>, ids array<long>")


def _at_home(shards: DataFrame, k: int) -> DataFrame:
    """Each query's best rows in its own shard; the kth of them (or nothing
    to beat: the least long and id) is what other shards have to beat."""
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree, asked = _tree(row), np.frombuffer(row["queries"], np.int32)
                for at in range(0, len(asked), BLOCK_QUERIES):
                    rows = asked[at:at + BLOCK_QUERIES]
                    found = tree.search(tree.v[rows], k, [(-_LAST - 1, -_LAST - 1)] * len(rows), rows.tolist())
                    out = [(row["size"], row["cell"], row["piece"], int(r), int(tree.ids[r]), packed(tree.v[r]),
                            f[-1][0] if len(f) == k else -_LAST - 1, -f[-1][1] if len(f) == k else None,
                            [x[0] for x in f], [-x[1] for x in f]) for r, f in zip(rows, found)]
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(_NAMES, o)) for o in out], schema=_HOME_SCHEMA)

    return shards.mapInArrow(answer, _HOME)


_HOME_SCHEMA = pa.schema([("size", pa.int32()), ("cell", pa.int32()), ("piece", pa.int32()), ("row", pa.int32()),
                          ("query_id", pa.int64()), ("v", pa.binary()), ("kth_score", pa.int64()),
                          ("kth_id", pa.int64()), ("scores", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))])
_NAMES = _HOME_SCHEMA.names


def _beat(score: int, kth_id: int | None) -> tuple[int, int]:
    return (score, -kth_id) if kth_id is not None else (-_LAST - 1, -_LAST - 1)


def _boxes(shards: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per vector length its cells and the low and high corners of their boxes."""
    side = F.posexplode(F.arrays_zip("low", "high")).alias("place", "side")
    corner = (shards.select("size", "cell", side).groupBy("size", "cell", "place")
              .agg(F.min("side.low").alias("low"), F.max("side.high").alias("high")))
    by_cell = shards.select("size", "cell").distinct()
    # bounded: MOST_CELLS boxes for each vector length
    got = by_cell.join(corner.groupBy("size", "cell").agg(
        F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("box")), ["size", "cell"], "left").collect()
    of: dict[int, list] = {}
    for r in got:
        of.setdefault(r["size"], []).append((r["cell"], [(x["low"], x["high"]) for x in r["box"] or []]))
    out = {}
    for d, found in of.items():
        box = np.array([b for _, b in found], np.float64).reshape(len(found), d, 2)
        out[d] = (np.array([c for c, _ in found]), box[:, :, 0], box[:, :, 1])
    return out


def _visits(home: DataFrame, boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """Blocks of queries for the cells whose box can beat what they have:
    ``size``, ``cell`` and the ``block``."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, int], list] = {}

        def block(at: tuple[int, int], rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()),
                 pa.array([rows], pa.list_(_QUERY))], ["size", "cell", "block"])

        for batch in batches:
            for row in batch.to_pylist():
                q = unpacked(row["v"])
                cells, low, high = boxes[row["size"]]
                bound = high @ np.maximum(q, 0) + low @ np.minimum(q, 0)
                # beyond exact arithmetic a box is visited in case of doubt
                bound += np.where(np.abs(bound) >= _EXACT, np.abs(bound) * 1e-9, 0)
                reach = bound >= (row["kth_score"] if row["kth_id"] is not None else -np.inf)
                for cell in cells[reach].tolist():
                    rows = waiting.setdefault((row["size"], cell), [])
                    rows.append({n: row[n] for n in _QUERY_NAMES})
                    if len(rows) == BLOCK_QUERIES:
                        yield block((row["size"], cell), waiting.pop((row["size"], cell)))
        for at, rows in waiting.items():
            yield block(at, rows)

    return home.mapInArrow(choose, "size int, cell int, block array<struct<query_id: long, cell: int, piece: int, "
                                   "row: int, v: binary, kth_score: long, kth_id: long>>")


_QUERY = pa.struct([("query_id", pa.int64()), ("cell", pa.int32()), ("piece", pa.int32()), ("row", pa.int32()),
                    ("v", pa.binary()), ("kth_score", pa.int64()), ("kth_id", pa.int64())])
_QUERY_NAMES = [f.name for f in _QUERY]


def _visited(pairs: DataFrame, k: int) -> DataFrame:
    """Rows of a shard that beat what visiting queries have; a shard's tree is
    built once for the blocks that follow one another."""
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                here = (row["size"], row["cell"], row["piece"])
                if here != last:
                    last, tree = here, _tree(row)
                asked = [q for q in row["block"] if (q["cell"], q["piece"]) != here[1:]]
                if not asked:
                    continue
                found = tree.search(np.array([unpacked(q["v"]) for q in asked]).reshape(len(asked), row["size"]), k,
                                    [_beat(q["kth_score"], q["kth_id"]) for q in asked], [-1] * len(asked))
                out = [(q, f) for q, f in zip(asked, found) if f]
                if out:
                    yield pa.RecordBatch.from_pylist(
                        [{"size": row["size"], "cell": q["cell"], "piece": q["piece"], "row": q["row"],
                          "query_id": q["query_id"], "scores": [x[0] for x in f], "ids": [-x[1] for x in f]}
                         for q, f in out], schema=_FOUND)

    return pairs.mapInArrow(answer, "size int, cell int, piece int, row int, query_id long, "
                                    "scores array<long>, ids array<long>")


_FOUND = pa.schema([(n, _HOME_SCHEMA.field(n).type)
                    for n in ("size", "cell", "piece", "row", "query_id", "scores", "ids")])


def top_k(docs: DataFrame, id_col: str, vector: str, queries: Column, k: int = TOP) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` of the ``k`` rows of
    greatest inner product with each row for which ``queries`` holds."""
    vectors = docs.where(_usable(vector)).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(queries & F.col(id_col).isNotNull(), F.lit(False)).alias("query"),
        F.col(vector).alias("vector"))
    # one row per vector length
    rows = {r["d"]: r["n"] for r in vectors.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    dealt = written(_dealt(vectors, _dealing_trees(vectors, rows, "vector")), "kd-rows")
    pieces = dealt.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("pieces"))
    count = pieces.agg(F.sum("pieces")).first()[0] or 1
    piece = F.pmod(F.xxhash64("id", "nth"), F.col("pieces")).cast("int")
    shards = written(dealt.join(broadcast_if_small(pieces), ["size", "cell"]).withColumn("piece", piece)
                     .select("id", "query", "size", "cell", "piece", "v")
                     .repartition(int(count), "size", "cell", "piece")
                     .groupBy("size", "cell", "piece").applyInArrow(_shard, _SHARD), "kd-shards")
    home = written(_at_home(shards, k), "kd-home")
    visits = _visits(home, _boxes(shards)).join(broadcast_if_small(pieces), ["size", "cell"]).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    elsewhere = _visited(visits.join(shards.drop("queries", "low", "high"), ["size", "cell", "piece"]), k)
    of = ["size", "cell", "piece", "row", "query_id"]
    found = (home.select(*of, "scores", "ids").unionByName(elsewhere)
             .select(*of, F.explode(F.arrays_zip("scores", "ids")).alias("x"))
             .select(*of, F.col("x.scores").alias("score"), F.col("x.ids").alias("id")))
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("id") < _LAST, F.col("id")).alias("id"), "score"))

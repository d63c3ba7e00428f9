"""Sequence packing: concatenate and cut.

Documents are tokenized where they lie (no shuffle) and written once with
their running token count inside the partition.  The partitions' totals are
prefix-summed (second pass), which gives every document its global offset in
the endless concatenation; fixed windows of ``length`` tokens then cut it, so
a document yields one piece per window it touches and the pieces on either
side of a cut are the boundary records.  Only the last window is not full.

Defined results: a null text is an empty one (its end id alone); repeated rows
and repeated ids are packed as often as they occur; an empty table gives no
pieces; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exclusive_prefix, written
from .tokens import encoder

SEQUENCE_TOKENS = 2048

_TOKENS = "doc_id long, part long, before long, n_tokens long, ids binary"
_PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
           "sequence_id long, offset long")


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, spaces: bool = True) -> DataFrame:
    """First pass: every document's ids (with ``end_id``) as little-endian
    32-bit bytes, its partition and the tokens before it in that partition."""
    end = np.uint32(end_id).astype("<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, enc = TaskContext.get().partitionId(), 0, encoder(vocabulary, spaces)
        for batch in batches:
            ids = [x + end for x in enc.ids(batch.column(1).to_pylist())]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(ids), part, np.int64)), pa.array(starts),
                 pa.array(counts), pa.array(ids, pa.binary())],
                ["doc_id", "part", "before", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, _TOKENS)


def cut(tokens: DataFrame, length: int = SEQUENCE_TOKENS) -> DataFrame:
    """Second pass over ``tokenized`` rows (written, so that both passes see
    the same partitions): one row per piece, with its ids."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = exclusive_prefix(totals, "part", "n", "part_offset")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(1).to_numpy()
            n = batch.column(2).to_numpy()
            first = at // length
            count = (at + n - 1) // length - first + 1
            row = np.repeat(np.arange(len(n)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            sequence = first[row] + nth
            begin = np.maximum(sequence * length, at[row])
            stop = np.minimum((sequence + 1) * length, at[row] + n[row])
            start, size = begin - at[row], stop - begin
            ids = batch.column(3).to_pylist()
            cuts = [ids[r][4 * s:4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(size),
                 pa.array(cuts, pa.binary()), pa.array(n[row]), pa.array(sequence),
                 pa.array(begin - sequence * length)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    # offsets has one row (16 bytes) per partition of the first pass
    return (tokens.join(F.broadcast(offsets), "part")
            .select("doc_id", (F.col("before") + F.col("part_offset")).alias("at"), "n_tokens", "ids")
            .mapInArrow(pieces, _PIECES))


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1,
         length: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces of ``docs`` (``doc_id``, ``text``) in sequences of ``length``."""
    return cut(written(tokenized(docs, vocabulary, end_id), "tokens"), length)

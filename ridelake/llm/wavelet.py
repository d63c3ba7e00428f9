"""Token-id files as wavelet matrices.

Documents are range-partitioned by id; every partition is a shard, written as
one Parquet file whose rows are blocks: the documents of the block, the ids
before it in the shard and a zstd-compressed wavelet matrix of all its ids
(one bit-plane per id bit with the number of ones before every 512 bits).
``WaveletMatrix`` answers access, rank and select on one block without
decoding the rest; the functions below run them over whole files in Spark.

Defined results: a null text is an empty one (its end id alone); documents
are ordered by id, nulls first, and rows with one id by the hash of the text
and the text; an empty table gives files without rows; other columns of the
input, whatever their names, are ignored.  A block ends with the document that
fills it, so only a single longer document makes a block larger.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exclusive_prefix, text_hash, written
from .tokens import encoder

BLOCK_TOKENS = 1 << 18
_STEP = 512  # bits between two stored ranks
_MAGIC = b"WVM1"
_BLOCKS = ("shard long, before long, n_tokens long, doc_ids array<long>, "
           "doc_tokens array<long>, matrix binary")


class WaveletMatrix:
    """Bit-planes of a sequence of ids, most significant bit first; below
    each plane the zeros come before the ones, both in their order."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes
        self._ranks()

    def _ranks(self) -> None:
        self.zeros, self.steps = [], []
        per_step = _STEP // 8
        for plane in self.planes:
            ones = np.bitwise_count(plane).astype(np.int64)
            pad = -len(ones) % per_step
            sums = np.pad(ones, (0, pad)).reshape(-1, per_step).sum(axis=1)
            self.steps.append(np.concatenate([[0], np.cumsum(sums)]))
            self.zeros.append(self.n - int(ones.sum()))

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"id {int(ids.max())} does not fit into {bits} bits")
        level, planes = ids.astype(np.uint16 if bits <= 16 else np.uint32), []
        for shift in range(bits - 1, -1, -1):
            bit = (level >> shift & 1).astype(bool)
            planes.append(np.packbits(bit))
            level = np.concatenate([level.compress(~bit), level.compress(bit)])
        return cls(len(ids), planes)

    def to_bytes(self) -> bytes:
        head = struct.pack("<4sQI", _MAGIC, self.n, len(self.planes))
        ranks = np.concatenate(self.steps).astype("<u4").tobytes()
        return head + zstandard.compress(b"".join(p.tobytes() for p in self.planes) + ranks, 3)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, n, bits = struct.unpack_from("<4sQI", data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix block")
        body = zstandard.decompress(data[16:])
        size = -(-n // 8)
        steps = -(-size // (_STEP // 8)) + 1
        self = cls.__new__(cls)
        self.n = n
        self.planes = [np.frombuffer(body, np.uint8, size, i * size) for i in range(bits)]
        ranks = np.frombuffer(body, "<u4", bits * steps, bits * size).reshape(bits, steps)
        self.steps = list(ranks.astype(np.int64))
        self.zeros = [n - int(r[-1]) for r in self.steps]
        return self

    def _ones(self, plane: int, at: int) -> int:
        """Ones among the first ``at`` bits of a plane."""
        step, bits = at // _STEP, self.planes[plane]
        lo, hi = step * _STEP // 8, at // 8
        total = int(self.steps[plane][step]) + int(np.bitwise_count(bits[lo:hi]).sum())
        return total + (int(bits[hi]) >> (8 - at % 8)).bit_count() if at % 8 else total

    def access(self, i: int) -> int:
        value = 0
        for p, bits in enumerate(self.planes):
            bit = bits[i // 8] >> (7 - i % 8) & 1
            value = value << 1 | int(bit)
            i = self.zeros[p] + self._ones(p, i) if bit else i - self._ones(p, i)
        return value

    def _range(self, value: int, stop: int) -> tuple[int, int]:
        lo, hi, bits = 0, stop, len(self.planes)
        if value >> bits:
            return 0, 0
        for p in range(bits):
            if value >> (bits - 1 - p) & 1:
                lo, hi = (self.zeros[p] + self._ones(p, x) for x in (lo, hi))
            else:
                lo, hi = (x - self._ones(p, x) for x in (lo, hi))
        return lo, hi

    def rank(self, value: int, stop: int) -> int:
        """Occurrences of ``value`` among the first ``stop`` ids."""
        lo, hi = self._range(value, stop)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """Position of the occurrence number ``k`` (from 0) of ``value``."""
        lo, hi = self._range(value, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i, bits = lo + k, len(self.planes)
        for p in range(bits - 1, -1, -1):
            one = value >> (bits - 1 - p) & 1
            wanted = i - self.zeros[p] if one else i
            i = self._select_bit(p, one, wanted)
        return i

    def _select_bit(self, plane: int, one: int, k: int) -> int:
        steps = self.steps[plane]
        before = steps if one else np.arange(len(steps)) * _STEP - steps
        step = int(np.searchsorted(before, k, side="right")) - 1
        lo = step * _STEP
        bits = np.unpackbits(self.planes[plane][lo // 8:(lo + _STEP) // 8])[:self.n - lo]
        return lo + int(np.flatnonzero(bits == one)[k - int(before[step])])

    def decode(self) -> np.ndarray:
        """All ids, undoing the planes from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        level = np.zeros(self.n, kind)
        for p in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[p], count=self.n).view(bool)
            above = np.empty(self.n, kind)
            above[~bit] = level[:self.zeros[p]]
            above[bit] = level[self.zeros[p]:] | kind(1 << (len(self.planes) - 1 - p))
            level = above
        return level


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int = 1, spaces: bool = False,
                      bits: int = 16, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The blocks of ``docs`` (``doc_id``, ``text``), written and read back.
    ``bits``: ids are below ``2 ** bits``; a greater one is an error."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before, enc = TaskContext.get().partitionId(), 0, encoder(vocabulary, spaces)
        end = np.uint32(end_id).astype("<u4").tobytes()
        ids, sizes, parts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(parts), "<u4").astype(np.uint32), bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([matrix.to_bytes()], pa.binary())],
                ["shard", "before", "n_tokens", "doc_ids", "doc_tokens", "matrix"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = enc.ids([text])[0] + end
                ids.append(doc)
                sizes.append(len(data) // 4)
                parts.append(data)
                held += sizes[-1]
                if held >= block_tokens:
                    yield block()
                    before, ids, sizes, parts, held = before + held, [], [], [], 0
        if ids:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = (rows.repartitionByRange(F.asc("doc_id"))
               .sortWithinPartitions(F.asc("doc_id"), text_hash(F.col("text")), "text"))
    return written(ordered.mapInArrow(blocks, _BLOCKS), "wavelet")


def read_documents(files: DataFrame) -> DataFrame:
    """Per document, from the files alone: ``start`` (ids of all documents
    before it), ``n_tokens`` and its ``ids`` (little-endian 32-bit)."""
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    offsets = exclusive_prefix(totals, "shard", "n", "shard_offset")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, docs, sizes, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids = WaveletMatrix.from_bytes(data).decode().astype("<u4").tobytes()
                size = np.array(sizes, np.int64)
                stop = np.cumsum(size)
                cuts = [ids[4 * a:4 * b] for a, b in zip((stop - size).tolist(), stop.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(at + stop - size), pa.array(size),
                     pa.array(cuts, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    # offsets has one row (16 bytes) per shard
    return (files.join(F.broadcast(offsets), "shard")
            .select((F.col("before") + F.col("shard_offset")).alias("at"), "doc_ids", "doc_tokens", "matrix")
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary"))


def count_tokens(files: DataFrame, token_ids: list[int]) -> DataFrame:
    """``token_id`` and its ``occurrences`` in all files, by rank."""
    token_ids = sorted(set(token_ids))

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                matrix = WaveletMatrix.from_bytes(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token_ids, pa.int64()),
                     pa.array([matrix.rank(t, matrix.n) for t in token_ids], pa.int64())],
                    ["token_id", "n"])

    return (files.select("matrix").mapInArrow(ranks, "token_id long, n long")
            .groupBy("token_id").agg(F.sum("n").alias("occurrences")))


def find_token(files: DataFrame, token_id: int) -> DataFrame:
    """``shard`` and ``position`` in the shard of every occurrence, by select."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                matrix = WaveletMatrix.from_bytes(data)
                n = matrix.rank(token_id, matrix.n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int64()),
                     pa.array([before + matrix.select(token_id, k) for k in range(n)], pa.int64())],
                    ["shard", "position"])

    return files.select("shard", "before", "matrix").mapInArrow(places, "shard long, position long")

"""MinHash fingerprints of documents.

A signature is the minimum of ``PERMUTATIONS`` universal hash functions
(multiply, add; 64 bits) over a text's five-word shingles, all in vectorised
numpy: word hashes come from prefix sums of a polynomial over the text's bytes,
shingle hashes from sums over five word hashes.  A component is 16 bits of its
minimum mixed anew, as the upper bits of a long text's minima are all near
zero; different minima agree with probability 2^-16, whatever the length.  The
share of equal components estimates the Jaccard likeness of the shingle sets.

``similar`` joins signature bands in Spark and verifies the Jaccard likeness
of every candidate on the texts themselves.  ``edit_report`` compares every
document with its successor in descending id order and with a text edited from
both: rows are range-partitioned, so a successor is the next row of the task,
and the one pair on either side of each partition end is a boundary record.

Defined results: words are those between ASCII white space, with A-Z
lower-cased; fewer than five words are one shingle; a null text is an empty
one, all of whose components are the largest value (likeness 1 to another
empty text, next to 0 to others); rows with one id are ordered by the hash of the text
and the text, a null id comes last; a single row is its own successor; an
empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_hash, written

SHINGLE_WORDS = 5
PERMUTATIONS = 128
BANDS = 32
THRESHOLD = 0.8
_SEED = 20240229
_CHUNK = 1 << 18
_U = np.uint64
_BASE, _STEP = 0x100000001B3, 0x9E3779B97F4A7C15  # odd, so invertible

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += _U(1)

_rng = np.random.default_rng(_SEED)
_A = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * _U(2) + _U(1)
_B = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * _U(2) + _rng.integers(0, 2, PERMUTATIONS, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, 1 << 12)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), 1 << 12)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSE
    if n > len(_POWERS):
        _POWERS = _powers(_BASE, 2 * n)
        _INVERSE = _powers(pow(_BASE, -1, 1 << 64), 2 * n)
    return _POWERS, _INVERSE


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words in ``data`` (bytes)."""
    word = ~_SPACE[data]
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    powers, inverse = _tables(len(data) + 1)
    sums = np.concatenate([[_U(0)], np.cumsum(_LOWER[data] * powers[:len(data)])])
    return _mixed((sums[stop] - sums[start]) * inverse[start])


def shingle_hashes(text: str | None) -> np.ndarray:
    """Upper 32 bits of the shingles' hashes, as unsigned 64-bit numbers."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    parts, at = [], 0
    while at < len(data):  # bounded tables for very long texts
        stop = min(len(data), at + _CHUNK)
        while stop < len(data) and not _SPACE[data[stop]]:
            gap = np.flatnonzero(_SPACE[data[stop:stop + _CHUNK]])
            stop = stop + int(gap[0]) if len(gap) else min(len(data), stop + _CHUNK)
        parts.append(_word_hashes(data[at:stop]))
        at = stop
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(words):
        return words
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE_WORDS, len(words))):
        total = total * _U(_STEP) + words[k:k + n]
    return _mixed(total + _U(min(SHINGLE_WORDS, len(words)))) >> _U(32)


def signature(text: str | None) -> np.ndarray:
    """16 bits of each of ``PERMUTATIONS`` minima; all set without shingles."""
    x = shingle_hashes(text)
    if not len(x):
        return np.full(PERMUTATIONS, 0xFFFF, "<u2")
    least = np.full(PERMUTATIONS, ~_U(0))
    buffer = np.empty((min(len(x), 1024), PERMUTATIONS), np.uint64)
    for at in range(0, len(x), 1024):
        part = buffer[:min(1024, len(x) - at)]
        np.multiply.outer(x[at:at + 1024], _A, out=part)
        part += _B
        np.minimum(least, part.min(axis=0), out=least)
    return (_mixed(least) & _U(0xFFFF)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as many of the
    first characters of ``following``, or all of them."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_REPORT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")
_PASS = ("part long, first_id long, first_text string, last_id long, last_text string, " + _REPORT)


def _compared(doc_id: int | None, text: str, mine: np.ndarray, following: str, its: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = signature(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
            mine.tobytes().hex(), other.tobytes().hex(), likeness(mine, other), likeness(mine, its))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      [n for n, _ in fields])


def edit_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: length, fingerprints of its text and of the text
    edited with its successor's, and their likeness."""
    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last = TaskContext.get().partitionId(), None, None
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                mine = signature(text)
                if last is None:
                    first = (doc, text)
                else:
                    out.append((part, None, None, None, None, *_compared(*last, text, mine)))
                last = (doc, text, mine)
            yield _batch(out, _PASS)
        if first is not None:
            yield _batch([(part, *first, *last[:2], *(None,) * 7)], _PASS)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([_compared(doc, text, signature(text), following, signature(following))
                          for doc, text, following in zip(*(c.to_pylist() for c in batch.columns))], _REPORT)

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(F.desc("doc_id"))
               .sortWithinPartitions(F.desc("doc_id"), text_hash(F.col("text")), "text"))
    rows = written(ordered.mapInArrow(passed, _PASS), "minhash")
    # one boundary record per partition; the window sees their numbers only
    boundary = rows.where("last_text is not null")
    order = Window.orderBy("part")
    after = boundary.select("part", F.lead("part").over(order).alias("after"),
                            F.first("part").over(order).alias("start"))
    pairs = (boundary.select("part", "last_id", "last_text").join(after, "part")
             .withColumn("next_part", F.coalesce("after", "start"))
             .join(boundary.select(F.col("part").alias("next_part"), "first_text"), "next_part")
             .select("last_id", "last_text", "first_text"))
    whole = rows.where("last_text is null").select(*[f.split()[0] for f in _REPORT.split(", ")])
    return whole.unionByName(pairs.mapInArrow(ends, _REPORT))


def similar(queries: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (``query_id``, ``doc_id``, ``jaccard``) of a stated query set and
    all of ``docs`` with at least ``threshold`` in common.  Bands are joined
    between distinct texts and each candidate pair is verified once on the
    exact shingle sets; copies are then expanded by their text's hash."""
    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = PERMUTATIONS // BANDS
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bands = signature(text).reshape(BANDS, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * BANDS, pa.int64()), pa.array(range(BANDS), pa.int32()),
                     pa.array([b.tobytes() for b in bands], pa.binary())], ["h", "band", "key"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for q, d, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.unique(shingle_hashes(x)), np.unique(shingle_hashes(y))
                common = len(np.intersect1d(a, b, assume_unique=True))
                total = len(a) + len(b) - common
                out.append((q, d, common / total if total else 1.0))
            yield _batch(out, "q long, d long, jaccard double")

    def texts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = df.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"), text_hash(F.col("text")).alias("h"))
        return rows.select("doc_id", "h"), rows.groupBy("h").agg(F.first("text").alias("text"))

    q_ids, q_texts = texts(queries)
    d_ids, d_texts = texts(docs)
    schema = "h long, band int, key binary"
    pairs = (q_texts.mapInArrow(banded, schema).withColumnRenamed("h", "q")
             .join(d_texts.mapInArrow(banded, schema).withColumnRenamed("h", "d"), ["band", "key"])
             .select("q", "d").distinct())
    checked = (pairs.join(q_texts.toDF("q", "x"), "q").join(d_texts.toDF("d", "y"), "d")
               .select("q", "d", "x", "y").mapInArrow(verified, "q long, d long, jaccard double")
               .where(F.col("jaccard") >= threshold))
    return (checked.join(q_ids.toDF("query_id", "q"), "q").join(d_ids, F.col("d") == F.col("h"))
            .select("query_id", "doc_id", "jaccard"))

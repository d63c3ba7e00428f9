"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct 64-bit fingerprint emits all variants within half the radius
and shuffles on them.  An odd radius has no integer half, so its middle bit is
taken by leaving out one of four 16-bit blocks: of two fingerprints at most 3
bits apart, one block holds at least one of the differing bits, and outside it
(or, if all three share a block, with none outside it) the rest meets halfway.

1. Ball: for each block, the other 48 bits and their 48 one-bit variants.
   Only variants on which two different fingerprints meet go on.
2. Middle points: such a meeting puts back the left-out block and its
   one-bit variants (up to two bits where the others are untouched).  Each
   result is a 64-bit point at most 2 bits from the fingerprint.  All
   fingerprints within 1 bit of a point are at most 2 apart and those within 2
   bits of it at most 3 from each of them: every fingerprint of the point is
   linked to its least near one, never pair by pair, and each link is verified
   by its bit distance.  Every pair at most 3 apart meets in such a point.
3. Connected components of the links; copies share a fingerprint and are one
   node throughout.

Defined results: a null text is an empty one; a text without words has the
fingerprint zero and links like any other; repeated rows are copies; an empty
table gives no rows; a null id belongs to its component but never names one
unless it is alone there; other columns, whatever their names, are ignored by
``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import connected_components, written

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_BLOCK = 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a text: A-Z lower-cased, words between ASCII
    white space, shingles of words joined by one space (fewer words: all of
    them), each counted as often as it occurs."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle_words + 1)
    if n == 1:
        return _signed(xxh64_intdigest(joined, SEED))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ends = (starts[shingle_words:] - 1).tolist()
    hashes = np.fromiter([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends)],
                         np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded for very long texts
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle_words) for t in texts], dtype="int64")

    return of(text)


def _literals(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _rotated(x: Column, bits: Column) -> Column:
    """``x`` rotated to the left by 0 to 63 ``bits``."""
    return F.call_function("shiftleft", x, bits).bitwiseOR(
        F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", x, F.lit(1)), 63 - bits))


def links(fingerprints: DataFrame) -> DataFrame:
    """``a`` and ``b`` (longs) linking all of ``fingerprints`` (distinct longs
    in column ``fp``) that are connected over pairs at most 3 bits apart."""
    spark = fingerprints.sparkSession
    low = F.lit((1 << _BLOCK) - 1)
    flips = F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(64 - _BLOCK)]
    # a row is a key (48 bits of a variant, 2 of the block's number) and a
    # code (the left-out block, 6 bits for the flipped bit)
    blocks = (fingerprints.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "fp")
              .select(F.explode(F.array(*[F.struct(
                  F.lit(b).alias("block"), _rotated(F.col("fp"), F.lit((64 - _BLOCK * b) % 64)).alias("turned"))
                  for b in range(64 // _BLOCK)])).alias("x")).select("x.*"))
    rest, left = F.shiftrightunsigned("turned", _BLOCK), F.col("turned").bitwiseAND(low).cast("int")
    ball = (blocks.select("block", rest.alias("rest"), left.alias("left"), F.posexplode(F.array(*flips)))
            .select(F.shiftleft(F.col("rest").bitwiseXOR(F.col("col")), 2).bitwiseOR(F.col("block").cast("long"))
                    .alias("key"),
                    F.col("left").bitwiseOR(F.shiftleft(F.col("pos"), _BLOCK)).alias("code")))
    same = Window.partitionBy("key")
    own = F.col("code").bitwiseAND(low)
    met = (ball.select("key", "code", F.min("code").over(same).alias("lo"), F.max("code").over(same).alias("hi"),
                       (F.min(own).over(same) != F.max(own).over(same)).alias("differ"))
           .where("lo <> hi"))

    def inside(most: int) -> Column:
        bits = [1 << i for i in range(_BLOCK)]
        return _literals([0, *bits, *([x | y for i, x in enumerate(bits) for y in bits[:i]] if most > 1 else [])])

    flipped = F.shiftrightunsigned("code", _BLOCK)
    variant = F.shiftrightunsigned("key", 2)
    back = (F.col("key").bitwiseAND(F.lit(3)) * _BLOCK).cast("int")
    whole = F.shiftleft(variant, _BLOCK).bitwiseOR(own.cast("long"))
    flip = F.element_at(F.array(*flips), flipped + 1)
    # where all of a meeting share the left-out block, it needs no variants
    masks = F.when(~F.col("differ"), _literals([0])).when(flipped == 0, inside(2)).otherwise(inside(1))
    points = (met.select(_rotated(whole.bitwiseXOR(F.shiftleft(flip, _BLOCK)), back).alias("fp"),
                         whole.alias("whole"), back.alias("back"), F.explode(masks).alias("mask"))
              .select("fp", _rotated(F.col("whole").bitwiseXOR(F.col("mask")), F.col("back")).alias("point"))
              .distinct())
    is_near = F.bit_count(F.col("fp").bitwiseXOR(F.col("point"))) <= 1
    hub = F.min(F.when(is_near, F.col("fp"))).over(Window.partitionBy("point"))
    return (points.select("fp", hub.alias("hub")).where("fp <> hub")
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= MAX_BITS)
            .select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct())


def components(rows: DataFrame) -> DataFrame:
    """``fp`` and ``component`` (a fingerprint) for the fingerprints of
    ``rows`` that link to another one."""
    distinct = written(rows.select("fp").distinct(), "fingerprints")
    return connected_components(links(distinct), "a", "b").select(
        F.col("node").alias("fp"), "component")


def _identity() -> tuple[Column, Column]:
    """Key of a row: its id (0 for null) and a hash of whether the id is null
    and of the text, a null text counting as empty."""
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            F.xxhash64(F.col("doc_id").isNull(), F.coalesce(F.col("text"), F.lit(""))))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the least ``doc_id`` reachable over links."""
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               fingerprint(F.col("text"), shingle_words).alias("fp")), "simhash")
    # one row per fingerprint: copies are gathered before anything is joined
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = written(classes.join(components(rows), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")), "classes")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "component").select("fp", "component_id")
    return rows.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component:
    that of the least id (among rows of one id, of the least text hash; among
    equal rows, one of them; a null id comes last)."""
    key, h = _identity()
    rows = written(docs.select(F.col("doc_id").isNull().alias("no_id"), key.alias("id"), h.alias("h"),
                               fingerprint(F.col("text"), shingle_words).alias("fp")), "simhash")
    classes = rows.groupBy("fp").agg(F.min(F.struct("no_id", "id", "h")).alias("first"))
    kept = (classes.join(components(rows), "fp", "left")
            .groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("first"))
            .select(F.col("first.id").alias("_id"), F.col("first.h").alias("_h")).distinct())
    names = docs.columns
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("_row"),
                        key.alias("_id"), h.alias("_h"))
    one = Window.partitionBy("_id", "_h").orderBy("_id")
    return (keyed.join(kept, ["_id", "_h"], "left_semi")
            .withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*"))

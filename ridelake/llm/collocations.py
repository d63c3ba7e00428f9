"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into shards that are scanned in turn, over and over.  The
first scans count single words only; as soon as both parts of a longer phrase
(all but its last word, all but its first) have reached the threshold, it is
counted too, from the next scan on, so scans interleave lengths.  A phrase is
counted for as many scans as there are shards -- one full cycle, whichever
shard it started at -- and then done; the scans end when nothing is active.

What a scan has to know is which parts reached the threshold, and when.  That
is kept by hashed slots: ``1 << SLOT_BITS`` of them however large the corpus
is, so the broadcast is bounded.  Two phrases in one slot make a phrase active
too early, which costs counting and never a result, for its own start is fixed
by the slots and it still gets a full cycle.  Counts of active phrases meet by
hashed keys in buckets of sorted, packed arrays; a phrase is dropped when its
cycle is over.  Equal keys can only add counts, so they too cost work and never
a result: one last scan counts, by their words, the phrases whose slot is
taken, and those counts are the results.

Defined results: a null text is an empty one; a null language is ``und``;
texts of null, equal or repeated ids count each as often as they occur; no
words, or an empty table, give no rows; columns other than text and language
are ignored.  A very long text is cut where a piece ends, else kept whole.
Ties in the ranking are broken by the phrase itself, which is unique.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..plans.broadcast import broadcast_if_small
from .common import scratch_folder, written

LEAST = 30
LONGEST = 4
TOP = 2000
# A longer phrase that has at least this share (per cent) of a phrase's
# occurrences takes its place.
WITHIN_PERCENT = 80
SHARDS = 3
SLOT_BITS = 25
# Text a Python worker works on at once.
CHUNK_BYTES = 4 << 20
# Counts a Python worker holds before it hands them on, and the text that makes
# one bucket of counts.
HELD_COUNTS = 2_000_000
BUCKET_BYTES = 8 << 20
# The same of the last scan, which counts by words.
HELD_PHRASES = 1_000_000
PHRASE_BYTES = 32 << 20
# Parts of more phrases than this, or this share of all cuts, are joined by
# broadcast; at most ``_HOT_PARTS`` can be.
_MANY_CUTS, _HOT_PARTS = 1000, 10000

_NEVER = np.int16(1 << 12)
_UNDEFINED = "und"
_BREAK = b".,;:!?\n\x0b\x0c\r"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: blank, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(_BREAK)] = 2
_PLACES = np.random.default_rng(20240229).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The 64 bits of each value mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: ``array`` of them, the ``text`` each lies in,
    its hash ``key`` (with the language's salt), and whether the ``next`` one
    continues its piece."""

    def __init__(self, texts: list[bytes], salts: np.ndarray):
        data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        kind = _KIND[data]
        inside = kind == 0
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        start, end = edges[0::2], edges[1::2]
        piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        self.next = piece[1:] == piece[:-1]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.text = np.searchsorted(ends, start, side="right")
        stops = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        self.array = pa.Array.from_buffers(pa.binary(), len(start),
                                           [None, pa.py_buffer(stops), pa.py_buffer(data[inside])])
        coded = self.array.dictionary_encode()
        own = _hashed(coded.dictionary)
        self.key = _mixed(own[coded.indices.to_numpy()] + salts[self.text])

    def phrases(self, at: np.ndarray, words: int) -> pa.Array:
        parts = [self.array.take(pa.array(at + k)) for k in range(words)]
        return (parts[0] if words == 1 else pc.binary_join_element_wise(*parts, b" ")).cast(pa.string())


def _hashed(words: pa.BinaryArray) -> np.ndarray:
    """A 64-bit hash of each word."""
    stops = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[stops[0]:stops[-1]]
    first = stops[:-1] - stops[0]
    place = np.arange(len(data)) - np.repeat(first, np.diff(stops))
    return np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _PLACES[place & 4095], first)


def _slot(key: np.ndarray, words: int) -> np.ndarray:
    """Slot of each phrase; a quarter of the slots is for each length."""
    return ((words - 1 & 3) << SLOT_BITS - 2) + (key >> np.uint64(66 - SLOT_BITS)).astype(np.int64)


def _levels(words: Words, reached: np.ndarray, longest: int) -> Iterator[tuple]:
    """Per length, of the phrases both of whose parts have reached the
    threshold (or their slots say so): their places, their keys, the scan each
    is active from, and the scan at whose end it had reached it itself."""
    key = words.key
    at, active = np.arange(len(key)), np.zeros(len(key), np.int16)
    when = reached[_slot(key, 1)]
    yield 1, at, key, active, when
    for n in range(2, longest + 1):
        if len(when) < 2:
            return
        known = (when[:-1] < _NEVER) & (when[1:] < _NEVER)
        at = np.flatnonzero(known & words.next if n == 2 else known)
        active = np.maximum(when[at], when[at + 1]) + np.int16(1)
        own = _mixed(key[at] * np.uint64(0x9E3779B97F4A7C15) + key[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F))
        reach = np.maximum(reached[_slot(own, n)], active)
        yield n, at, own, active, reach
        key, when = np.zeros(len(when) - 1, np.uint64), np.full(len(when) - 1, _NEVER, np.int16)
        key[at], when[at] = own, reach


def _table(taken: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Scan at which each slot was taken."""
    out = np.full(1 << SLOT_BITS, _NEVER, np.int16)
    out[taken[0]] = taken[1]
    return out


# --- packed counts: 46 bits of a phrase's key, 2 of its length, 16 of its count

_MOST = (1 << 16) - 1


def _entries(key: np.ndarray, words: int) -> np.ndarray:
    """Sorted entries of the distinct keys."""
    key = np.sort((key >> np.uint64(18) << np.uint64(2)) | np.uint64(words - 1 & 3))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.minimum(np.diff(np.append(first, len(key))), _MOST).astype(np.uint64)
    return key[first] << np.uint64(16) | n


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """Entries with the counts of equal keys added up (``_MOST`` at most)."""
    if len(parts) == 1:
        return parts[0]
    all_of = np.sort(np.concatenate(parts))
    key = all_of >> np.uint64(16)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.add.reduceat((all_of & np.uint64(_MOST)).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return key[first] << np.uint64(16) | np.minimum(n, _MOST).astype(np.uint64)


def _packed(entries: np.ndarray) -> bytes:
    """Sorted entries byte plane by byte plane: the high ones hardly change."""
    return zstandard.compress(np.ascontiguousarray(entries.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``CHUNK_BYTES``, cut only between pieces."""
    while len(text) > 2 * CHUNK_BYTES:
        cut = max(text.rfind(c.to_bytes(), 0, CHUNK_BYTES) for c in _BREAK) + 1
        if not cut:
            cut = min((i + 1 for i in (text.find(c.to_bytes(), CHUNK_BYTES) for c in _BREAK) if i >= 0),
                      default=len(text))
        yield text[:cut]
        text = text[cut:]
    yield text


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], Words]]:
    """Languages of some texts and their words, bounded by bytes."""
    from xxhash import xxh64_intdigest

    salt_of: dict[str, int] = {}

    def made(texts: list[bytes], langs: list[str]) -> tuple[list[str], Words]:
        for lang in set(langs):
            if lang not in salt_of:
                salt_of[lang] = xxh64_intdigest(lang.encode("utf-8", "replace"))
        return langs, Words(texts, np.array([salt_of[lang] for lang in langs], np.uint64))

    texts, langs, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for part in _pieces(text or b""):
                texts.append(part)
                langs.append(lang)
                size += len(part) + 1
                if size >= CHUNK_BYTES:
                    yield made(texts, langs)
                    texts, langs, size = [], [], 0
    if texts:
        yield made(texts, langs)


_COUNTS = "bucket int, since int, data binary"


def _scan(shard: DataFrame, step: int, taken: tuple, shards: int, longest: int, bits: int) -> DataFrame:
    """Packed counts of the active phrases of a shard, per ``bucket`` (the
    first ``bits`` of the key) and scan they are active ``since``."""
    shared = shard.sparkSession.sparkContext.broadcast(taken)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, held, size = _table(shared.value), {}, 0
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

        def rows() -> pa.RecordBatch:
            out = []
            for since, parts in held.items():
                entries = _merged(parts)
                cuts = [0, *np.searchsorted(entries, edges).tolist(), len(entries)]
                out += [(k, since, _packed(entries[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            return _batch(out)

        for _, words in _chunks(batches):
            for n, _, key, active, _ in _levels(words, reached, longest):
                for since in range(max(0, step - shards + 1), step + 1):
                    now = key if n == 1 and since == 0 else key[active == since] if n > 1 else key[:0]
                    if len(now):
                        held.setdefault(since, []).append(_entries(now, n))
                        size += len(held[since][-1])
            if size > HELD_COUNTS:
                yield rows()
                held, size = {}, 0
        if held:
            yield rows()

    return shard.mapInArrow(count, _COUNTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      ["bucket", "since", "data"])


def _together(counts: DataFrame, step: int, shards: int, least: int) -> DataFrame:
    """Counts added up per bucket and start; ``slots`` of the phrases that have
    reached the threshold.  A bucket holds a bounded share of the keys.  Where
    the cycle is over, the counts themselves go."""
    def add(key: tuple, rows: pa.Table) -> pa.Table:
        parts: dict[int, list] = {}
        for since, data in zip(rows.column("since").to_pylist(), rows.column("data").to_pylist()):
            parts.setdefault(since, []).append(_unpacked(data))
        out = []
        for since, of in parts.items():
            entries = _merged(of)
            high = entries[(entries & np.uint64(_MOST)) >= least] >> np.uint64(16)
            slots = ((high & np.uint64(3)).astype(np.int64) << SLOT_BITS - 2) + (
                high >> np.uint64(2 + 48 - SLOT_BITS)).astype(np.int64)
            open_still = since + shards - 1 > step
            out.append((since, _packed(entries) if open_still else b"", np.unique(slots).astype(np.int32).tobytes()))
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "since": pa.array([o[0] for o in out], pa.int32()),
                         "data": pa.array([o[1] for o in out], pa.binary()),
                         "slots": pa.array([o[2] for o in out], pa.binary())})

    return counts.groupBy("bucket").applyInArrow(add, _COUNTS + ", slots binary")


_FOUND = "bucket int, langs array<string>, sizes array<int>, phrases binary, counts binary"


def _by_words(docs: DataFrame, taken: tuple, longest: int, least: int, bits: int) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``f`` of the phrases whose slot is
    taken and that occur ``least`` times; a row of 0 words has all words of its
    language as ``f``.  Phrases go to buckets by the first ``bits`` of their
    key, sorted and packed, and are added up there by their words."""
    shared = docs.sparkSession.sparkContext.broadcast(taken)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, held, size = _table(shared.value), [], 0
        code_of: dict[str, int] = {}

        def group(key: np.ndarray, code: np.ndarray) -> np.ndarray:
            return (key >> np.uint64(64 - bits)).astype(np.int64) << 32 | code

        for langs, words in _chunks(batches):
            code = np.array([code_of.setdefault(lang, len(code_of)) for lang in langs], np.int64)[words.text]
            # all words of a language: an empty phrase, which no other is
            of, n = np.unique(code, return_counts=True)
            names = list(code_of)
            key = np.array([zlib.crc32(names[c].encode("utf-8", "replace")) << 32 for c in of], np.uint64)
            held.append(_held(group(key, of), pa.array([""] * len(of), pa.string()), n))
            for n, at, key, _, when in _levels(words, reached, longest):
                known = np.flatnonzero(when < _NEVER)
                at, key = at[known], key[known]
                order = np.argsort(key)
                key = key[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
                at = at[order[first]]
                held.append(_held(group(key[first], code[at]), words.phrases(at, n),
                                  np.diff(np.append(first, len(key)))))
                size += len(at)
            if size > HELD_PHRASES:
                yield _sent(held, list(code_of))
                held, size = [], 0
        if held:
            yield _sent(held, list(code_of))

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        # a task of its own reads it: no threads beside it
        got = (pa.concat_tables([_read(row) for row in rows.to_pylist()]).group_by(["lang", "phrase"], use_threads=False)
               .aggregate([("f", "sum")]))
        phrase = got.column("phrase")
        words = pc.if_else(pc.equal(pc.binary_length(phrase), 0), 0, pc.add(pc.count_substring(phrase, " "), 1))
        out = pa.table({"lang": got.column("lang"), "words": words.cast(pa.int32()), "phrase": phrase,
                        "f": got.column("f_sum")})
        return out.filter(pc.or_(pc.equal(words, 0), pc.greater_equal(out.column("f"), least)))

    return (docs.mapInArrow(count, _FOUND).groupBy("bucket")
            .applyInArrow(add, "lang string, words int, phrase string, f long"))


def _held(group: np.ndarray, phrase: pa.Array, f: np.ndarray) -> pa.Table:
    return pa.table({"group": pa.array(group), "phrase": phrase, "f": pa.array(f.astype(np.int64))})


def _sent(held: list[pa.Table], langs: list[str]) -> pa.RecordBatch:
    """Counts added up by ``group`` (bucket and language) and phrase; a row a
    bucket, its languages one after the other, their phrases in order."""
    table = (pa.concat_tables(held).group_by(["group", "phrase"], use_threads=False).aggregate([("f", "sum")])
             .sort_by([("group", "ascending"), ("phrase", "ascending")]))
    group, f = table.column("group").to_numpy(), table.column("f_sum").to_numpy()
    phrase = table.column("phrase").combine_chunks()
    cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    whole = np.append(np.flatnonzero(np.diff(group[cuts[:-1]] >> 32, prepend=-1)), len(cuts) - 1)
    rows = []
    for a, b in zip(whole, whole[1:]):
        first, last = cuts[a], cuts[b]
        joined = pc.binary_join(pa.ListArray.from_arrays([0, last - first], phrase[first:last]), "\n")[0].as_py()
        rows.append((int(group[first] >> 32), [langs[c] for c in group[cuts[a:b]] & 0xFFFFFFFF],
                     np.diff(cuts[a:b + 1]).tolist(), zstandard.compress(joined.encode(), 3),
                     _packed(f[first:last].astype(np.uint64))))
    kinds = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      ["bucket", "langs", "sizes", "phrases", "counts"])


def _read(row: dict) -> pa.Table:
    """Languages, phrases and counts of one packed row."""
    data = np.frombuffer(zstandard.decompress(row["phrases"]) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    stops = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    phrase = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(stops), pa.py_buffer(data[data != 10])])
    lang = pa.array(row["langs"], pa.string()).take(pa.array(np.repeat(np.arange(len(row["langs"])), row["sizes"])))
    return pa.table({"lang": lang, "phrase": phrase, "f": pa.array(_unpacked(row["counts"]).astype(np.int64))})


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
                     shards: int = SHARDS) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``f`` of every phrase of up to
    ``longest`` words with at least ``least`` occurrences inside pieces, and
    per language a row of 0 words whose ``f`` counts all its words."""
    if not (1 <= least <= _MOST and 1 <= longest <= 4):
        raise ValueError(f"least is 1 to {_MOST}, longest 1 to 4")
    spark = docs.sparkSession
    path = scratch_folder(spark, "phrase-shards")
    text, size = F.coalesce(F.col("text"), F.lit("")), Observation("phrase-shards")
    (docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(_UNDEFINED)).alias("lang"), text.alias("text"),
                 F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
     .observe(size, F.sum(F.octet_length("text")).alias("bytes"))
     .write.option("compression", "zstd").partitionBy("shard").parquet(path))
    # buckets grow with the text, so that what one task adds up does not
    text_bytes = size.get["bytes"] or 0
    bits = min(18, max(4, (text_bytes // BUCKET_BYTES).bit_length()))
    table = spark.read.schema("lang string, text string, shard int").parquet(path)
    slots, steps = np.zeros(0, np.int64), np.zeros(0, np.int16)
    counts, step, end, last = None, 0, shards - 1, [-1] * (longest + 1)
    while step <= end:
        shard = table.where(F.col("shard") == step % shards).select("lang", "text")
        new = _scan(shard, step, (slots, steps), shards, longest, bits)
        both = written(_together(new if counts is None else counts.unionByName(new), step, shards, least), "phrases")
        # bounded by the number of slots
        got = both.where("octet_length(slots) > 0").select("slots").toArrow().column("slots")
        seen = np.unique(np.frombuffer(b"".join(got.to_pylist()), np.int32)).astype(np.int64)
        found = np.setdiff1d(seen, slots)
        slots = np.concatenate([slots, found])
        steps = np.concatenate([steps, np.full(len(found), step, np.int16)])
        for n in (np.unique(found >> SLOT_BITS - 2) + 1).tolist():
            last[n] = step
        # the last scan a phrase can become active for, length by length
        active = 0
        for n in range(2, longest + 1):
            if last[n - 1] < 0:
                break
            active = max(last[n - 1], active) + 1
            end = max(end, active + shards - 1)
        counts = both.where("octet_length(data) > 0").drop("slots")
        step += 1
    # more text a bucket than in the scans: the fewer, the better phrases pack
    bits = min(24, max(1, (text_bytes // PHRASE_BYTES).bit_length()))
    return _by_words(table.select("lang", "text"), (slots, steps), longest, least, bits)


def _frequency_of(rows: DataFrame, part: str, frequent: DataFrame, out: str) -> DataFrame:
    """``rows`` with the frequency ``out`` of the phrase in column ``part``.  A
    word may be part of very many phrases: where the table of phrases is too
    large to broadcast, the few such parts are, and the others are joined by a
    shuffle."""
    found = frequent.select("lang", F.col("phrase").alias(part), F.col("f").alias(out))
    small = broadcast_if_small(found)
    if small is not found:
        return rows.join(small, ["lang", part])
    rows = written(rows, "cuts")
    many = max(_MANY_CUTS, rows.count() // _HOT_PARTS)
    uses = rows.groupBy("lang", part).agg(F.count(F.lit(1)).alias("uses")).where(F.col("uses") > many)
    # bounded: every cut has one such part, so few parts have many cuts
    hot = F.broadcast(uses.drop("uses").join(found, ["lang", part]))
    met = rows.join(hot, ["lang", part], "left")
    rest = met.where(F.col(out).isNull()).drop(out).join(found, ["lang", part])
    return met.where(F.col(out).isNotNull()).unionByName(rest)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 shards: int = SHARDS) -> DataFrame:
    """Per language the ``top`` phrases of two or more words by score: twice a
    phrase's frequency against those of the two parts of its weakest cut,
    without phrases that mostly occur inside a longer one."""
    frequent = written(frequent_phrases(docs, least, longest, shards), "frequent")
    phrases = frequent.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("right"))
    known = frequent.where("words >= 1")
    cuts = _frequency_of(_frequency_of(cuts, "left", known, "l"), "right", known, "r")
    score = F.expr("cast(cast(a as decimal(19, 0)) * 2000000 div (cast(l as decimal(19, 0)) + r) as bigint)")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = (phrases.where("words >= 3").withColumn("w", F.split("phrase", " "))
             .withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
             .withColumn("at", F.explode(F.expr("sequence(1, words - size + 1)")))
             .groupBy("lang", F.array_join(F.expr("slice(w, at, size)"), " ").alias("phrase"))
             .agg(F.max("a").alias("longer")))
    wide = "decimal(38, 0)"
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * WITHIN_PERCENT)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.select("lang", "phrase", "a", "cut.*")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    total = broadcast_if_small(frequent.where("words = 0").select("lang", F.col("f").alias("n")))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

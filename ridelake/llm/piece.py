"""SentencePiece encoding and decoding for merge-type vocabularies.

A text normalised by the vocabulary's own rules becomes symbols; an agenda of
adjacent pairs, ordered by the score of the piece they form and then from the
left, merges the best pair until none is left.  Symbols outside the vocabulary
become their UTF-8 bytes.  Where no piece of the vocabulary holds two symbols
side by side nothing can merge across them, so a text is cut there (before
space marks, and between most words and punctuation) and every distinct segment
is merged once per Python worker.  The segments new in a group of texts are
merged together: those of one length are the rows of a matrix of symbols beside
their agendas, and a round merges the best pair of every row.  Each Arrow batch
is checked against the sentencepiece library's encoding of the whole texts
(``agrees``) and decoded with its ``decode``.

Defined results: a null text is an empty one (the end id alone, decoded to an
empty text); repeated rows are encoded alike; an empty table gives no rows;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound of each of the two generations of the per-worker cache (segments);
# when the younger is full, seen once per group of texts, the older is dropped.  An entry takes about 200 bytes.
CACHE_SEGMENTS = 600_000
# Longest segment the cache keeps.
CACHE_CHARS = 256
# Texts are handed to the library in groups of about so many characters.
_CHECK_CHARS = 1 << 20
# Up to so many symbols the agenda is a plain list, longer ones use a heap.
_LISTED = 48
# Number of code points, and bits of a symbol in the key of a pair.
_CODES = 0x110000
_SHIFT = 32
# So many new segments of one length, up to ``_LISTED`` symbols, are merged together.
_TOGETHER = 32
_NO_PIECE = float("-inf")
_MARK = "▁"
_SEGMENT = re.compile(f"{_MARK}*[^{_MARK}]+|{_MARK}+")


class PieceEncoder:
    """``ids(text)``: the ids of a text with the end id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)
                   for i in range(size)]
        self.pieces = {self.library.id_to_piece(i): (i, self.library.get_score(i))
                       for i in range(size) if not special[i]}
        self.scores = {p: score for p, (_, score) in self.pieces.items()}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end = self.library.eos_id()
        if any(self.library.is_unused(i) for i in range(size)):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.side_by_side = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.cuts = not any(x[1] == _MARK != x[0] for x in self.side_by_side)
        self.cache = _Segments(self, {})
        # In the matrices symbols are ids of pieces, or beyond ``none`` the code points
        # outside the vocabulary; two side by side have a key and the id of their joint.
        self.none = size
        self.symbols = np.arange(size + 1, size + 1 + _CODES, dtype=np.int32)
        for p, (i, _) in self.pieces.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        pairs = {(self.pieces[p[:k]][0] << _SHIFT) + self.pieces[p[k:]][0]: i for p, (i, _) in self.pieces.items()
                 for k in range(1, len(p)) if p[:k] in self.pieces and p[k:] in self.pieces}
        self.pair_keys = np.array([*sorted(pairs), np.iinfo(np.int64).max], np.int64)
        self.pair_joints = np.array([*(pairs[k] for k in sorted(pairs)), size], np.int32)
        self.joint_scores = np.full(size + 1, _NO_PIECE, np.float32)
        for i, score in self.pieces.values():
            self.joint_scores[i] = score

    def _joints(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the pieces that symbols form, ``none`` where they form none."""
        key = (left.astype(np.int64) << _SHIFT) + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_joints[at], np.int32(self.none))

    def merged_together(self, segments: list[str]) -> Iterator[tuple[str, bytes]]:
        """Segments of one length with their ids."""
        n = len(segments[0])
        part = self.symbols[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4").reshape(-1, n)]
        row = np.arange(len(segments))
        agenda = self._joints(part[:, :-1], part[:, 1:])
        while n > 1 and len(row):
            # the leftmost of the best pairs of every row; rows have one width in each round
            best = self.joint_scores[agenda].argmax(1)
            joint = agenda[np.arange(len(row)), best]
            more = joint != self.none
            if not more.all():
                yield from self._packed(segments, row[~more], part[~more])
                row, part, agenda, best, joint = row[more], part[more], agenda[more], best[more], joint[more]
            n -= 1
            column = np.arange(n)
            part = np.where(column <= best[:, None], part[:, :-1], part[:, 1:])
            part[np.arange(len(row)), best] = joint
            agenda = np.where(column[:-1] < best[:, None], agenda[:, :-1], agenda[:, 1:])
            has = np.flatnonzero(best < n - 1)
            agenda[has, best[has]] = self._joints(joint[has], part[has, best[has] + 1])
            has = np.flatnonzero(best > 0)
            agenda[has, best[has] - 1] = self._joints(part[has, best[has] - 1], joint[has])
        yield from self._packed(segments, row, part)

    def _packed(self, segments: list[str], row: np.ndarray, part: np.ndarray) -> Iterator[tuple[str, bytes]]:
        """Segments (numbered by ``row``) whose symbols are merged."""
        packed, width = part.tobytes(), part.shape[1] * part.itemsize
        known = (part < self.none).all(1).tolist()
        for k, i in enumerate(row.tolist()):
            if known[k]:
                yield segments[i], packed[k * width:(k + 1) * width]
            else:
                ids: list[int] = []
                for x in part[k].tolist():
                    ids += [x] if x < self.none else [self.bytes[b] for b in chr(x - self.none - 1).encode()]
                yield segments[i], _pack(ids)

    def merged(self, symbols: str) -> bytes:
        """Ids of one segment."""
        part = self._listed(symbols) if len(symbols) <= _LISTED else self._heaped(symbols)
        out: list[int] = []
        for p in part:
            found = self.pieces.get(p)
            if found:
                out.append(found[0])
            else:
                out += [self.bytes[b] for b in p.encode()]
        return _pack(out)

    def _listed(self, symbols: str) -> list[str]:
        """Merged parts; the agenda holds the score of every two neighbours,
        and the best is searched for."""
        score = self.scores.get
        part = list(symbols)
        agenda = list(map(score, map(add, part, part[1:]), repeat(_NO_PIECE)))
        while agenda and (best := max(agenda)) != _NO_PIECE:
            i = agenda.index(best)
            joint = part[i] = part[i] + part.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(joint + part[i + 1], _NO_PIECE)
            if i:
                agenda[i - 1] = score(part[i - 1] + joint, _NO_PIECE)
        return part

    def _heaped(self, symbols: str) -> list[str]:
        """The same with a heap, for long segments."""
        pieces, push, pop = self.pieces, heapq.heappush, heapq.heappop
        part: list[str] = list(symbols)
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(-pieces[joint][1], i, i + 1, joint) for i in range(n - 1)
                  if (joint := symbols[i:i + 2]) in pieces]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, joint = pop(agenda)
            # a pair is stale when either side was merged since it was offered
            if not part[left] or not part[right] or part[left] + part[right] != joint:
                continue
            part[left], part[right] = joint, ""
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                if (wider := joint + part[right]) in pieces:
                    push(agenda, (-pieces[wider][1], left, right, wider))
            right = before[left]
            if right >= 0 and (wider := part[right] + joint) in pieces:
                push(agenda, (-pieces[wider][1], right, left, wider))
        return [p for p in part if p]

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], np.int32).tolist()

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id, as 32-bit integers."""
        plain, end = self.library.normalize(texts), _pack([self.end])
        if not self.cuts:
            return [self.merged(p) + end for p in plain]
        if len(self.cache) > CACHE_SEGMENTS:
            self.cache.older = {}
            self.cache = _Segments(self, self.cache)
        parts = [_parts(p) for p in plain]
        found = [list(map(self.cache.get, p)) for p in parts]
        gaps = [[k for k, ids in enumerate(f) if ids is None] for f in found]
        met = self.cache.meet({p[k] for p, gap in zip(parts, gaps) for k in gap})
        for p, f, gap in zip(parts, found, gaps):
            for k in gap:
                f[k] = met[p[k]]
        return [b"".join(f) + end for f in found]


def _pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _parts(plain: str) -> list[str]:
    """A normalised text cut before its space marks."""
    if _MARK * 2 in plain:
        return _SEGMENT.findall(plain)
    first, *rest = plain.split(_MARK)
    return [first] * bool(first) + [_MARK + p for p in rest]


class _Segments(dict):
    """Ids by segment; one not met before is cut at every place where it can
    be, and its parts are merged.  Longer ones than ``CACHE_CHARS`` are not
    kept, only their parts."""

    def __init__(self, encoder: PieceEncoder, older: dict[str, bytes]):
        self.encoder, self.older = encoder, older

    def meet(self, segments: set[str]) -> dict[str, bytes]:
        """Ids of segments not held: those of one length are merged together,
        longer ones and the few of their length by themselves."""
        met: dict[str, bytes] = {}
        new: dict[int, list[str]] = {}
        for s in segments:
            if len(s) <= _LISTED and s not in self.older:
                new.setdefault(len(s), []).append(s)
            else:
                met[s] = self[s]
        for same in new.values():
            if len(same) >= _TOGETHER:
                merged = dict(self.encoder.merged_together(same))
                self.update(merged)
                met.update(merged)
            else:
                met.update((s, self[s]) for s in same)
        return met

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            joined = self.encoder.side_by_side
            if joined.issuperset(map(add, segment, segment[1:])):
                ids = self.encoder.merged(segment)
            else:
                cuts = [i for i, x in enumerate(map(add, segment, segment[1:]), 1) if x not in joined]
                # the parts have no cuts, so this goes one level deep
                ids = b"".join([self[segment[i:j]] for i, j in zip([0, *cuts], [*cuts, len(segment)])])
        if len(segment) <= CACHE_CHARS:
            self[segment] = ids
        return ids


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= _CHECK_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``ids`` (with the end id), ``decoded``
    text and ``agrees`` (the library's own encoding has the same ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            at = 0
            for texts in _groups([t or "" for t in batch.column(1).to_pylist()]):
                packed = encoder.packed(texts)
                flat = np.frombuffer(b"".join(packed), np.int32)
                ends = np.cumsum([0] + [len(p) // flat.itemsize for p in packed])
                ids = [np.frombuffer(p, np.int32).tolist() for p in packed]
                theirs = encoder.library.encode(texts, add_eos=True, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)),
                     pa.ListArray.from_arrays(ends.astype(np.int32), flat),
                     pa.array(encoder.library.decode(ids, num_threads=1), pa.string()),
                     pa.array([a == b for a, b in zip(ids, theirs)], pa.bool_())],
                    ["doc_id", "ids", "decoded", "agrees"])
                at += len(texts)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, ids array<int>, decoded string, agrees boolean"))

"""Edit-aware token counts.

``trees`` keeps, per document, its text and the leaves of its pre-token
segment tree: characters and tokens of every pre-token.  ``recount`` applies
edits to it.  Leaves lie in chunks, and a binary tree over the chunks holds the
sums of characters and tokens; an edit descends it by characters, re-encodes
the touched leaves with the context up to the next cut that no edit beside it
can move (before white space that follows a word), and updates the sums on the
way to the root.  Tokens are those of the byte-level vocabulary, special
strings counting as ordinary text.

Defined results: a null text is an empty one; edits apply in their order, each
to the text that the ones before it left; positions beyond the text mean its
end, a stop before its start means the start; a null list has no edits and a
null replacement is empty; repeated rows are counted alike; an empty table
gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import byte_alphabet, has_exotic_space, has_space_runs

CHUNK_LEAVES = 64
CACHE_SEGMENTS = 400_000
_WHITE = frozenset(" \t\n\r\x0b\x0c")
_TREES = "doc_id long, text string, n_tokens long, leaves binary"


class Pretokens:
    """Lengths in characters and token counts of a text's pre-tokens."""

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.model = Tokenizer.from_file(path).model
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.alphabet = byte_alphabet()
        self.cache: dict[str, bytes] = {}

    def _leaves(self, text: str) -> bytes:
        out = []
        for piece in self.find(text):
            mapped = "".join(map(self.alphabet.__getitem__, piece.encode("utf-8", "replace")))
            out += [len(piece), len(self.model.tokenize(mapped))]
        return np.array(out, "<u4").tobytes()

    def leaves(self, text: str) -> np.ndarray:
        """One row (characters, tokens) per pre-token."""
        if has_exotic_space(text) or has_space_runs(text):
            data = self._leaves(text)
        else:
            # a single space after a word always starts a pre-token
            parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
            if len(self.cache) > CACHE_SEGMENTS:
                self.cache.clear()
            found = []
            for part in parts:
                leaf = self.cache.get(part)
                if leaf is None:
                    leaf = self.cache[part] = self._leaves(part)
                found.append(leaf)
            data = b"".join(found)
        return np.frombuffer(data, "<u4").reshape(-1, 2)


class TokenTree:
    """The tree of one document."""

    def __init__(self, pretokens: Pretokens, text: str, leaves: np.ndarray):
        self.pretokens = pretokens
        self.encoded = 0  # pre-tokens encoded by edits
        stops = np.cumsum(leaves[:, 0].astype(np.int64))
        self.chunks: list[tuple[str, list[list[int]]]] = []
        for at in range(0, len(leaves), CHUNK_LEAVES):
            last = min(at + CHUNK_LEAVES, len(leaves)) - 1
            begin = int(stops[at - 1]) if at else 0
            self.chunks.append((text[begin:int(stops[last])], leaves[at:last + 1].tolist()))
        if not self.chunks:
            self.chunks.append(("", []))
        self.size = 1 << (len(self.chunks) - 1).bit_length()
        self.sums = [[0, 0] for _ in range(2 * self.size)]
        for i, (part, own) in enumerate(self.chunks):
            self.sums[self.size + i] = [len(part), sum(x[1] for x in own)]
        for i in range(self.size - 1, 0, -1):
            self._add(i)

    def _add(self, node: int) -> None:
        a, b = self.sums[2 * node], self.sums[2 * node + 1]
        self.sums[node] = [a[0] + b[0], a[1] + b[1]]

    @property
    def chars(self) -> int:
        return self.sums[1][0]

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def _chunk(self, position: int) -> tuple[int, int]:
        """Chunk holding a position and the position of the chunk."""
        node, at = 1, 0
        while node < self.size:
            node *= 2
            if position - at >= self.sums[node][0] and self.sums[node + 1][0]:
                at += self.sums[node][0]
                node += 1
        return node - self.size, at

    def _set(self, chunk: int, text: str, leaves: list[list[int]]) -> None:
        self.chunks[chunk] = (text, leaves)
        node = self.size + chunk
        self.sums[node] = [len(text), sum(x[1] for x in leaves)]
        while node > 1:
            node //= 2
            self._add(node)

    @staticmethod
    def _cuts(text: str, leaves: list[list[int]]) -> list[tuple[int, int]]:
        """Leaf number and place of the cuts inside a chunk that hold
        whatever stands around them."""
        out, at = [], 0
        for k, (chars, _) in enumerate(leaves):
            if at and text[at] in _WHITE and not text[at - 1].isspace():
                out.append((k, at))
            at += chars
        return out

    def edit(self, start: int, stop: int, replacement: str) -> None:
        """Replace the characters from ``start`` to ``stop``."""
        start = min(max(start, 0), self.chars)
        stop = min(max(stop, start), self.chars)
        # a cut before the edit, with an untouched character on either side
        first, at = self._chunk(start)
        while True:
            text, leaves = self.chunks[first]
            before = [c for c in self._cuts(text, leaves) if at + c[1] < start]
            if before or first == 0:
                break
            first -= 1
            at -= len(self.chunks[first][0])
        left_leaf, left = before[-1] if before else (0, 0)
        # and one after it
        last, end = self._chunk(stop)
        while True:
            text, leaves = self.chunks[last]
            behind = [c for c in self._cuts(text, leaves) if end + c[1] > stop]
            if behind or last == len(self.chunks) - 1:
                break
            end += len(text)
            last += 1
        right_leaf, right = behind[0] if behind else (len(leaves), len(text))
        tail_text, tail_leaves = text[right:], leaves[right_leaf:]
        head_text, head_leaves = self.chunks[first][0][:left], self.chunks[first][1][:left_leaf]
        region = "".join(c[0] for c in self.chunks[first:last + 1])
        region = region[left:len(region) - len(tail_text)]
        region = region[:start - at - left] + replacement + region[stop - at - left:]
        fresh = self.pretokens.leaves(region).tolist()
        self.encoded += len(fresh)
        for chunk in range(first + 1, last + 1):
            self._set(chunk, "", [])
        self._set(first, head_text + region + tail_text, head_leaves + fresh + tail_leaves)

    @property
    def text(self) -> str:
        return "".join(c[0] for c in self.chunks)


_PRETOKENS: dict[str, Pretokens] = {}


def _pretokens(path: str) -> Pretokens:
    if path not in _PRETOKENS:
        _PRETOKENS[path] = Pretokens(path)
    return _PRETOKENS[path]


def trees(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``text``, ``n_tokens`` and the compressed ``leaves``."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens, pack = _pretokens(vocabulary), zstandard.ZstdCompressor(3)
        for batch in batches:
            leaves = [pretokens.leaves(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([int(x[:, 1].sum()) for x in leaves], pa.int64()),
                 pa.array([pack.compress(np.ascontiguousarray(x.T).tobytes()) for x in leaves], pa.binary())],
                ["doc_id", "text", "n_tokens", "leaves"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, _TREES)


def recount(kept: DataFrame, edits: Column, vocabulary: str) -> DataFrame:
    """Counts of ``kept`` trees after ``edits``, an array of structs
    (``start``, ``stop``, ``replacement``) per row: ``doc_id``, ``n_tokens``,
    ``n_edits``, ``n_tokens_edited``, ``n_chars_edited`` and ``n_encoded``
    (pre-tokens encoded for the edits)."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens, unpack = _pretokens(vocabulary), zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, text, n, leaves, changes in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(unpack.decompress(leaves), "<u4").reshape(2, -1).T
                tree = TokenTree(pretokens, text or "", data)
                for e in changes or []:
                    tree.edit(e["start"], e["stop"], e["replacement"] or "")
                out.append((doc, n, len(changes or []), tree.tokens, tree.chars, tree.encoded))
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "n_encoded"]
    return (kept.select("doc_id", "text", "n_tokens", "leaves", edits.alias("edits"))
            .mapInArrow(apply, ", ".join(f"{c} long" for c in names)))

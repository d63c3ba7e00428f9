"""Exact token ids of whole texts, as little-endian unsigned 32-bit bytes.

Texts are cut where the tokenizer's own pre-tokenization always starts a new
piece, so the library encodes every distinct segment once per Python worker
and a text is a join of cached byte strings.
"""

from __future__ import annotations

import functools
import os
import re
import struct

# Bound of each of the two generations of the per-worker cache (segments);
# when the younger is full the older is dropped.  An entry takes about 200 bytes.
CACHE_SEGMENTS = 600_000

_SPACED = re.compile("[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
# White space beyond ASCII, and separators that some engines count as such:
# texts that hold one are given to the library whole.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
_EXOTIC = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
# Runs of white space that a cut at every single space would divide.
_RUNS = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ")
# A word of Latin-1 letters and a run of ASCII punctuation without apostrophes:
# two pre-tokens.
_PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@[-`{-~]*)")


def has_exotic_space(text: str) -> bool:
    return any(c in text for c in _SEPARATORS) or not text.isascii() and bool(_EXOTIC.search(text))


def has_space_runs(text: str) -> bool:
    return any(r in text for r in _RUNS)


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow 255."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in kept else next(rest)) for b in range(256)]


class SegmentEncoder:
    """``ids(texts)``: for each text the ids' bytes, equal to the tokenizers
    library's ``encode(text, add_special_tokens=False)``.

    ``spaces`` True (byte-level vocabularies that keep white space): a cut is
    made before a single space; a pre-token never holds a word character
    followed by white space, so every cut is one of the tokenizer's own.
    False (vocabularies that drop white space and case): segments are the
    words.  Plain words go to the vocabulary's merge model alone, all other
    segments through the library's whole chain."""

    def __init__(self, path: str, spaces: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaces = spaces
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[ord(" ")]
        # by segment: after a space, and at the start of a text or a run
        self.after = _Segments(self, " " if spaces else "", {})
        self.bare = _Segments(self, "", {})
        self.mark = functools.lru_cache(100_000)(lambda m: self._library([m])[0])

    def _library(self, parts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids)
                for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def word(self, lead: str, word: str) -> bytes:
        """Ids of a plain word, by the merge model alone."""
        if not self.spaces:
            word = word.lower()
        if word.isascii():
            # letters of ASCII stand for themselves
            piece = self.space + word if lead else word
        else:
            piece = "".join(map(self.alphabet.__getitem__, (lead + word).encode()))
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        return [self._text(t) if t else b"" for t in texts]

    def _text(self, text: str) -> bytes:
        if has_exotic_space(text):
            return self._library([text])[0]
        self.after, self.bare = self.after.bounded(), self.bare.bounded()
        if not self.spaces:
            return b"".join(map(self.after.__getitem__, text.split()))
        if has_space_runs(text):
            return b"".join([self.after[p[1:]] if p[0] == " " and p[1:].strip() == p[1:] != ""
                             else self.bare[p] for p in _SPACED.findall(text)])
        first, *parts = text.split(" ")
        return (self.bare[first] if first else b"") + b"".join(map(self.after.__getitem__, parts))


class _Segments(dict):
    """Ids' bytes by segment; a segment not met before is encoded."""

    def __init__(self, encoder: SegmentEncoder, lead: str, older: dict[str, bytes]):
        self.encoder, self.lead, self.older = encoder, lead, older

    def bounded(self) -> _Segments:
        if len(self) < CACHE_SEGMENTS:
            return self
        self.older = {}
        return _Segments(self.encoder, self.lead, self)

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            plain = _PLAIN.fullmatch(part)
            if not plain:
                lines = part.split("\n")
                if len(lines) > 1 and all(map(_PLAIN.fullmatch, lines)):
                    # a line end between two words is a pre-token of its own
                    ids = self.encoder.mark("\n").join(
                        [self[lines[0]], *map(self.encoder.bare.__getitem__, lines[1:])])
                else:
                    ids = self.encoder._library([self.lead + part])[0]
            elif plain[2]:
                ids = self[plain[1]] + self.encoder.mark(plain[2])
            else:
                ids = self.encoder.word(self.lead, part)
        self[part] = ids
        return ids


_ENCODERS: dict[tuple[str, bool], SegmentEncoder] = {}


def encoder(path: str, spaces: bool) -> SegmentEncoder:
    """The worker's encoder of a vocabulary file, kept between tasks."""
    key = (path, spaces)
    if key not in _ENCODERS:
        _ENCODERS[key] = SegmentEncoder(path, spaces)
    return _ENCODERS[key]

"""Packing, wavelet files, pieces and edit counts against the libraries."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridelake.llm import editcount, packing, piece, queries, wavelet
from ridelake.llm.tokens import SegmentEncoder

from .conftest import SF, edge_rows

ALPHABET = [" ", "  ", "\n", "\t", "a", "Bc", "9", "\x1c", "\xa0", "　", "é", "é", "Σ", "▁", "İ", "'s", "'",
            "<|endoftext|>", "<s>", "%", "漢", "\r\n", "\x85", "👩‍👩", "\x00", "the", " of", "   ", ".", ","]


def odd_texts(n, most=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(n)]


def library_ids(name, texts, end=1):
    out = Tokenizer.from_file(P.path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids + [end] for e in out]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_segments_equal_the_library(small):
    texts = odd_texts(4000) + small[1].text.tolist()
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        mine = SegmentEncoder(P.path(name), spaces).ids(texts)
        assert [np.frombuffer(m, "<u4").tolist() + [1] for m in mine] == library_ids(name, texts)


def check_pieces(rows, docs, length):
    ids = library_ids("byte_bpe_50k.json", [d[1] for d in docs])
    # every id lies in one piece: per id of a document, as often as it occurs
    want = Counter((d[0], tuple(i)) for d, i in zip(docs, ids))
    at, sequences = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        at.setdefault((r.doc_id, r.sequence_id * length + r.offset - r.start), []).append(r)
    got = Counter()
    for (doc, _), pieces in at.items():
        pieces.sort(key=lambda r: r.start)
        whole = b"".join(bytes(r.ids) for r in pieces)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
        assert all(r.doc_tokens * 4 == len(whole) for r in pieces)
        got[doc, tuple(np.frombuffer(whole, "<u4").tolist())] += 1
    assert got == want
    for k, runs in sequences.items():
        runs.sort()
        assert [o for o, _ in runs] == list(np.cumsum([0] + [n for _, n in runs])[:-1])
        if k != max(sequences):
            assert sum(n for _, n in runs) == length


def test_packing_edges_and_empty(edges, empty):
    rows = packing.pack(edges.repartition(3), P.path("byte_bpe_50k.json"), length=64).collect()
    check_pieces(rows, edge_rows(), 64)
    assert packing.pack(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_packing_query(workers, small):
    out = queries.op3_pack_sequences(workers, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = dict(zip(small[1].doc_id, library_ids("byte_bpe_50k.json", small[1].text)))
    rows = out.collect()
    assert all(r.ids_crc32 == crc(ids[r.doc_id][r.start:r.start + r.length]) for r in rows)
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))


def test_wavelet_access_rank_select():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 511, 512, 513, 5000):
        ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
        m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids, 16).to_bytes())
        assert m.decode().tolist() == ids.tolist()
        for i in rng.integers(0, n, 20) if n else []:
            assert m.access(int(i)) == ids[i]
            v = int(ids[i])
            where = np.flatnonzero(ids == v)
            assert m.rank(v, int(i)) == int((where < i).sum())
            assert [m.select(v, k) for k in range(min(5, len(where)))] == where[:5].tolist()
        assert m.rank(70000, n) == 0 and m.rank(60000, n) == 0


def test_token_files(edges, empty, workers, small):
    vocabulary = P.path("word_bpe_49k.json")
    files = wavelet.write_token_files(edges, vocabulary, block_tokens=1000)
    rows = wavelet.read_documents(files).collect()
    docs = edge_rows()
    ids = library_ids("word_bpe_49k.json", [d[1] for d in docs])
    got = Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in rows)
    assert got == Counter((d[0], tuple(i)) for d, i in zip(docs, ids))
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    order = [r.doc_id for r in rows]
    assert order == [None] * order.count(None) + sorted(x for x in order if x is not None)
    all_ids = [t for i in ids for t in i]
    counts = Counter(all_ids)
    wanted = [1, all_ids[0], 40000]
    assert {r.token_id: r.occurrences for r in wavelet.count_tokens(files, wanted).collect()} == {
        t: counts[t] for t in wanted}
    assert wavelet.find_token(files, 1).count() == counts[1]
    assert wavelet.read_documents(wavelet.write_token_files(empty, vocabulary)).count() == 0
    out = {r.doc_id: r for r in queries.op9_wavelet_token_files(workers, SF).collect()}
    at = 0
    for doc, ids in sorted(zip(small[1].doc_id, library_ids("word_bpe_49k.json", small[1].text))):
        assert (out[doc].start, out[doc].n_tokens, out[doc].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_pieces_of_long_unbroken_segments():
    """Segments that can be cut at every place, or nearly, and have no spaces."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(chars) for _ in range(5000)) for chars in (
        "0123456789", "漢字中文語日本國人大", "กขคงจฉชซ", "ABCDEFGHabcdefgh0123456789+/", "0123456789,")]
    texts += [texts[0] + " " + texts[0], "a" * 3000 + texts[1], "1" * 200_000]
    encoder = piece.PieceEncoder(P.path("piece_bpe_32k.model"))
    assert [encoder.ids(t) for t in texts] == encoder.library.encode(texts, add_eos=True)
    assert all(len(k) <= piece.CACHE_CHARS for k in encoder.cache)


def test_new_segments_are_merged_together(monkeypatch):
    """Words met for the first time are not merged one by one."""
    rng = random.Random(9)
    chars = "aaeeinorst" * 9 + "BZ9.,-'é\n漢👩ß\x00"
    words = list({"".join(rng.choice(chars) for _ in range(rng.randint(1, 14))) for _ in range(6000)})
    encoder, alone = piece.PieceEncoder(P.path("piece_bpe_32k.model")), []
    merged = piece.PieceEncoder.merged
    monkeypatch.setattr(piece.PieceEncoder, "merged", lambda self, s: alone.append(s) or merged(self, s))
    text = " ".join(words)
    assert encoder.ids(text) == encoder.library.encode(text, add_eos=True)
    assert len(alone) < len(words) / 20
    # met again, and after the younger generation was dropped to the older
    monkeypatch.setattr(piece, "CACHE_SEGMENTS", 10)
    again = [" ".join(words[k::7]) for k in range(7)]
    for _ in range(2):
        assert [encoder.ids(t) for t in again] == encoder.library.encode(again, add_eos=True)


def test_pieces_equal_the_library(edges, empty, small):
    model = P.path("piece_bpe_32k.model")
    encoder = piece.PieceEncoder(model)
    texts = odd_texts(4000) + small[1].text.tolist() + ["", "▁▁▁ a", "ﬁ ½", "a" * 3000, " " * 100]
    assert [encoder.ids(t) for t in texts] == encoder.library.encode(texts, add_eos=True)
    rows = piece.round_trip(edges, model).collect()
    assert len(rows) == len(edge_rows()) and all(r.agrees for r in rows)
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows)
    want = Counter()
    for d in edge_rows():
        ids = encoder.library.encode(d[1] or "", add_eos=True)
        want[d[0], tuple(ids), encoder.library.decode(ids)] += 1
    assert got == want
    assert piece.round_trip(empty, model).count() == 0


def test_edit_tree_equals_encoding_anew():
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    count = lambda s: len(tok.encode(s, add_special_tokens=False).ids)
    pretokens = editcount.Pretokens(P.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    for text in odd_texts(300, 300, seed=7) + ["word " * 2000]:
        tree = editcount.TokenTree(pretokens, text, pretokens.leaves(text))
        assert tree.tokens == count(text)
        for new in odd_texts(5, 6, seed=len(text)):
            a = rng.randint(-2, len(text) + 3)
            b = a + rng.choice([0, 0, 1, 3, 10, 500])
            lo = min(max(a, 0), len(text))
            text = text[:lo] + new + text[min(max(b, lo), len(text)):]
            tree.edit(a, b, new)
            assert (tree.text, tree.tokens, tree.chars) == (text, count(text), len(text))


def test_edits_touch_little(edges, empty):
    vocabulary = P.path("byte_bpe_50k.json")
    kept = editcount.trees(edges, vocabulary)
    change = F.array(F.struct(F.lit(70000).cast("long").alias("start"), F.lit(70001).cast("long").alias("stop"),
                              F.lit("zz").alias("replacement")),
                     F.struct(F.lit(3).cast("long").alias("start"), F.lit(1).cast("long").alias("stop"),
                              F.lit(None).cast("string").alias("replacement")))
    rows = editcount.recount(kept, change, vocabulary).collect()
    assert len(rows) == len(edge_rows())
    long = next(r for r in rows if r.doc_id == 6)
    assert long.n_tokens > 40000 and long.n_encoded < 100
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    text = next(d[1] for d in edge_rows() if d[0] == 6)
    assert long.n_tokens_edited == len(tok.encode(text[:70000] + "zz" + text[70001:]).ids)
    none = editcount.recount(kept, F.lit(None).cast("array<struct<start:long,stop:long,replacement:string>>"), vocabulary)
    assert all(r.n_tokens == r.n_tokens_edited and r.n_edits == 0 for r in none.collect())
    assert editcount.recount(editcount.trees(empty, vocabulary), change, vocabulary).count() == 0

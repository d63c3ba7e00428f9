"""Prefix trie, exact top-k search and phrase collocations against brute-force
versions, with the defined results of odd input."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelake.llm import collocations, kdtree, prefixtrie

CONV = "conv_id long, turn int, role string, text string, depth string, x1 int, k double"


def trie_rows(rows):
    """The trie's rows by plain prefixes; turns of one number must agree."""
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in kids[node])
    return Counter(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(n)).encode()).hexdigest())
        for n, m in members.items())


def test_trie_equals_plain_prefixes(workers, monkeypatch):
    """Shared heads, a hot conversation, a long one over many blocks and
    stretches, repeated rows, nulls and short bases."""
    monkeypatch.setattr(prefixtrie, "_STRETCH", 3)
    monkeypatch.setattr(prefixtrie, "_CHUNK_IDS", 7)
    monkeypatch.setattr(prefixtrie, "_MANY_CHILDREN", 5)
    monkeypatch.setattr(prefixtrie, "_HOT_PARENTS", 1000)
    rows = [(c, t, "user" if t % 2 else "bot", f"é{t}" * 3) for c in range(200, 260) for t in range(6)]
    rows += [(c, t, "user", f"own {c if t > 2 else 0} {t}") for c in range(100, 140) for t in range(c % 9 + 1)]
    rows += [(c, t, "a", f"x{t}") for c in (701, 702) for t in range(90)] + [(702, 90, "a", "more"), (705, 0, None, None)]
    rows += [(300, None, "u", "first"), (300, 0, "u", "second"), (300, 0, "u", "second"), (301, 3, None, "t"), (301, 5, "", None)]
    rows += [(None, 0, "u", "nobody"), (None, None, None, None), (2 ** 40, 1, "u", "😀" * 5), (2 ** 40 + 1, 1, "u", "")]
    df = workers.createDataFrame([r + ("d", 1, 0.5) for r in rows], CONV).repartition(5)
    got = prefixtrie.shared_prefixes(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    assert Counter(map(tuple, got.collect())) == trie_rows(rows)
    assert prefixtrie.shared_prefixes(df.limit(0)).collect() == []


VECS = "vec_id long, embedding array<float>, score string, cell int, v int"


def nearest(rows, k):
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
             if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(whole):
        if q is None or q % 100:
            continue
        found = sorted(((-sum(a * b for a, b in zip(v, w)), c is None, c or 0) for n, (c, w) in enumerate(whole)
                        if n != at and len(w) == len(v)))[:k]
        out += [(q, r, None if none else c, -s) for r, (s, none, c) in enumerate(found, 1)]
    return Counter(out)


def test_top_k_equals_all_pairs(workers, monkeypatch):
    """Many shards, a third of all rows one vector, ties, lengths, nulls and
    huge components."""
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 150)
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(0, 600)]
    rows += [(i, [0.5] * 6) for i in range(600, 900)] + [(600, [0.5] * 6), (None, [0.5] * 6), (None, [9.0] * 6)]
    rows += [(1000, None), (1100, [1.0, None]), (1200, [float("nan")] * 6), (1300, [float("inf")] * 6), (1400, [])]
    rows += [(1401, []), (1500, [2.0, -1.0]), (1501, [2.5, 1.0]), (1600, [3e12, 1.0, -3e12]), (1601, [-2e12, 7.0, 1.0])]
    df = workers.createDataFrame([r + ("s", 1, 2) for r in rows], VECS).repartition(4)
    got = kdtree.top_k(df, "vec_id", "embedding", F.col("vec_id") % 100 == 0)
    want = nearest(rows, 10)
    clipped = Counter({(q, r, c, min(max(s, -2 ** 63), 2 ** 63 - 1)): n for (q, r, c, s), n in want.items()})
    assert Counter(map(tuple, got.collect())) == clipped and len(clipped) > 90
    assert kdtree.top_k(df.limit(0), "vec_id", "embedding", F.col("vec_id") % 100 == 0).collect() == []


def test_kd_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8)) * 400
    v = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 8)) * 20)
    ids = rng.permutation(4000)
    order, nodes = kdtree.split_order(v, ids, 32)
    tree = kdtree.Tree(v[order], ids[order], nodes)
    seen = []
    real = tree.v

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    tree.v = real.view(Counting)
    (best,) = tree.search(real[:1], 10, [(-kdtree._LAST - 1, -kdtree._LAST - 1)], [0])
    scores = real @ real[0]
    want = sorted(((int(s), -int(i)) for n, (s, i) in enumerate(zip(scores, ids[order])) if n), reverse=True)[:10]
    assert [b[:2] for b in best] == want and sum(seen) < 2000


def phrases_of(rows, least, top):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                f.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, w), a in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                longer[lang, w[i:i + size]] = max(longer[lang, w[i:i + size]], a)
    out = defaultdict(list)
    for (lang, w), a in cand.items():
        if 100 * longer[lang, w] < 80 * a:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items()
            for r, (s, a, p, left, right) in enumerate(sorted(v)[:top], 1)}


def test_collocations_equal_counting_all(workers, monkeypatch):
    """Counts handed on often, odd text, one shard and three."""
    monkeypatch.setattr(collocations, "HELD_COUNTS", 500)
    rng = np.random.default_rng(2)
    vocabulary = ["the", "The", "of", "Ärger", "ärger", "a", "b", "漢字", "new", "york", "x\x1cy", "city"]
    rows = []
    for i in range(300):
        w = rng.choice(vocabulary, size=rng.integers(0, 40), p=np.arange(12, 0, -1) / 78)
        rows.append((["en", "de", None, "und"][i % 4], "".join(x + str(rng.choice([" ", " ", "  ", "\t", ". ", "\n"])) for x in w)))
    rows += [("en", "a a a a a a a"), ("en", None), (None, None), ("fr", ""), ("fr", " ,;. \n"), ("en", "word " * 9000)]
    df = workers.createDataFrame([(i, *r, "p", 3) for i, r in enumerate(rows)],
                                 "doc_id long, lang string, text string, phrase string, f int").repartition(3)
    want = phrases_of(rows, 5, 50)
    for shards in (1, 3):
        got = collocations.collocations(df, least=5, top=50, shards=shards).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want) > 100
        # the second time as for a table of phrases too large to broadcast
        monkeypatch.setattr(collocations, "broadcast_if_small", lambda df: df)
        monkeypatch.setattr(collocations, "_MANY_CUTS", 20)
    assert collocations.collocations(df.limit(0), least=5).collect() == []
    with pytest.raises(ValueError):
        collocations.frequent_phrases(df, longest=5)

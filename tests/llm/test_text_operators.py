"""Language ID, fingerprints, quality rules, licences, near-dedup, pages and
the pipeline: brute-force versions on small tables, and the defined results of
odd input."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ridelake.llm import htmltext, langid, licenses, minhash, quality, queries, simhash
from ridelake.llm.common import connected_components

from .conftest import DOCS, EXTRA, SF, WORDS, edge_rows

EDGE = edge_rows()


def by_id(rows, *cols):
    return Counter((r.doc_id, *(r[c] for c in cols)) for r in rows)


# --- language ID

def test_language_id_held_out(workers, small):
    out = queries.op1_language_id(workers, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in workers.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(out) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_id_edges(edges, empty):
    rows = langid.identify(edges).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        texts = [d[1] or "" for d in EDGE if d[0] == r.doc_id]
        if not any(c.isalpha() for t in texts for c in t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in rows} <= {"und", "en", "de", "fr", "es"}
    assert langid.identify(empty).count() == 0
    kept = langid.keep_identified(edges)
    assert kept.columns == edges.columns and None not in [r.text for r in kept.collect()]
    unlabelled = edges.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


# --- MinHash

def shingles(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in (text or "").encode().split()]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check_report(rows, docs):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] if d[0] is not None else 0), reverse=True)
    rows = {(r.doc_id, r.edited_sha256): r for r in rows}
    errors = []
    for i, (doc, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        r = rows[doc, hashlib.sha256(changed.encode()).hexdigest()]
        assert r.n_chars == len(text)
        errors += [r.near_edited - jaccard(text, changed), r.near_next - jaccard(text, after)]
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)
    assert np.abs(errors).max() < 0.25 and np.std(errors) < 0.06


def test_edit_report(workers, small, empty):
    check_report(queries.op2_minhash_fingerprints(workers, SF).collect(),
                 list(zip(small[1].doc_id, small[1].text)))
    assert minhash.edit_report(empty).count() == 0


def test_edit_report_edges(workers):
    docs = [(d[0], d[1]) for d in EDGE if d[0] not in (4, None)] + [(None, "last")]
    df = workers.createDataFrame([d + ("x",) for d in docs], "doc_id long, text string, part string")
    rows = minhash.edit_report(df.repartition(4)).collect()
    assert len(rows) == len(docs)
    check_report(rows, docs)
    one = minhash.edit_report(df.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    same = workers.createDataFrame([(1, "a b c"), (1, "a b c"), (2, None)], "doc_id long, text string")
    got = minhash.edit_report(same).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got if r.doc_id == 1}) == 1


def test_long_texts_estimate_jaccard(workers):
    """Likeness of long texts, and of their band keys, against brute force."""
    rng = random.Random(6)

    def text(n):
        return [f"{rng.choice(WORDS)}{rng.randrange(10 ** 6)}" for _ in range(n)]

    a, b = text(120_000), text(120_000)
    texts = [" ".join(x) for x in (a, b, a[:60_000] + b[60_000:], a[:108_000] + b[108_000:])]
    mine = [minhash.signature(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            want = jaccard(texts[i], texts[j])
            got = minhash.likeness(mine[i], mine[j])
            assert abs(got - want) < (0.02 if want < 0.01 else 0.15), (i, j, got, want)
    keys = [m.reshape(minhash.BANDS, -1) for m in mine]
    assert not (keys[0] == keys[1]).all(axis=1).any()
    df = workers.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_report(minhash.edit_report(df).collect(), list(enumerate(texts)))


def test_similar_finds_all(workers):
    rng = random.Random(4)
    texts = []
    for k in range(12):
        words = [rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(120)]
        for e in range(6):
            w = list(words)
            for _ in range(e // 2):
                w[rng.randrange(len(w))] = "edited" + str(rng.random())
            texts.append(" ".join(w))
    texts += [texts[0], "", None]
    df = workers.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.query_id, r.doc_id): r.jaccard for r in minhash.similar(df.where("doc_id % 5 = 0"), df).collect()}
    want = {(i, j): jaccard(texts[i], texts[j]) for i in range(0, len(texts), 5) for j in range(len(texts))
            if jaccard(texts[i], texts[j]) >= 0.8}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


# --- quality

def slow_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(repeated))


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_quality_statistics(edges, empty, workers, small):
    rows = quality.quality(edges).collect()
    assert by_id(rows, *COLS) == Counter((d[0], *slow_stats(d[1])) for d in EDGE)
    out = queries.op4_quality_outliers(workers, SF).collect()
    assert by_id(out, *COLS) == Counter((d, *slow_stats(t)) for d, t in zip(small[1].doc_id, small[1].text))
    for r in rows + out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.quality(empty).count() == 0 and quality.keep_clean(empty).columns == empty.columns


def test_quality_outliers(workers):
    rng = random.Random(9)
    rows, junk = [], set()
    for i in range(1200):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(60, 300))]
        if i % 7 == 0:
            junk.add(i)
            words = [w + "###" for w in words] if i % 2 else [x for w in words for x in (w, "|")]
        rows.append((i, " ".join(words), "en" if i % 2 else "de", "big" if i % 3 else "small", 0))
    df = workers.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in quality.quality(df).collect()}
    wrong = {i for i in out if out[i].kept == (i in junk)}
    assert not wrong
    kept = quality.keep_clean(df.withColumn("kept", F.lit("mine")))
    assert {r.doc_id for r in kept.collect()} == set(out) - junk and kept.columns[-1] == "kept"


def test_quality_moderate_repetition(workers):
    """Repetitive documents that pass the base rules, beside clean ones."""
    rng = random.Random(12)

    def words(n):
        return [rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed"]) + str(rng.randint(0, 99)) for _ in range(n)]

    rows, junk = [], {}
    for i in range(600):
        lines = [" ".join(words(12)) for _ in range(20)]
        if i % 30 == 0:      # 45 % of the words in repeated windows, all lines differ
            again = " ".join(words(10))
            lines = [" ".join(words(12)) for _ in range(11)] + [again + " " + w for w in words(10)]
            junk[i] = "words"
        elif i % 30 == 1:    # 35 % duplicate lines, of two words each
            lines = lines[:13] + [" ".join(words(2))] * 8
            junk[i] = "lines"
        elif i % 30 == 2:    # about a symbol per five words
            lines = [x + " | #" for x in lines]
            junk[i] = "symbols"
        rows.append((i, "\n".join(lines), "en", "a", 0))
    out = {r.doc_id: r for r in quality.quality(workers.createDataFrame(rows, DOCS)).collect()}
    assert not any(r.base_failed for r in out.values())
    assert {i for i in out if not out[i].kept} == set(junk)


def test_mcd_matches_numpy(workers):
    """The estimates' steps against the same steps in numpy."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 4)) * (1, 0.5, 0.2, 0.1) + (5, 1, 0.5, 0.2)
    x[:180] += 6
    df = workers.createDataFrame([("en", "a", *map(float, r)) for r in x],
                                 "lang string, source string, " + ", ".join(f"x{i} double" for i in range(4)))
    got = quality.estimates(df).where("level = 0").first()
    def inverse(cov):
        return np.linalg.inv(cov + np.diag(np.square(quality.SPREAD)))
    m = np.percentile(x, 50, axis=0, method="inverted_cdf")
    s = np.percentile(np.abs(x - m), 50, axis=0, method="inverted_cdf")
    q = inverse(np.diag((1.4826 * s) ** 2))
    share = quality._chi2_point(quality.SUPPORT, 4)
    for _ in range(quality.STEPS):
        d = np.einsum("ij,jk,ik->i", x - m, q, x - m)
        half = x[d <= np.percentile(d, 100 * quality.SUPPORT, method="inverted_cdf")]
        m = half.mean(axis=0)
        q = inverse(quality.SUPPORT / quality._chi2(share, 6) * np.cov(half.T, bias=True))
    assert np.allclose([got[f"m{i}"] for i in range(4)], m, rtol=0.02)
    assert np.allclose([got[f"q{i}{i}"] for i in range(4)], np.diag(q), rtol=0.1)


# --- licences

def test_licences(workers, small, empty):
    notices = [(f, t) for f in sorted(licenses.NOTICES) for t in licenses.NOTICES[f]]
    base = small[1].text.tolist()
    rows, want = [], {}
    for i, (family, notice) in enumerate(notices):
        rows.append((i, base[i] + "\n" + notice, "en", "a", 0))
        want[i] = family
    lines = ["license plates are issued by the county office", "the gnu is an animal of the plains",
             "a general public meeting will be held on monday", "permission to enter the building is granted free"]
    for k, line in enumerate(lines + base[100:]):
        rows.append((1000 + k, line, "en", "a", 0))
        want[1000 + k] = "none"
    rows += [(None, None, None, None, None), (5000, "", "en", "a", 0), (5001, "\n \n", "en", "a", 0),
             (5002, "MIT\nReleased under the MIT License.\nReleased under the MIT License.", "en", "a", 0),
             (5002, "Licensed under CC BY-NC 4.0.", "en", "a", 0)]
    df = workers.createDataFrame([r + ("k", "f", "p", "c", "i", "h", "x", 3) for r in rows], f"{DOCS}, {EXTRA}")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    wrong = [(want[i], got[i].license) for i in want if got[i].license != want[i]]
    assert len(wrong) <= 1, wrong
    assert (got[None].license, got[None].n_paragraphs) == ("none", 0)
    assert got[5000].n_paragraphs == got[5001].n_paragraphs == 0
    assert got[5002].families == ["cc-by-nc", "mit"] and got[5002].n_license_paragraphs == 3
    assert licenses.scan(empty).count() == 0


# --- SimHash

def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, ids):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1:]) <= 3):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, doc in enumerate(ids):
        r = find(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(doc, least[r])
    return [least[find(i)] for i in range(len(ids))]


def test_simhash_links_every_pair(workers):
    rng = random.Random(3)
    fps = set()
    for _ in range(40):
        base = current = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.randint(0, 8)):
            near = current
            for b in rng.sample(range(64), rng.randint(1, 5)):
                near ^= 1 << b
            fps.add(near)
            current = rng.choice([near, base])
        for _ in range(3):
            block, near = rng.randrange(4), base
            for b in rng.sample(range(16 * block, 16 * block + 16), 3):
                near ^= 1 << b
            fps.add(near)
    fps = sorted(fps)
    want = slow_components(fps, list(range(len(fps))))
    df = workers.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    got = {r.fp: r.component for r in simhash.components(df).collect()}
    groups = {}
    for x, c in zip(fps, want):
        groups.setdefault(c, set()).add(simhash._signed(x))
    found = {}
    for x in map(simhash._signed, fps):
        found.setdefault(got.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_components_of_long_paths(workers):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)]
    df = workers.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_near_duplicates(edges, empty, workers, small):
    rng = random.Random(8)
    texts = small[1].text.tolist()
    docs = list(zip(small[1].doc_id.tolist(), texts))
    for k in range(150):
        words = texts[k % 20].split(" ")
        words[rng.randrange(len(words))] = "x"
        docs.append((10_000 + k, " ".join(words)))
    df = workers.createDataFrame(docs, "doc_id long, text string")
    fps = [slow_fingerprint(t) for _, t in docs]
    want = slow_components(fps, [d for d, _ in docs])
    rows = simhash.near_duplicates(df).collect()
    assert by_id(rows, "fingerprint", "component_id") == Counter(
        (d, f"{f:016x}", c) for (d, _), f, c in zip(docs, fps, want))
    kept = simhash.keep_one(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want))
    # odd input
    rows = simhash.near_duplicates(edges).collect()
    fps = [slow_fingerprint(d[1]) for d in EDGE]
    want = slow_components(fps, [d[0] for d in EDGE])
    assert by_id(rows, "fingerprint", "component_id") == Counter(
        (d[0], f"{f:016x}", c) for d, f, c in zip(EDGE, fps, want))
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, _kept_ids(EDGE, fps)))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def _kept_ids(docs, fps):
    """Least id of each component, by position (rows of one id differ)."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    position = {i: p for p, i in enumerate(order)}
    comps = slow_components(fps, [position[i] for i in range(len(docs))])
    return [docs[order[p]][0] for p in sorted(set(comps))]


# --- pages

def test_pages_main_text(workers, empty):
    pages = workers.read.parquet(f"{SF}/pages.parquet").toPandas()
    got = {r.page_id: r for r in queries.op10_html_blocks(workers, SF).collect()}
    for page, source in zip(pages.page_id, pages.html):
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        want = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert got[page].text == want and got[page].n_chars == len(want)


def test_pages_odd(workers):
    tree = htmltext.grow(*htmltext.labelled())
    x, y = htmltext.labelled()
    assert (tree.predict(x) == y.astype(bool)).mean() > 0.95
    page = """<!DOCTYPE html><html><head><title>No</title><script>var a="<p>no</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="a>b">Home</a><li><a href=x>About us</a></ul></nav>
    <div class="cookie-notice">We use cookies &amp; a text that is long enough to be taken for an article by its words</div>
    <main><article><h1>The &lt;title&gt;</h1><p>One  <b>bo</b>ld&nbsp;word<!-- <p>no</p> -->.<p>Two
    <a href=y>linked</a><br>lines</p><aside>Side text</aside><form>Name <input><button>Send</button></form>
    <ul><li>Item</li></ul><div id="comments"><p>A long comment by a reader of this page, with many words.</p></div>
    </article></main><footer>&copy; someone</footer><div hidden>hidden words</div><script>unclosed"""
    want = "The <title>\nOne bold word.\nTwo linked lines\nItem"
    rows = [(1, "u", page), (2, None, None), (3, "", ""), (4, "u", "<p>"), (5, "u", "plain words without any tag at all, "
             "long enough to be the text"), (6, "u", "<!-- unclosed"), (None, "u", page), (1, "u", page),
            (7, "u", "<article>" + "<p>word</p>" * 20000 + "</article>")]
    df = workers.createDataFrame([r + ("x", "y") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = htmltext.extract(df).collect()
    assert len(got) == len(rows)
    assert [r.text for r in got if r.page_id == 1] == [want, want]
    texts = {r.page_id: r.text for r in got}
    assert texts[2] == texts[3] == texts[4] == texts[6] == "" and texts[5].startswith("plain words")
    assert texts[7].count("\n") == 19999
    assert htmltext.extract(df.limit(0)).count() == 0


def test_pages_flagged_wrappers_and_link_lists():
    tree = htmltext.grow(*htmltext.labelled())
    first, second = ("The council met on the first day of the week to settle the plans of the new bridge over the river.",
                     "Two of its members spoke against them and asked for more time to read the figures they were given.")
    text = f"<h1>A new bridge</h1><p>{first}</p><p>{second}</p>"
    want = f"A new bridge\n{first}\n{second}"
    side = "<div class=sidebar><p>About this site and those who write it.</p></div>"
    menu = "<ul>" + "".join(f"<li><a href=x>More news {k}</a></li>" for k in range(6)) + "</ul>"
    for page in (f"<html><body class='has-sidebar'><article>{text}</article>{side}</body></html>",
                 f"<html class='no-banner'><body id=share>{side}<main>{text}</main></body></html>",
                 f"<body><div class='main sidebar-right'>{text}</div>{side}</body>",
                 f"<body><div class='layout sidebar-right'><div class=content>{text}</div>{side}</div></body>",
                 f"<body><article>{text}{menu}</article></body>",
                 f"<body><article>{text}</article><div class='sidebar-content'><p>{first}</p></div></body>",
                 f"<body><aside class=related><article><p>{first}</p></article></aside><article>{text}</article></body>"):
        assert htmltext.main_text(page, tree)[0] == want, page
    # words decide inside a flagged container
    x = htmltext.feature_rows([htmltext.Block("", n, 0, False, True) for n in (3, 120, 110, 105, 3)])
    assert tree.predict(x)[[0, 1, 2, 4]].tolist() == [False, True, True, False]
    x = htmltext.feature_rows([htmltext.Block("", n, 0, False, True) for n in (6, 130, 5)])
    assert not tree.predict(x).any()


# --- pipeline

def test_pipeline(workers, small, edges, empty):
    docs, frame = small
    docs = docs.unionByName(edges.select(*docs.columns))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "simhash_near_dedup", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = Counter(map(tuple, docs.collect()))
        docs = workers.createDataFrame(stage(workers, docs, SF).collect(), docs.schema)
        after = Counter(map(tuple, docs.collect()))
        assert docs.columns == list(frame.columns) and after and not after - before
        kept[name] = after
    texts = [t[1] for t in kept["quality_rules"].elements()]
    assert all(slow_stats(t)[0] >= 50 for t in texts)
    ids = [t[0] for t in kept["quality_rules"].elements()]
    want = set(slow_components([slow_fingerprint(t) for t in texts], ids))
    assert sorted(t[0] for t in kept["simhash_near_dedup"].elements()) == sorted(want)
    pieces = corpus_pipeline.STAGES[-1][1](workers, docs, SF).collect()
    assert {r.doc_id for r in pieces} == want
    for name, stage in corpus_pipeline.STAGES:
        assert stage(workers, empty, SF).count() == 0
    assert corpus_pipeline.run(workers, SF).count() > 0

"""Ids beyond a wavelet matrix's bits, the language sample's plan, and packed phrases."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ridelake.llm import collocations, langid
from ridelake.llm.wavelet import WaveletMatrix


@pytest.mark.parametrize("bits,ids", [(16, [65535, 0, 5]), (17, [70000, 5, 65536]), (20, [1 << 19, 3])])
def test_wavelet_round_trip_at_the_edge_of_its_bits(bits, ids):
    back = WaveletMatrix.from_bytes(WaveletMatrix.build(np.array(ids, np.uint32), bits).to_bytes())
    assert back.decode().tolist() == ids
    assert [back.access(i) for i in range(len(ids))] == ids


def test_wavelet_refuses_ids_beyond_its_bits():
    with pytest.raises(ValueError, match="70000"):
        WaveletMatrix.build(np.array([70000, 5], np.uint32), 16)


def test_language_sample_is_not_dealt_by_language(workers, small, monkeypatch):
    """Rows meet the counts by broadcast; only deduplicated hashes are dealt by
    language."""
    plans = []
    real = langid.F.broadcast

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df)

    monkeypatch.setattr(langid.F, "broadcast", seen)
    workers.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert langid.train(small[0].select("text", "lang")) is not None
    finally:
        workers.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sample = next(p for p in plans if "row_number" in p)
    below = sample[sample.index("Window"):]
    assert below.index("Aggregate [lang") < below.index("Join") and "broadcast" in below


def test_too_many_labels_are_refused(workers, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 1)
    rows = workers.createDataFrame([("ein Text", "de"), ("a text", "en")], "text string, lang string")
    with pytest.raises(ValueError, match="labels"):
        langid.train(rows)


def test_packed_phrases_come_back_with_their_counts():
    langs = ["en", "a\tb\n", ""]
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 4)), int(rng.integers(0, 3)), f"w{rng.integers(0, 20)} é漢{rng.integers(0, 3)}", 1 + i % 3)
            for i in range(3000)] + [(1, 2, "", 7), (1, 2, "", 5)]
    held = [collocations._held(np.array([b << 32 | c for b, c, _, _ in part]), pa.array([p for _, _, p, _ in part]),
                               np.array([f for *_, f in part])) for part in (rows[:1000], rows[1000:])]
    want = Counter()
    for bucket, code, phrase, f in rows:
        want[bucket, langs[code], phrase] += f
    got = {(sent["bucket"], r["lang"], r["phrase"]): r["f"]
           for sent in collocations._sent(held, langs).to_pylist() for r in collocations._read(sent).to_pylist()}
    assert got == dict(want)

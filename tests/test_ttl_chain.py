"""TTL chain (T01/T02/T06) against a sequential pure-Python replay."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ridelake.operators.ttl import ttl_chain

T0 = dt.datetime(2024, 1, 1)


def replay(rows, ttl, ends=None):
    """Test-only model: rows (key, ts, seq, eligible, force) in order; ``ends``
    optionally maps seq -> the instant that row's TTL ends if it anchors."""
    out, last = {}, {}
    for key, ts, seq, el, force in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        a = last.get(key)
        covered_before = a is not None and ts < a[1]
        anchor = force or (el and not covered_before)
        if anchor:
            full = ts + dt.timedelta(seconds=ttl)
            end = min(max((ends or {}).get(seq, full), ts), full)
            last[key] = (ts, end)
        a = last.get(key)
        out[(key, seq)] = (anchor, a[0] if a else None, a is not None and ts < a[1])
    return out


def _run(spark, rows, ttl, bucket, ends=None):
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq long, el boolean, fo boolean")
    end = None
    if ends is not None:
        e = spark.createDataFrame(list(ends.items()), "seq long, e timestamp_ntz")
        df = df.join(e, "seq", "left")
        end = F.col("e")
    res = ttl_chain(df, ["k"], "ts", ["seq"], ttl, eligible=F.col("el"), force=F.col("fo"),
                    bucket_seconds=bucket, end=end)
    return {(r.k, r.seq): (r.is_anchor, r.anchor_ts, r.covered) for r in res.collect()}


def _random_rows(rng, n, keys, span_s, p_el=0.8, p_force=0.05):
    rows = []
    for i in range(n):
        ts = T0 + dt.timedelta(seconds=rng.randint(0, span_s))
        rows.append((rng.choice(keys), ts, i, rng.random() < p_el, rng.random() < p_force))
    return rows


def test_chain_matches_sequential_replay(spark):
    rng = random.Random(7)
    rows = _random_rows(rng, 600, ["a", "b", "c"], 6 * 3600)
    assert _run(spark, rows, 300, 600) == replay(rows, 300)


def test_dense_hot_key_spread_over_buckets(spark):
    # one key, requests every ~20 s for hours: one long dense segment that
    # spans many buckets, solved by pointer doubling
    rng = random.Random(11)
    rows, t = [], T0
    for i in range(700):
        t = t + dt.timedelta(seconds=rng.randint(1, 40))
        rows.append(("hot", t, i, True, False))
    assert _run(spark, rows, 300, 120) == replay(rows, 300)


def test_exact_boundary_starts_new_anchor(spark):
    rows = [("k", T0, 1, True, False),
            ("k", T0 + dt.timedelta(seconds=299, microseconds=999999), 2, True, False),
            ("k", T0 + dt.timedelta(seconds=300), 3, True, False),
            ("k", T0 + dt.timedelta(seconds=300), 4, True, False)]
    got = _run(spark, rows, 300, 3600)
    assert [got[("k", i)][0] for i in (1, 2, 3, 4)] == [True, False, True, False]


def test_observers_never_anchor(spark):
    rows = [("k", T0, 1, False, False), ("k", T0 + dt.timedelta(seconds=10), 2, True, False),
            ("k", T0 + dt.timedelta(seconds=20), 3, False, False),
            ("k", T0 + dt.timedelta(seconds=400), 4, False, False)]
    got = _run(spark, rows, 300, 3600)
    assert got[("k", 1)] == (False, None, False)
    assert got[("k", 3)][2] is True and got[("k", 4)][2] is False


def test_pointer_doubling_path(spark, monkeypatch):
    # force long dense segments through pointer doubling instead of the fold
    import ridelake.operators.ttl as ttl_mod
    monkeypatch.setattr(ttl_mod, "FOLD_MAX_ROWS", 16)
    rng = random.Random(3)
    rows, t = [], T0
    for i in range(300):
        t = t + dt.timedelta(seconds=rng.randint(1, 90))
        rows.append((rng.choice(["x", "y"]), t, i, rng.random() < 0.9, rng.random() < 0.02))
    assert _run(spark, rows, 300, 900) == replay(rows, 300)


def test_per_row_end(spark, monkeypatch):
    # anchors whose TTL ends early (e.g. a claimed offer), both solvers
    import ridelake.operators.ttl as ttl_mod
    rng = random.Random(9)
    rows, ends, t = [], {}, T0
    for i in range(250):
        t = t + dt.timedelta(seconds=rng.randint(0, 60))
        rows.append((rng.choice(["x", "y"]), t, i, rng.random() < 0.9, False))
        if rng.random() < 0.4:
            ends[i] = t + dt.timedelta(seconds=rng.randint(0, 200))
    want = replay(rows, 300, ends)
    assert _run(spark, rows, 300, 600, ends) == want
    monkeypatch.setattr(ttl_mod, "FOLD_MAX_ROWS", 8)
    assert _run(spark, rows, 300, 600, ends) == want

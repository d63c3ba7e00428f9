"""Claims and closed rides in one pass: the same rows as admission and finish
give over all requests, without the work for the others."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_shuffle_once import KEYS, T0, _plan, _shuffles, _tables, _written

from ridelake import registry
from ridelake.operators import admission, archive, finish
from ridelake.sources import standins as si

REQUEST = ("order_id string, offer_id string, user_id string, requested_at timestamp_ntz, hold_success boolean, seq long")
OFFER = ("id string, user_id string, scooter_id string, expires_at timestamp_ntz, price_per_minute int, "
         "price_unlock int, deposit int")
COLUMNS = ["order_id", "offer_id", "user_id", "requested_at", "seq", "outcome", "offer_scooter_id", "offer_deposit"]


def _requests(shared: bool, ties: bool):
    r = random.Random(7)
    rows = []
    for i in range(400):
        offer = r.choice([None, "", *[f"f{k}" for k in range(60)]])
        order = r.choice([None, "", f"o{r.randrange(40) if shared else offer}-{r.randrange(2)}"])
        at = r.choice([None, *[T0 + dt.timedelta(seconds=s) for s in range(0, 400, 40)]])
        rows.append((order, offer, r.choice([None, "", "u1", "u1", "u1", "u2"]), at, r.choice([None, True, True, False]),
                     r.randrange(3) if ties else i))
    return rows


@pytest.mark.parametrize("shared,ties", [(False, False), (False, True), (True, False), (True, True)])
def test_claims_are_those_of_admission(spark, tmp_dir, shared, ties):
    req = _written(spark, tmp_dir, "req", _requests(shared, ties), REQUEST)
    late = T0 + dt.timedelta(seconds=200)
    rows = [(f"f{k}", None if k % 9 == 0 else "u1", f"s{k}", None if k % 7 == 0 else late, 1, 2, k) for k in range(50)]
    offers = _written(spark, tmp_dir, "offers", rows + ([("f3", "u2", "s3", late, 1, 2, 3)] if ties else []), OFFER)
    want = admission.admit_orders(req, offers, ["seq"]).where(F.col("outcome").isin(*admission.CLAIMED)).select(*COLUMNS)
    got = admission.offer_claims(req, offers, ["seq"], COLUMNS)
    assert got.count() > 10
    if not (shared and ties):
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    else:                                    # which of equal requests claims is open
        keys = [c for c in COLUMNS if c not in ("order_id", "user_id")]
        assert got.columns == want.columns and got.select(*keys).count() == want.select(*keys).count()


def test_shared_order_id_is_decided_in_order(spark, tmp_dir):
    at = [T0 + dt.timedelta(seconds=s) for s in range(4)]
    req = _written(spark, tmp_dir, "req", [("o", "a", "u", at[0], True, 1), ("o", "b", "u", at[1], True, 2),
                                           ("p", "b", "u", at[2], False, 3)], REQUEST)
    offers = _written(spark, tmp_dir, "offers", [(k, "u", "s", at[3], 1, 2, 3) for k in "ab"], OFFER)
    got = admission.offer_claims(req, offers, ["seq"], COLUMNS)
    assert {(r.seq, r.outcome) for r in got.collect()} == {(1, "CREATED"), (3, "PAYMENT_HOLD_FAILED")}


def test_closed_rides_are_those_of_finish(spark, tmp_dir):
    r = random.Random(3)
    orders = [(f"o{k}", "u", r.choice([None, "ACTIVE", "ACTIVE", "ACTIVE", "FINISHED"]), T0,
               r.choice([None, T0 + dt.timedelta(seconds=40)]), 10, 20, k) for k in range(30)]
    orders = _written(spark, tmp_dir, "orders", orders + [orders[1], orders[2]],
                      "id string, user_id string, status string, start_time timestamp_ntz, created_at timestamp_ntz, "
                      "price_per_minute int, price_unlock int, deposit int")
    req = _written(spark, tmp_dir, "req", [
        (r.choice([None, "", *[f"o{k}" for k in range(35)]]), r.choice([None, *[T0 + dt.timedelta(seconds=s) for s in (0, 20, 90, 200)]]),
         r.randrange(2)) for _ in range(300)], KEYS)
    pays = _written(spark, tmp_dir, "pays", [(f"o{k}", op, (k + i) % 3 > 0) for k in range(20) for i, op in enumerate(("charge", "unhold"))],
                    "order_id string, op string, success boolean")
    want = finish.finish_rides(orders, req, pays, ["seq"]).where(F.col("outcome").isin("FINISHED", "PAYMENT_FAILED"))
    got = finish.close_rides(orders, req, pays, ["seq"])
    plan = _plan(got)
    assert got.columns == want.columns and got.count() > 10
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert _shuffles(plan, "order_id") == 2 and _shuffles(plan, "_o_id") == 1    # requests, payments; orders


def test_order_world_looks_for_shared_ids_among_claims_only(spark, tmp_dir, monkeypatch):
    def read_again(_):
        raise AssertionError("requests read again")

    monkeypatch.setattr(admission, "_linked_offers", read_again)
    day = T0 + dt.timedelta(days=1)
    _tables(spark, tmp_dir, [(1, 1, 5, 3, 1.0, "N", "F", day), (1, 2, 5, 3, 1.0, "N", "F", day), (2, 1, 5, 3, 1.0, "R", "F", day)])
    assert [r.outcome for r in registry._world(spark, tmp_dir)[0].collect()] == ["CREATED"]
    claims = registry._world(spark, tmp_dir, claims=True)
    assert sorted(r.outcome for r in claims[0].collect()) == ["CREATED", "PAYMENT_HOLD_FAILED"]
    assert claims[1].count() == 1


def test_payment_feed_is_read_once(spark, tmp_dir):
    _tables(spark, tmp_dir, [])
    pays = si.payment_outcomes(spark, tmp_dir)
    assert _plan(pays).count("FileScan") == 1
    assert sorted(map(tuple, pays.collect())) == sorted(
        (f"order-{k}-{b}", op, op == "charge") for k in (1, 2) for b in (0, 1) for op in ("charge", "unhold"))


def test_second_day_reads_written_requests(spark, tmp_dir, monkeypatch):
    plans, write = {}, registry.materialize

    def spy(df, name):
        plans[name] = _plan(df)
        return write(df, name)

    monkeypatch.setattr(registry, "materialize", spy)
    _tables(spark, tmp_dir, [(1, 1, 5, 3, 1.0, "N", "F", T0), (2, 5, 5, 3, 1.0, "N", "F", T0)])
    out = registry.admission_two_days(spark, tmp_dir)
    assert "l_returnflag" in plans["requests"] and "l_returnflag" not in plans["day-one"] + _plan(out)
    assert sorted(r.outcome for r in out.collect()) == ["CREATED", "OFFER_EXPIRED"]


def test_hour_folders_are_padded_as_before(spark):
    times = [None, T0, dt.datetime(1, 2, 3, 4), dt.datetime(9999, 12, 31, 23)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    parts = {"yyyy": ("%04d", F.year), "mm": ("%02d", F.month), "dd": ("%02d", F.dayofmonth), "hh": ("%02d", F.hour)}
    want = df.select(*[F.format_string(f, of("t")).alias(n) for n, (f, of) in parts.items()])
    got = df.select(*archive._hour_parts(F.col("t")))
    assert got.collect() == want.collect()

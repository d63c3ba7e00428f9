"""What the order world shuffles: requests cut to a user's first per offer before
they are shuffled, finish calls without tie-break columns, one shuffle per pivot."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_claims import COLUMNS, OFFER, REQUEST
from test_shuffle_once import KEYS, T0, _plan, _shuffles, _tables, _written

from ridelake import registry
from ridelake.operators import admission, finish


def _spied(monkeypatch, module):
    plans, write = {}, module.materialize

    def spy(df, name):
        plans.setdefault(name, _plan(df))
        return write(df, name)

    monkeypatch.setattr(module, "materialize", spy)
    return plans


def _rows(found):
    return sorted(map(str, found.collect()))


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("also", [[], [("f3", "u2", "s3", None, 1, 2, 3), ("f5", "u1", "s9", T0, 5, 6, 7)], [("f4", None, "s4", None, 1, 2, 3)]])
def test_first_request_of_a_user_claims(spark, tmp_dir, monkeypatch, ties, also):
    r = random.Random(11)
    requests = []
    for i in range(500):
        offer = r.choice([None, "", *[f"f{k}" for k in range(50)]])
        at = r.choice([None, *[T0 + dt.timedelta(seconds=s) for s in range(0, 400, 40)]])
        requests.append((r.choice([None, f"o{offer}-{r.randrange(2)}"]), offer, r.choice([None, "", "u1", "u1", "u2"]), at,
                         r.choice([None, True, True, False]), 0 if ties else i))
    req = _written(spark, tmp_dir, "req", requests, REQUEST)
    late = T0 + dt.timedelta(seconds=200)
    offers = _written(spark, tmp_dir, "offers", [(f"f{k}", "u1", f"s{k}", None if k % 7 == 0 else late, 1, 2, k)
                                                 for k in range(45)] + also, OFFER)
    want = admission.admit_orders(req, offers, ["seq"]).where(F.col("outcome").isin(*admission.CLAIMED)).select(*COLUMNS)
    plans = _spied(monkeypatch, admission)
    got = admission.offer_claims(req, offers, ["seq"], COLUMNS)
    assert got.columns == want.columns and got.count() > 10 and _rows(got) == _rows(want)
    owned = all(o[1] for o in also)
    assert _shuffles(plans["claims"], "offer_id#") == 1
    if owned:
        (line,) = [n for n, x in enumerate(plans["claims"].splitlines()) if "Exchange hashpartitioning(offer_id#" in x]
        assert "user_id#" in plans["claims"].splitlines()[line] and "Partial" in plans["claims"].splitlines()[line + 1]


def test_closed_rides_are_those_of_the_tie_break(spark, tmp_dir, monkeypatch):
    r = random.Random(5)
    orders = [(f"o{k}", "u", r.choice([None, "ACTIVE", "ACTIVE", "FINISHED"]), T0,
               r.choice([None, T0 + dt.timedelta(seconds=40)]), 10, 20, k) for k in range(40)]
    orders = _written(spark, tmp_dir, "orders", orders + orders[1:4],
                      "id string, user_id string, status string, start_time timestamp_ntz, created_at timestamp_ntz, "
                      "price_per_minute int, price_unlock int, deposit int")
    times = [None, *[T0 + dt.timedelta(seconds=s) for s in (0, 20, 90, 200)]]
    # equal times with other keys, and equal keys
    req = _written(spark, tmp_dir, "req", [(r.choice([None, "", *[f"o{k}" for k in range(45)]]), r.choice(times), r.randrange(3))
                                           for _ in range(400)], KEYS)
    pays = _written(spark, tmp_dir, "pays", [(f"o{k}", op, (k + i) % 3 > 0) for k in range(30) for i, op in enumerate(("charge", "unhold"))],
                    "order_id string, op string, success boolean")
    columns = registry._FINISHED_COLUMNS
    want = finish.close_rides(orders, req, pays, ["seq"]).select(*columns)
    plans = _spied(monkeypatch, finish)
    got = finish.closed_rides(orders, req, pays, ["seq"], columns)
    assert got.columns == want.columns and want.count() > want.select("order_id").distinct().count() and _rows(got) == _rows(want)
    assert "seq" not in plans["finished"] and "seq" in plans["finished-tied"]


def test_order_world_shuffles_finish_calls_without_tie_break(spark, tmp_dir, monkeypatch):
    _tables(spark, tmp_dir, [(1, 1, 5, 3, 1.0, "N", "F", T0 + dt.timedelta(days=1))])
    plans = _spied(monkeypatch, finish)
    assert registry._world(spark, tmp_dir)[2].count() == 1
    assert "l_suppkey" not in plans["finished"]


def test_ledger_rollup_shuffles_once(spark, tmp_dir):
    ledger = _written(spark, tmp_dir, "ledger", [
        ("a", "HOLD", 5, "SUCCESS"), ("a", "CLEAR", 7, "FAILED"), ("a", "CLEAR", 1, "SUCCESS"), ("b", "REFUND", None, None),
        ("c", "OTHER", 3, "SUCCESS"), ("d", None, 3, "SUCCESS"), (None, "HOLD", 2, "PENDING")],
        "order_id string, transaction_type string, amount int, status string")
    out = finish.ledger_rollup(ledger)
    assert out.columns == ["order_id", "hold_amount", "hold_status", "clear_amount", "clear_status", "refund_amount", "refund_status"]
    assert _plan(out).count("Exchange hashpartitioning") == 1
    none = (None, None)
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {
        "a": (5, "SUCCESS", 8, "SUCCESS", *none), "b": none * 3, "c": none * 3, "d": none * 3, None: (2, "PENDING", *none, *none)}


def test_buckets_grow_with_the_orders(spark, tmp_dir, monkeypatch):
    _tables(spark, tmp_dir, [(1, 1, 5, 3, 1.0, "N", "F", T0), (2, 1, 5, 3, 1.0, "N", "F", T0)])
    seen, made = [], registry.layout.bucketed
    monkeypatch.setattr(registry, "_BUCKET_ORDERS", 0.1)
    monkeypatch.setattr(registry.layout, "bucketed", lambda df, key, n: seen.append(n) or made(df, key, int(n)))
    rows = registry.orders_with_ledger_bucketed(spark, tmp_dir).count()
    assert rows == 2 and seen == [20, 20]

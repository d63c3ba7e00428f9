"""Order admission (T03) and ride finish (T05) on small fixtures."""

import datetime as dt
import random

import pytest

from ridelake.operators import admission, finish

T0 = dt.datetime(2024, 1, 1)
OFFERS = "id string, user_id string, scooter_id string, expires_at timestamp_ntz, " \
         "price_per_minute int, price_unlock int, deposit int"
REQ = "order_id string, offer_id string, user_id string, requested_at timestamp_ntz, " \
      "hold_success boolean, seq long"


def _offers(spark, rows):
    return spark.createDataFrame(rows, OFFERS)


def _admit(spark, reqs, offers):
    df = spark.createDataFrame(reqs, REQ)
    out = admission.admit_orders(df, offers, ["seq"])
    return {r.seq: r.outcome for r in out.collect()}


def model(reqs, offers):
    """Sequential replay of the order endpoint (test-only)."""
    by_id = {o[0]: o for o in offers}
    created, used, res = set(), set(), {}
    for order_id, offer_id, user, ts, hold, seq in sorted(reqs, key=lambda r: (r[3], r[5])):
        if not order_id:
            o = "ORDER_ID_REQUIRED"
        elif not offer_id:
            o = "OFFER_ID_REQUIRED"
        elif not user:
            o = "USER_ID_REQUIRED"
        elif order_id in created:
            o = "DUPLICATE"
        elif offer_id not in by_id:
            o = "OFFER_NOT_FOUND"
        elif ts > by_id[offer_id][3]:
            o = "OFFER_EXPIRED"
        elif user != by_id[offer_id][1]:
            o = "INVALID_USER"
        elif offer_id in used:
            o = "OFFER_ALREADY_USED"
        else:
            used.add(offer_id)
            if not hold:
                o = "PAYMENT_HOLD_FAILED"
            else:
                o = "CREATED"
                created.add(order_id)
        res[seq] = o
    return res


def test_five_concurrent_claims(spark):
    offers = [("of-1", "u1", "s1", T0 + dt.timedelta(minutes=5), 10, 20, 100)]
    reqs = [(f"o{i}", "of-1", "u1", T0 + dt.timedelta(seconds=1), True, i) for i in range(5)]
    got = _admit(spark, reqs, _offers(spark, offers))
    assert sorted(got.values()) == ["CREATED"] + ["OFFER_ALREADY_USED"] * 4
    assert got[0] == "CREATED"


def test_expiry_boundary_and_failed_hold_burns_offer(spark):
    exp = T0 + dt.timedelta(minutes=5)
    offers = [("of-1", "u1", "s1", exp, 10, 20, 100), ("of-2", "u1", "s1", exp, 10, 20, 100)]
    reqs = [("a", "of-1", "u1", exp, True, 1),                               # == expiry: valid
            ("b", "of-2", "u1", exp + dt.timedelta(microseconds=1), True, 2),  # expired
            ("c", "of-2", "u2", T0, True, 3),                                 # wrong user
            ("d", "of-2", "u1", T0, False, 4),                                # hold fails, burns
            ("e", "of-2", "u1", T0 + dt.timedelta(seconds=1), True, 5),
            ("a", "of-1", "u1", exp, True, 6)]                                # repeat -> duplicate
    got = _admit(spark, reqs, _offers(spark, offers))
    assert got == {1: "CREATED", 2: "OFFER_EXPIRED", 3: "INVALID_USER",
                   4: "PAYMENT_HOLD_FAILED", 5: "OFFER_ALREADY_USED", 6: "DUPLICATE"}


@pytest.mark.parametrize("seed", [5, 17, 29])
def test_order_id_reused_across_offers_matches_model(spark, seed):
    # conflicting components (one order id naming several offers) are replayed
    rng = random.Random(seed)
    offers = [(f"of-{i}", f"u{i % 3}", "s", T0 + dt.timedelta(minutes=rng.randint(1, 30)),
               5, 40, 100) for i in range(12)]
    reqs = []
    for i in range(150):
        reqs.append((rng.choice(["", f"o{rng.randint(0, 15)}"]) if rng.random() < 0.1
                     else f"o{rng.randint(0, 15)}",
                     f"of-{rng.randint(0, 13)}", f"u{rng.randint(0, 2)}",
                     T0 + dt.timedelta(minutes=rng.randint(0, 25)), rng.random() < 0.8, i))
    assert _admit(spark, reqs, _offers(spark, offers)) == model(reqs, offers)


def test_finish_flow(spark):
    orders = spark.createDataFrame(
        [("o1", "u1", "ACTIVE", T0, T0, 10, 20, 100),
         ("o2", "u1", "ACTIVE", T0, T0, 10, 20, 100),
         ("o3", "u2", "FINISHED", T0, T0, 10, 20, 100),
         ("o4", "u2", "ACTIVE", T0, T0, None, None, 100)],
        "id string, user_id string, status string, start_time timestamp_ntz, "
        "created_at timestamp_ntz, price_per_minute int, price_unlock int, deposit int")
    reqs = spark.createDataFrame(
        [("o1", T0 + dt.timedelta(seconds=120), 1), ("o1", T0 + dt.timedelta(seconds=200), 2),
         ("o2", T0 + dt.timedelta(seconds=3), 3), ("o3", T0 + dt.timedelta(seconds=9), 4),
         ("o9", T0, 5), ("", T0, 6), ("o4", T0 + dt.timedelta(seconds=500), 7),
         ("o1", T0 - dt.timedelta(seconds=1), 8)],
        "order_id string, requested_at timestamp_ntz, seq long")
    pays = spark.createDataFrame(
        [("o1", "charge", True), ("o1", "unhold", True), ("o2", "charge", False),
         ("o2", "unhold", True), ("o4", "charge", True), ("o4", "unhold", False)],
        "order_id string, op string, success boolean")
    done = finish.finish_rides(orders, reqs, pays, ["seq"])
    got = {r.seq: (r.outcome, r.http_status, r.total_amount, r.unhold_ok) for r in done.collect()}
    assert got[1] == ("FINISHED", 200, 40, True)
    assert got[2][0:2] == ("ORDER_NOT_ACTIVE", 409)
    assert got[3] == ("PAYMENT_FAILED", 200, 0, False)     # charge fails: unhold not attempted
    assert got[4][0:2] == ("ORDER_NOT_ACTIVE", 409)
    assert got[5][0] == "ORDER_NOT_FOUND" and got[6][0] == "ORDER_ID_REQUIRED"
    assert got[7] == ("FINISHED", 200, 0, False)            # null prices bill 0
    assert got[8][0] == "ORDER_NOT_FOUND"                   # before the order existed
    ledger = {(r.order_id, r.transaction_type): (r.amount, r.status)
              for r in finish.finish_ledger(done).collect()}
    assert ledger[("o1", "CLEAR")] == (40, "SUCCESS")
    assert ledger[("o2", "REFUND")] == (100, "FAILED")
    assert ledger[("o4", "REFUND")] == (100, "FAILED")


def test_persist_failure_emits_unhold(spark):
    offers = [("of-1", "u1", "s1", T0 + dt.timedelta(minutes=5), 10, 20, 100)]
    df = spark.createDataFrame([("o1", "of-1", "u1", T0, True, 1, False),
                                ("o2", "of-1", "u1", T0 + dt.timedelta(seconds=1), True, 2, True)],
                               REQ + ", persisted boolean")
    out = admission.admit_orders(df, _offers(spark, offers), ["seq"], persist_col="persisted")
    got = {r.seq: r.outcome for r in out.collect()}
    assert got == {1: "PERSIST_FAILED", 2: "OFFER_ALREADY_USED"}   # the offer stays burned
    comp = admission.hold_compensations(out).collect()
    assert [(r.order_id, r.op) for r in comp] == [("o1", "unhold")]


def test_finish_threshold_from_config(spark):
    orders = spark.createDataFrame(
        [("o1", "u1", "ACTIVE", T0, T0, 10, 20, 100)],
        "id string, user_id string, status string, start_time timestamp_ntz, "
        "created_at timestamp_ntz, price_per_minute int, price_unlock int, deposit int")
    reqs = spark.createDataFrame([("o1", T0 + dt.timedelta(seconds=10), 1)],
                                 "order_id string, requested_at timestamp_ntz, seq long")
    pays = spark.createDataFrame([("o1", "charge", True), ("o1", "unhold", True)],
                                 "order_id string, op string, success boolean")
    cfg = spark.createDataFrame([(None, None, None, 15)],
                                "surge double, low_charge_discount double, "
                                "low_charge_threshold_percent int, incomplete_ride_threshold_seconds int")
    default = finish.finish_rides(orders, reqs, pays, ["seq"]).first()
    configured = finish.finish_rides(orders, reqs, pays, ["seq"], configs=cfg).first()
    assert (default.duration_seconds, default.total_amount) == (10, 30)   # 20 + 1 min * 10
    assert (configured.outcome, configured.total_amount) == ("FINISHED", 0)  # below 15 s: free


def test_invalid_order_body_is_rejected_first(spark):
    from ridelake.sources import payloads
    offers = [("of-1", "u1", "s1", T0 + dt.timedelta(minutes=5), 10, 20, 100)]
    raw = spark.createDataFrame(
        [('{"order_id":"o1","offer_id":"of-1","user_id":"u1"}', T0, True, 1),
         ('["o1"]', T0, True, 2), ("", T0, True, 3)],
        "body string, requested_at timestamp_ntz, hold_success boolean, seq long")
    req = payloads.decode_order_requests(raw)
    out = {r.seq: (r.outcome, r.http_status) for r in
           admission.admit_orders(req, _offers(spark, offers), ["seq"]).collect()}
    assert out == {1: ("CREATED", 201), 2: ("INVALID_BODY", 400), 3: ("INVALID_BODY", 400)}

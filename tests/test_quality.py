"""Every quality rule counts a row that breaks it, and none counts a sound one."""

import datetime as dt

from pyspark.sql import functions as F

from ridelake.operators import quality
from ridelake.plans.asof import asof_join, validity_intervals

T0 = dt.datetime(2024, 1, 1, 10)
ORDER = dict(id="o1", user_id="u", scooter_id="s", offer_id="of1", price_per_minute=5, price_unlock=40, deposit=100,
             total_amount=50, status="FINISHED", start_time=T0, created_at=T0, updated_at=T0,
             finish_time=T0 + dt.timedelta(minutes=2), duration_seconds=120)
ORDER_SCHEMA = ("id string, user_id string, scooter_id string, offer_id string, price_per_minute int, price_unlock int, "
                "deposit int, total_amount int, status string, start_time timestamp_ntz, created_at timestamp_ntz, "
                "updated_at timestamp_ntz, finish_time timestamp_ntz, duration_seconds int")
TXN = dict(id="t1", order_id="o1", user_id="u", transaction_type="HOLD", amount=100, status="SUCCESS",
           external_transaction_id="x", error_message=None, created_at=T0)
TXN_SCHEMA = ("id string, order_id string, user_id string, transaction_type string, amount int, status string, "
              "external_transaction_id string, error_message string, created_at timestamp_ntz")
OFFER = dict(id="of1", user_id="u", scooter_id="s", zone_id="z", price_per_minute=5, price_unlock=40, deposit=100,
             created_at=T0, expires_at=T0 + dt.timedelta(seconds=300))
OFFER_SCHEMA = ("id string, user_id string, scooter_id string, zone_id string, price_per_minute int, price_unlock int, "
                "deposit int, created_at timestamp_ntz, expires_at timestamp_ntz")


def table(spark, base, schema, changes):
    """The sound row and one more per change, each with an id of its own
    unless the change sets one."""
    rows = [base] + [{**base, "id": f"{base['id']}-{i}", **c} for i, c in enumerate(changes)]
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def counts(df):
    return {r.rule: r.violations for r in df.collect()}


def test_order_and_ledger_constraints(spark):
    bad = [{c: None} for c in quality.ORDER_NOT_NULL] + [{c: "x" * (n + 1)} for c, n in quality.ORDER_LENGTHS.items()]
    bad += [{"status": "ODD"}, {"id": "o1"}]
    got = counts(quality.order_constraints(table(spark, ORDER, ORDER_SCHEMA, bad)))
    assert got and all(got.values()), got
    bad = [{c: None} for c in quality.TXN_NOT_NULL] + [{c: "x" * (n + 1)} for c, n in quality.TXN_LENGTHS.items()]
    bad += [{"transaction_type": "ODD"}, {"status": "ODD"}, {"id": "t1"}]
    got2 = counts(quality.ledger_constraints(table(spark, TXN, TXN_SCHEMA, bad)))
    assert got2 and all(got2.values()), got2
    for check, base, schema in ((quality.order_constraints, ORDER, ORDER_SCHEMA),
                                (quality.ledger_constraints, TXN, TXN_SCHEMA)):
        assert not any(counts(check(table(spark, base, schema, []))).values())


def test_contracts(spark):
    required = ["id", "user_id", "scooter_id", "zone_id", "price_per_minute", "price_unlock", "deposit", "expires_at"]
    bad = [{c: None} for c in required] + [{c: -1} for c in ("price_per_minute", "price_unlock", "deposit")]
    bad += [{"expires_at": T0 + dt.timedelta(seconds=s)} for s in (289, 311)] + [{"id": "of1"}]
    got = counts(quality.offer_contract(table(spark, OFFER, OFFER_SCHEMA, bad)))
    assert got and all(got.values()) and got["offer.ttl"] == 2, got
    sound = table(spark, OFFER, OFFER_SCHEMA, [])
    assert not any(counts(quality.offer_contract(sound)).values())
    bad = [{"status": "ODD", "offer_id": "a"}, {"finish_time": None, "offer_id": "b"}, {"duration_seconds": None, "offer_id": "c"},
           {"total_amount": 51, "offer_id": "d"}, {"price_unlock": 41, "total_amount": 51}]
    got = counts(quality.order_contract(table(spark, ORDER, ORDER_SCHEMA, bad), sound))
    assert got and all(got.values()), got
    assert not any(counts(quality.order_contract(table(spark, ORDER, ORDER_SCHEMA, []), sound)).values())


def test_ledger_invariants(spark):
    orders = table(spark, ORDER, ORDER_SCHEMA, [{"id": "o2"}])
    ledger = table(spark, TXN, TXN_SCHEMA, [
        {"transaction_type": "REFUND"}, {"transaction_type": "CLEAR"}, {"transaction_type": "CLEAR"},
        {"order_id": "gone"}, {"order_id": "gone", "status": "FAILED"}, {"order_id": "o2", "transaction_type": "CLEAR"}])
    assert counts(quality.ledger_invariants(orders, ledger)) == {
        "hold_without_order": 1, "charged_twice": 1, "finished_without_refund": 1}


def test_versions_tie_and_collapse(spark):
    at = [T0 + dt.timedelta(minutes=m) for m in (0, 0, 1, 2, 3, 24 * 60)]
    rows = list(zip(at, [1, 2, 2, 2, 3, 3]))
    df = spark.createDataFrame(rows, "valid_from timestamp_ntz, v int")
    got = validity_intervals(df, [], "valid_from", collapse=True)
    assert sorted((r.valid_from, r.valid_to, r.v) for r in got.collect()) == [(at[0], at[4], 2), (at[4], None, 3)]
    every = validity_intervals(df.repartition(3), [], "valid_from")
    assert [r.v for r in every.orderBy("valid_from").collect()] == [2, 2, 2, 3, 3]
    facts = spark.createDataFrame([(i, t + dt.timedelta(seconds=30)) for i, t in enumerate(at)], "i int, ts timestamp_ntz")
    joined = asof_join(facts, got, [], "ts", bucket_seconds=300)
    assert {r.i: r.v for r in joined.select("i", F.col("v")).collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3, 5: 3}

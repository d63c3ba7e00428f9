"""Work that is shared is done once: one shuffle of the requests for both uses
in admission and finish, narrow intermediates, no self-join of line items."""
import datetime as dt
import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from ridelake import registry
from ridelake.operators import admission, finish, ttl
from ridelake.sources import standins as si

T0 = dt.datetime(2024, 1, 1)
KEYS = "order_id string, requested_at timestamp_ntz, seq long"


def _plan(df):
    conf = df.sparkSession.conf
    old = {k: conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    conf.set("spark.sql.adaptive.enabled", "false")
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with redirect_stdout(out):
            df.explain()
        return out.getvalue()
    finally:
        for k, v in old.items():
            conf.set(k, v)


def _shuffles(plan, key):
    # (a reused one is printed with the exchange it stands for)
    return sum(f"Exchange hashpartitioning({key}" in line and "ReusedExchange" not in line
               for line in plan.splitlines())


def _written(spark, tmp_dir, name, rows, schema):
    path = f"{tmp_dir}/{name}"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_admission_shuffles_requests_once(spark, tmp_dir):
    req = _written(spark, tmp_dir, "req", [
        ("o1", "of-1", "u1", T0, True, 1), ("o1", "of-1", "u1", T0, True, 2), ("o2", None, "u1", T0, True, 3),
        ("o3", "", "u1", T0, True, 4)],
        "order_id string, offer_id string, user_id string, requested_at timestamp_ntz, hold_success boolean, seq long")
    offers = _written(spark, tmp_dir, "offers", [("of-1", "u1", "s1", T0, 1, 2, 3), ("", "u1", "s2", T0, 1, 2, 3)],
                      "id string, user_id string, scooter_id string, expires_at timestamp_ntz, price_per_minute int, "
                      "price_unlock int, deposit int")
    out = admission.admit_orders(req, offers, ["seq"])
    assert _shuffles(_plan(out), "_offer") == 1
    assert {r.seq: (r.outcome, r.offer_scooter_id) for r in out.collect()} == {
        1: ("CREATED", "s1"), 2: ("DUPLICATE", "s1"), 3: ("OFFER_ID_REQUIRED", None), 4: ("OFFER_ID_REQUIRED", "s2")}


def test_finish_shuffles_requests_once(spark, tmp_dir):
    orders = _written(spark, tmp_dir, "orders", [("o1", "u1", "ACTIVE", T0, T0, 10, 20, 100)],
                      "id string, user_id string, status string, start_time timestamp_ntz, created_at timestamp_ntz, "
                      "price_per_minute int, price_unlock int, deposit int")
    req = _written(spark, tmp_dir, "req", [("o1", T0, 1), ("o1", T0, 2), (None, T0, 3), ("", T0, 4)], KEYS)
    pays = _written(spark, tmp_dir, "pays", [("o1", "charge", False), ("o1", "charge", True), ("o1", "other", True),
                                             ("o2", "other", True)],
                    "order_id string, op string, success boolean")
    done = finish.finish_rides(orders, req, pays, ["seq"])
    plan = _plan(done)
    assert _shuffles(plan, "_order") == 1
    # the payments too, by their order alone
    assert _shuffles(plan, "order_id") == 1
    assert {r.seq: r.outcome for r in done.collect()} == {
        1: "FINISHED", 2: "ORDER_NOT_ACTIVE", 3: "ORDER_ID_REQUIRED", 4: "ORDER_ID_REQUIRED"}
    got = {r.order_id: (r.hold_ok, r.charge_ok, r.unhold_result) for r in finish.payment_results(pays).collect()}
    assert got == {"o1": (None, True, None), "o2": (None, None, None)}


LINEITEM = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


def _tables(spark, tmp_dir, items):
    spark.createDataFrame([(k, 7, "F", "5-LOW", T0) for k in (1, 2)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, "
                          "o_orderdate timestamp_ntz").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame(items, LINEITEM).write.parquet(f"{tmp_dir}/lineitem.parquet")


def test_world_writes_what_is_read(spark, tmp_dir):
    day = T0 + dt.timedelta(days=1)
    _tables(spark, tmp_dir, [(1, 1, 5, 3, 1.0, "N", "F", day), (1, 2, 5, 3, 1.0, "N", "F", day),
                             (2, 1, 97, 3, 1.0, "N", "F", day)])
    admitted, orders, done, snap, ledger = registry._world(spark, tmp_dir)
    assert "l_orderkey" not in admitted.columns + done.columns
    assert [r.outcome for r in admitted.collect()] == ["CREATED"]
    assert [(r.order_id, r.outcome) for r in done.collect()] == [("order-1-1", "FINISHED")]
    assert [r.status for r in snap.collect()] == ["FINISHED"] and ledger.count() == 3
    every = registry._world(spark, tmp_dir, all_outcomes=True, order_cols=si.ORDER_REQUEST_TIEBREAK)[0]
    assert sorted(r.outcome for r in every.collect()) == ["CREATED", "OFFER_ALREADY_USED", "ORDER_ID_REQUIRED"]
    assert "l_orderkey" in every.columns


def test_requests_meet_all_storage_outcomes_of_their_key(spark, tmp_dir):
    _tables(spark, tmp_dir, [
        (1, 1, 5, 3, 1.0, "N", "F", T0), (1, 1, 5, 3, 1.0, "N", "O", T0), (1, 1, 5, 3, 1.0, "R", None, T0),
        (2, 1, 5, 3, 1.0, "N", "O", T0), (2, 1, 5, None, 1.0, "N", "O", T0), (2, 1, 5, None, 1.0, "N", "F", T0)])
    li = spark.read.parquet(f"{tmp_dir}/lineitem.parquet")
    req = si.order_requests_from_lineitem(li, spark.read.parquet(f"{tmp_dir}/orders.parquet"))
    st = li.select(*si.ORDER_REQUEST_TIEBREAK, (F.col("l_linestatus") != "O").alias("persisted"))
    want = req.join(st, si.ORDER_REQUEST_TIEBREAK, "left")
    got = si.order_requests_with_persist(spark, tmp_dir)
    assert got.columns == want.columns
    assert _plan(got).count("SortMergeJoin") == 1        # with the orders only
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 12


def test_ttl_chain_shuffles_its_rows_once(spark, monkeypatch):
    plans = {}
    write = ttl.materialize

    def spy(df, name):
        plans[name] = _plan(df)
        return write(df, name)

    monkeypatch.setattr(ttl, "materialize", spy)
    rows = spark.createDataFrame([("a", T0 + dt.timedelta(seconds=40 * i), i) for i in range(5)],
                                 "k string, ts timestamp_ntz, seq long")
    out = ttl.ttl_chain(rows, ["k"], "ts", ["seq"], 100)
    assert [r.is_anchor for r in out.orderBy("seq").collect()] == [True, False, False, True, False]
    reads = [x for x in plans["ttl-segments"].splitlines() if "FileScan" in x]
    assert len(reads) == 1                               # the gaps, the summary and the extents share it

"""Tables rewritten where touched, and long chains of shared order ids."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators import admission, finish, retention
from ridelake.plans import partitions
from ridelake.plans.components import components

T0 = dt.datetime(2024, 1, 1, 8)


def _orders(spark, days, per_day):
    n = days * per_day
    base = spark.range(n).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("id"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.floor(F.col("id") / per_day).cast("int"),
                                                              (F.col("id") % per_day).cast("int"))).alias("created_at"))
    return base.select(*[F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in schemas.ORDERS.fields])


def _files(root, version):
    return sorted({d for d, _, names in os.walk(os.path.join(root, f"version={version}"))
                   if any(f.endswith(".parquet") for f in names)})


def test_a_batch_that_touches_one_of_thirty_days_writes_one(spark, tmp_dir):
    orders = _orders(spark, 30, 4)
    partitions.publish(orders, tmp_dir, "a", "created_at")
    assert len(_files(tmp_dir, "a")) == 30
    done = spark.createDataFrame(
        [("o40", "FINISHED", T0, 60, 7), ("o41", "PAYMENT_FAILED", T0, 61, 8), ("o42", "NOT_FOUND", T0, 62, 9),
         ("nowhere", "FINISHED", T0, 60, 7)],
        "order_id string, outcome string, requested_at timestamp_ntz, duration_seconds int, total_amount int")
    assert finish.publish_finish(spark, tmp_dir, "a", "b", done) == ["2024-01-11"]
    assert len(_files(tmp_dir, "b")) == 1
    got = partitions.read(spark, tmp_dir, "b", schemas.ORDERS)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(finish.apply_finish(orders, done))
    assert got.where("status = 'FINISHED'").count() == 1
    # the version before stays as it was
    assert key(partitions.read(spark, tmp_dir, "a", schemas.ORDERS)) == key(orders)

    # days before the cutoff are not opened, the day of the cutoff is rewritten
    out = retention.publish_cleanup(spark, tmp_dir, "b", "c", T0 + dt.timedelta(days=21, hours=2), 24)
    assert out["orders_deleted"] == 20 * 4 + 2 and out["parts_rewritten"] == ["2024-01-21"]
    assert len(out["parts_dropped"]) == 20 and out["duration_ms"] >= 0
    assert len(_files(tmp_dir, "c")) == 1
    assert partitions.read(spark, tmp_dir, "c", schemas.ORDERS).count() == 120 - 82
    again = retention.publish_cleanup(spark, tmp_dir, "c", "d", T0 + dt.timedelta(days=21, hours=2), 24)
    assert again["orders_deleted"] == 0 and again["parts_rewritten"] == [] and _files(tmp_dir, "d") == []

    ids = spark.createDataFrame([("o119",), ("gone",)], "id string")
    assert retention.publish_cleanup(spark, tmp_dir, "d", "e", None, ids=ids)["orders_deleted"] == 1
    with pytest.raises(retention.NothingDeleted):
        retention.publish_cleanup(spark, tmp_dir, "e", "f", None, ids=ids)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 500)]
    star = [(1000, k) for k in range(1001, 1300)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(chain + star + [(7, 7), (2000, 2001), (2001, 2000)], "a long, b long"), "a", "b").collect()}
    want = {**{i: 0 for i in range(501)}, **{k: 1000 for k in range(1000, 1300)}, 2000: 2000, 2001: 2000}
    assert got == want


def test_a_chain_of_shared_order_ids_takes_few_jobs(spark, monkeypatch):
    """Every request waits for the one before it: rounds alone would need one
    for each pair."""
    n = 3000
    rows = []
    for i in range(n):
        rows += [(f"o{i}", f"f{i}", 2 * i), (f"o{i}", f"f{i + 1}", 2 * i + 1)]
    req = spark.createDataFrame(rows, "order_id string, offer_id string, n long").select(
        "order_id", "offer_id", F.lit("u").alias("user_id"), F.lit(True).alias("hold_success"), "n",
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                              F.col("n").cast("decimal(18,6)"))).alias("requested_at"))
    offers = spark.range(n + 1).select(
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("id"), F.lit("u").alias("user_id"),
        F.lit("s").alias("scooter_id"), F.lit(T0 + dt.timedelta(days=9)).cast("timestamp_ntz").alias("expires_at"),
        F.lit(1).alias("price_per_minute"), F.lit(1).alias("price_unlock"), F.lit(1).alias("deposit"))
    calls = []
    real = admission.materialize
    monkeypatch.setattr(admission, "materialize", lambda df, name: calls.append(name) or real(df, name))
    got = {r.n: r.outcome for r in admission.admit_orders(req, offers, ["n"]).select("n", "outcome").collect()}
    taken, made, want = set(), set(), {}
    for order, offer, k in rows:
        want[k] = "DUPLICATE" if order in made else "OFFER_ALREADY_USED" if offer in taken else "CREATED"
        if want[k] == "CREATED":
            made.add(order)
            taken.add(offer)
    assert got == want
    assert len(calls) < 20

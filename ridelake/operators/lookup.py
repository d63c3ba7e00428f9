"""Order reads and key lookups (F03, P01, P02, W04, W05, O01, O02, J07, J10, J11,
E14, L01, L03).

Point reads of the service become batch lookups: a DataFrame of ids joined to
the orders table.  Membership tests are semi/anti joins, never a giant
``isin`` list on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import billing
from ..functions.status import ORDER_READ_STATUS, status_code
from ..plans.broadcast import broadcast_if_small
from ..plans.keyed import sequence_number


def order_read_model(orders: DataFrame) -> DataFrame:
    """The 12-column order document; ``total_amount`` becomes ``current_amount``."""
    return orders.select(
        "id", "user_id", "scooter_id", "offer_id", "price_per_minute", "price_unlock",
        "deposit", F.col("total_amount").alias("current_amount"), "status", "start_time",
        "finish_time", "duration_seconds")


def null_to_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null integers read as 0."""
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def lookup_orders(ids: DataFrame, orders: DataFrame, id_col: str = "order_id") -> DataFrame:
    """batch read by id; empty id -> ORDER_ID_REQUIRED, absent -> NOT_FOUND."""
    doc = order_read_model(orders)
    j = ids.join(doc, ids[id_col] == doc["id"], "left")
    outcome = (F.when(F.coalesce(F.col(id_col), F.lit("")) == "", "ORDER_ID_REQUIRED")
               .when(F.col("id").isNull(), "NOT_FOUND").otherwise("FOUND"))
    return j.withColumn("outcome", outcome).withColumn(
        "http_status", status_code(F.col("outcome"), ORDER_READ_STATUS))


def latest_order_per_offer(orders: DataFrame) -> DataFrame:
    """The most recent order of every offer (``max_by`` per key, no window)."""
    return (orders.groupBy("offer_id")
            .agg(F.max_by(F.struct(*[c for c in orders.columns]),
                          F.struct("created_at", "id")).alias("o"))
            .select("o.*"))


def latest_order_for_offer(orders: DataFrame, offer_id: str) -> DataFrame:
    """``ORDER BY created_at DESC LIMIT 1`` for one offer (TakeOrderedAndProject)."""
    return (orders.where(F.col("offer_id") == offer_id)
            .orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(1))


def user_history(orders: DataFrame, start, end) -> DataFrame:
    """Orders created in ``[start, end)`` with each user's sequence number.

    The range filter reaches the Parquet scan; the per-user numbering runs
    per (user, day) with day offsets from a per-day summary, so a very active
    user is not numbered in a single task."""
    f = orders.where((F.col("created_at") >= F.lit(start)) & (F.col("created_at") < F.lit(end)))
    return sequence_number(f, ["user_id"], "created_at", ["id"], "seq")


def expired_orders(orders: DataFrame, as_of, older_than_hours: int = 24) -> DataFrame:
    """F07 + O02 + P01: orders created before ``as_of - older_than`` (any status),
    oldest first."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(0), F.lit(int(older_than_hours)))
    old = orders.where(F.col("created_at") < cutoff).orderBy(F.col("created_at"), F.col("id"))
    return old.select(
        "id", "user_id", "scooter_id", "offer_id", "price_per_minute", "price_unlock",
        "deposit", F.col("total_amount").alias("current_amount"), "status", "start_time",
        "finish_time", "duration_seconds", "created_at")


def orphan_ledger_rows(ledger: DataFrame, orders: DataFrame) -> DataFrame:
    """Ledger rows whose order does not exist (anti join)."""
    return ledger.join(orders.select(F.col("id").alias("order_id")), "order_id", "left_anti")


def orders_with_ledger(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """Order <-> ledger 1:N."""
    return orders.join(ledger.withColumnRenamed("id", "txn_id")
                       .withColumnRenamed("user_id", "txn_user_id")
                       .withColumnRenamed("status", "txn_status")
                       .withColumnRenamed("created_at", "txn_created_at"),
                       orders["id"] == F.col("order_id"), "inner")


def ride_status_view(orders: DataFrame, scooters: DataFrame, as_of) -> DataFrame:
    """J11 + E14: active rides with the scooter's current charge and the cost
    accrued so far at ``as_of``."""
    s = broadcast_if_small(scooters.select(F.col("id").alias("_s_id"),
                                           F.col("charge").alias("scooter_charge")))
    act = orders.where(F.col("status") == "ACTIVE")
    j = act.join(s, act["scooter_id"] == s["_s_id"], "left").drop("_s_id")
    at = F.lit(as_of).cast("timestamp_ntz")
    return j.select("id", "user_id", "scooter_id", "start_time", "scooter_charge",
                    billing.ride_seconds(F.col("start_time"), at).alias("elapsed_seconds"),
                    billing.running_cost(F.col("start_time"), at, F.col("price_per_minute"),
                                         F.col("price_unlock")).alias("running_cost"))


def shard_of(user_id, num_shards: int):
    """L01/L03 routing column: ``hash(user_id) % n`` from the first 8 hex digits
    of md5 (portable across engines)."""
    h = F.conv(F.substring(F.md5(user_id), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(num_shards)).cast("int")


def order_shard_map(orders: DataFrame, num_shards: int) -> DataFrame:
    """``order_id -> shard`` lookup table."""
    return orders.select(F.col("id").alias("order_id"), "user_id",
                         shard_of(F.col("user_id"), num_shards).alias("shard"))

"""Ride finish and the payment ledger.

``finish_rides`` replays finish calls against an orders snapshot:

* empty order id -> ``ORDER_ID_REQUIRED``; unknown order (or a call before
  the order existed) -> ``ORDER_NOT_FOUND``; order not ACTIVE ->
  ``ORDER_NOT_ACTIVE`` (F06);
* the first call per ACTIVE order wins (W03, by aggregation + join, so a hot
  order id is not funnelled through one window task); later calls see a
  closed order -> ``ORDER_NOT_ACTIVE``;
* the winner is billed (E08-E10, threshold from the config), charged and, on
  a successful charge only, the deposit released (E13, from the S09 feed).

``finish_ledger`` emits the CLEAR and REFUND rows (K02), ``apply_finish`` the
updated orders snapshot and ``ledger_rollup`` the per-order pivot (A15).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import billing, pricing
from ..functions.status import FINISH_STATUS, status_code
from ..plans import partitions
from ..plans.broadcast import broadcast_if_small
from ..plans.materialize import has_rows, materialize
from ..sources.tables import resolve_configs

# Ids of the charge and of the release, where the payment feed has them.
TXN_ID_COLUMNS = ("charge_txn_id", "unhold_txn_id")


def payment_results(outcomes: DataFrame) -> DataFrame:
    """Pivot the payment feed to one row per order (charge, unhold).  A feed
    with ``transaction_id`` also gives the id of each operation, of its
    successful rows where it has any (the largest id, where several)."""
    if "transaction_id" in outcomes.columns:
        got = (outcomes.groupBy("order_id").pivot("op", ["hold", "charge", "unhold"])
               .agg(F.max(F.struct(F.col("success").cast("int").alias("ok"), F.col("transaction_id").alias("txn")))))
        return got.select("order_id", (F.col("hold.ok") == 1).alias("hold_ok"),
                          (F.col("charge.ok") == 1).alias("charge_ok"),
                          (F.col("unhold.ok") == 1).alias("unhold_result"),
                          F.col("charge.txn").alias("charge_txn_id"), F.col("unhold.txn").alias("unhold_txn_id"))
    # one aggregation by order: pivot() would shuffle by (order, operation) first
    best = lambda op: F.max(F.when(F.col("op") == op, F.col("success").cast("int"))) == 1
    return outcomes.groupBy("order_id").agg(best("hold").alias("hold_ok"), best("charge").alias("charge_ok"),
                                            best("unhold").alias("unhold_result"))


def finish_rides(orders: DataFrame, requests: DataFrame, payments: DataFrame,
                 tiebreak: list[str], configs: DataFrame | None = None,
                 ts: str = "requested_at") -> DataFrame:
    o = _order_columns(orders)
    # joined by a key that is never null: no null filter tells the uses of the
    # requests below apart, and they read one shuffle
    j = requests.withColumn("_order", F.coalesce(F.col("order_id"), F.lit("")))
    named = F.col("order_id").isNotNull()
    j = j.join(o, (j["_order"] == o["_o_id"]) & named, "left")
    j = j.withColumn("_k", F.struct(F.col(ts).alias("_k0"), *[F.col(c) for c in tiebreak]))
    j = j.withColumn("_reject", _reject(ts))
    # conditional, so that both uses of ``j`` read one shuffle of the requests
    first = (j.groupBy(F.col("_order").alias("_w_order"))
             .agg(F.min(F.when(F.col("_reject").isNull(), F.col("_k"))).alias("_w_key")))
    j = j.join(first, j["_order"] == first["_w_order"], "left").drop("_w_order")
    win = F.col("_reject").isNull() & (F.col("_k") == F.col("_w_key"))
    pay = payment_results(payments).withColumnRenamed("order_id", "_p_order")
    j = j.withColumn("_win", win).join(
        pay, (F.col("_order") == pay["_p_order"]) & named, "left")
    return _billed(j, requests.columns, configs, ts)


def close_rides(orders: DataFrame, requests: DataFrame, payments: DataFrame,
                tiebreak: list[str], configs: DataFrame | None = None,
                ts: str = "requested_at") -> DataFrame:
    """The rows of ``finish_rides`` whose call closes a ride (FINISHED or
    PAYMENT_FAILED), in one pass: a call without an order to close drops out as
    it meets the orders, and of the others the first per order stays (with those
    of an equal key)."""
    return _billed(_closing(orders, requests, payments, tiebreak, ts), requests.columns, configs, ts)


def closed_rides(orders: DataFrame, requests: DataFrame, payments: DataFrame, tiebreak: list[str],
                 columns: list[str], configs: DataFrame | None = None, ts: str = "requested_at") -> DataFrame:
    """``columns`` of ``close_rides``, written once, where none of them tells the
    calls of one order and time apart: the calls are shuffled as order id and
    time alone.  Which calls at an order's closing time are of one key is decided
    anew with the tie-break columns, for the orders that have several."""
    calls = requests.select("order_id", ts)
    mates = F.count(F.lit(1)).over(Window.partitionBy("order_id"))
    won = _closing(orders, calls, payments, [], ts, {"_mates": mates})
    made = materialize(_billed(won, [*calls.columns, "_mates"], configs, ts).select(*columns, "_mates"), "finished")
    several = made.where("_mates > 1").select(F.col("order_id").alias("_s_order")).distinct()
    made = made.where("_mates = 1").drop("_mates")
    if not has_rows(several):
        return made
    several = broadcast_if_small(several)

    def of_several(df: DataFrame, key: str) -> DataFrame:
        return df.join(several, df[key] == several["_s_order"], "left_semi")

    again = close_rides(of_several(orders, "id"), of_several(requests, "order_id"), of_several(payments, "order_id"),
                        tiebreak, configs, ts)
    return made.unionByName(materialize(again.select(*columns), "finished-tied"))


def _closing(orders: DataFrame, requests: DataFrame, payments: DataFrame, tiebreak: list[str], ts: str,
             over_first: dict[str, Column] | None = None) -> DataFrame:
    """The first calls of active orders with what the payment feed says;
    ``over_first`` are columns to work out from those first calls."""
    o = _order_columns(orders)
    j = requests.join(o, requests["order_id"] == o["_o_id"]).withColumn("_reject", _reject(ts))
    turn = F.rank().over(Window.partitionBy("order_id").orderBy(ts, *tiebreak))
    won = j.where(F.col("_reject").isNull()).withColumn("_turn", turn).where(F.col("_turn") == 1)
    won = won.withColumns({"_win": F.lit(True), **(over_first or {})})
    pay = payment_results(payments).withColumnRenamed("order_id", "_p_order")
    return won.join(pay, won["order_id"] == pay["_p_order"], "left")


def _order_columns(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("id").alias("_o_id"), F.col("user_id").alias("_o_user"),
        F.col("status").alias("_o_status"), F.col("start_time").alias("_o_start"),
        F.col("created_at").alias("_o_created"), F.col("price_per_minute").alias("_o_ppm"),
        F.col("price_unlock").alias("_o_unlock"), F.col("deposit").alias("_o_deposit"))


def _reject(ts: str) -> Column:
    """why a finish call finds no active order."""
    return (F.when(F.coalesce(F.col("order_id"), F.lit("")) == "", "ORDER_ID_REQUIRED")
            .when(F.col("_o_id").isNull() | (F.col(ts) < F.col("_o_created")), "ORDER_NOT_FOUND")
            .when(F.col("_o_status") != "ACTIVE", "ORDER_NOT_ACTIVE"))


def _billed(j: DataFrame, columns: list[str], configs: DataFrame | None, ts: str) -> DataFrame:
    """The outcome of every call, those that close a ride billed."""
    thr = resolve_configs(configs, j.sparkSession)["incomplete_ride_threshold_seconds"]
    secs = billing.ride_seconds(F.col("_o_start"), F.col(ts))
    total = billing.ride_total(secs, F.col("_o_ppm"), F.col("_o_unlock"), F.lit(thr))
    charge_ok = F.coalesce(F.col("charge_ok"), F.lit(False))
    unhold = billing.unhold_ok(charge_ok, F.col("unhold_result"))
    status = billing.final_status(charge_ok)
    outcome = (F.when(F.col("_reject").isNotNull(), F.col("_reject"))
               .when(~F.col("_win"), "ORDER_NOT_ACTIVE").otherwise(status))
    w = F.col("_win")
    txn_ids = [F.when(w, F.col(c)).alias(c) for c in TXN_ID_COLUMNS if c in j.columns]
    return j.select(
        *columns,
        outcome.alias("outcome"),
        status_code(outcome, FINISH_STATUS).alias("http_status"),
        F.when(w, secs).alias("duration_seconds"),
        F.when(w, total).alias("total_amount"),
        F.when(w, charge_ok).alias("charge_ok"),
        F.when(w, unhold).alias("unhold_ok"),
        F.col("_o_user").alias("order_user_id"),
        F.col("_o_deposit").alias("order_deposit"),
        *txn_ids,
    )


def finish_ledger(finished: DataFrame, ts: str = "requested_at") -> DataFrame:
    """CLEAR (amount = total) and REFUND (amount = deposit) rows of each
    billed finish; REFUND is written even when the release was never attempted.
    External ids are empty, unless the payment feed had them: then a successful
    CLEAR or REFUND carries its own."""
    won = finished.where(F.col("outcome").isin("FINISHED", "PAYMENT_FAILED"))
    ok = lambda c: F.when(c, F.lit("SUCCESS")).otherwise(F.lit("FAILED"))

    def external(done: str, txn_id: str) -> Column:
        if txn_id not in finished.columns:
            return F.lit("").alias("ext")
        return F.when(F.col(done), F.coalesce(F.col(txn_id), F.lit(""))).otherwise("").alias("ext")

    clear_id, refund_id = TXN_ID_COLUMNS
    rows = F.array(
        F.struct(pricing.clear_txn_id(F.col("order_id")).alias("id"),
                 F.lit("CLEAR").alias("transaction_type"),
                 F.col("total_amount").alias("amount"), ok(F.col("charge_ok")).alias("status"),
                 external("charge_ok", clear_id)),
        F.struct(pricing.refund_txn_id(F.col("order_id")).alias("id"),
                 F.lit("REFUND").alias("transaction_type"),
                 F.coalesce(F.col("order_deposit"), F.lit(0)).alias("amount"),
                 ok(F.col("unhold_ok")).alias("status"), external("unhold_ok", refund_id)))
    ex = won.select("order_id", F.col("order_user_id").alias("user_id"), F.col(ts).alias("_ts"),
                    F.inline(rows))
    return ex.select("id", "order_id", "user_id", "transaction_type",
                     F.col("amount").cast("int").alias("amount"), "status",
                     F.col("ext").alias("external_transaction_id"),
                     F.lit(None).cast("string").alias("error_message"),
                     F.col("_ts").alias("created_at"))


def apply_finish(orders: DataFrame, finished: DataFrame, ts: str = "requested_at") -> DataFrame:
    """K02 upsert: new snapshot with finish_time, duration, total, status and
    updated_at set on finished orders (left join + coalesce, no row-level MERGE)."""
    upd = finished.where(F.col("outcome").isin("FINISHED", "PAYMENT_FAILED")).select(
        F.col("order_id").alias("_u_id"), F.col(ts).alias("_u_ts"),
        F.col("duration_seconds").alias("_u_dur"), F.col("total_amount").alias("_u_total"),
        F.col("outcome").alias("_u_status"))
    j = orders.join(upd, orders["id"] == upd["_u_id"], "left")
    hit = F.col("_u_id").isNotNull()
    out = {
        "finish_time": F.when(hit, F.col("_u_ts")).otherwise(F.col("finish_time")),
        "duration_seconds": F.when(hit, F.col("_u_dur")).otherwise(F.col("duration_seconds")),
        "total_amount": F.when(hit, F.col("_u_total")).otherwise(F.col("total_amount")),
        "status": F.when(hit, F.col("_u_status")).otherwise(F.col("status")),
        "updated_at": F.when(hit, F.col("_u_ts")).otherwise(F.col("updated_at")),
    }
    return j.select(*[out[f.name].alias(f.name) if f.name in out else F.col(f.name)
                      for f in schemas.ORDERS.fields])


def publish_finish(spark, root: str, old: str, new: str, finished: DataFrame,
                   span: str = partitions.DAY) -> list[str]:
    """K02 on a published orders table: only the partitions that hold a finished
    order are read and rewritten.  Returns the partitions written."""
    table = partitions.read(spark, root, old, schemas.ORDERS)
    done = finished.where(F.col("outcome").isin("FINISHED", "PAYMENT_FAILED"))
    parts = partitions.touched(table, "id", done, "order_id", "created_at", span)
    some = partitions.read(spark, root, old, schemas.ORDERS, parts)
    return partitions.republish(spark, root, old, new, parts, apply_finish(some, finished), "created_at", span)


def ledger_rollup(ledger: DataFrame) -> DataFrame:
    """Per order, amount and status of each transaction type (explicit pivot)."""
    # one aggregation by order: pivot() would shuffle by (order, type) first
    of = lambda t, c: F.when(F.col("transaction_type") == t, F.col(c))
    return ledger.groupBy("order_id").agg(*[c for t in schemas.TXN_TYPES for c in (
        F.sum(of(t, "amount")).cast("long").alias(f"{t.lower()}_amount"),
        F.max(of(t, "status")).alias(f"{t.lower()}_status"))])


def ride_billing_summary(rides: DataFrame, threshold: int = billing.DEFAULT_INCOMPLETE_RIDE_SECONDS
                         ) -> DataFrame:
    """E08-E10 over stored rides: per status the ride count, the billed total
    (closed rides by duration, active rides at the unlock price) and the
    number of rides under the incomplete-ride threshold."""
    closed = F.col("duration_seconds").isNotNull()
    billed = F.when(closed, billing.ride_total(F.col("duration_seconds"), F.col("price_per_minute"),
                                               F.col("price_unlock"), threshold)) \
        .otherwise(F.col("price_unlock"))
    return rides.groupBy("status").agg(
        F.count(F.lit(1)).alias("rides"),
        F.sum(billed.cast("long")).alias("billed_total"),
        F.sum((closed & (F.col("duration_seconds") < threshold)).cast("long")).alias("short_rides"))

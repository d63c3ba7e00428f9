"""Data quality and reconciliation.

Every check is a count of violating rows, computed in one pass per table with
conditional aggregates and returned as ``(rule, violations)`` rows (a
``stack`` unpivot of the single aggregate row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import billing

# Column length limits of the storage schema.
ORDER_LENGTHS = {"id": 255, "user_id": 255, "scooter_id": 255, "offer_id": 255, "status": 50}
TXN_LENGTHS = {"id": 255, "order_id": 255, "user_id": 255, "transaction_type": 50,
               "status": 50, "external_transaction_id": 255}
ORDER_NOT_NULL = ["id", "user_id", "scooter_id", "offer_id", "price_per_minute", "price_unlock",
                  "deposit", "total_amount", "status", "start_time", "created_at", "updated_at"]
TXN_NOT_NULL = ["id", "order_id", "user_id", "transaction_type", "amount", "status",
                "created_at"]
OFFER_TTL_SECONDS, OFFER_TTL_TOLERANCE = 300, 10


def _count_if(cond: Column) -> Column:
    return F.sum(F.coalesce(cond, F.lit(False)).cast("long"))


def _report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One aggregate row, unpivoted to (rule, violations)."""
    agg = df.agg(*[_count_if(c).alias(f"c{i}") for i, c in enumerate(checks.values())])
    names = list(checks)
    expr = "stack({n}, {pairs}) as (rule, violations)".format(
        n=len(names), pairs=", ".join(f"'{k}', coalesce(c{i}, 0L)" for i, k in enumerate(names)))
    return agg.selectExpr(expr)


def _dup_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """F11 primary key: number of key values held by more than one row."""
    d = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return d.agg(F.count(F.lit(1)).cast("long").alias("violations")).select(
        F.lit(name).alias("rule"), "violations")


def order_constraints(orders: DataFrame) -> DataFrame:
    """F10/F11 on the orders table."""
    checks = {f"orders.{c}.not_null": F.col(c).isNull() for c in ORDER_NOT_NULL}
    checks.update({f"orders.{c}.length": F.length(c) > n for c, n in ORDER_LENGTHS.items()})
    checks["orders.status.domain"] = ~F.col("status").isin(*schemas.ORDER_STATUSES)
    return _report(orders, checks).unionByName(_dup_keys(orders, "id", "orders.id.unique"))


def ledger_constraints(ledger: DataFrame) -> DataFrame:
    """F10/F11 on the payment ledger."""
    checks = {f"ledger.{c}.not_null": F.col(c).isNull() for c in TXN_NOT_NULL}
    checks.update({f"ledger.{c}.length": F.length(c) > n for c, n in TXN_LENGTHS.items()})
    checks["ledger.transaction_type.domain"] = ~F.col("transaction_type").isin(*schemas.TXN_TYPES)
    checks["ledger.status.domain"] = ~F.col("status").isin(*schemas.TXN_STATUSES)
    return _report(ledger, checks).unionByName(_dup_keys(ledger, "id", "ledger.id.unique"))


def offer_contract(offers: DataFrame) -> DataFrame:
    """Q01/Q02/Q04: required fields, non-negative prices, unique ids, TTL 300 +- 10 s."""
    req = ["id", "user_id", "scooter_id", "zone_id", "price_per_minute", "price_unlock",
           "deposit", "expires_at"]
    checks = {f"offer.{c}.required": F.col(c).isNull() for c in req}
    checks.update({f"offer.{c}.non_negative": F.col(c) < 0
                   for c in ("price_per_minute", "price_unlock", "deposit")})
    ttl = F.timestamp_diff("SECOND", F.col("created_at"), F.col("expires_at"))
    checks["offer.ttl"] = F.abs(ttl - OFFER_TTL_SECONDS) > OFFER_TTL_TOLERANCE
    return _report(offers, checks).unionByName(_dup_keys(offers, "id", "offer.id.unique"))


def order_contract(orders: DataFrame, offers: DataFrame,
                   threshold: int = billing.DEFAULT_INCOMPLETE_RIDE_SECONDS) -> DataFrame:
    """Q03/Q05/Q06/Q07: order fields and status, one order per offer, finished
    total = recomputed bill, order prices = offer prices."""
    closed = F.col("status").isin("FINISHED", "PAYMENT_FAILED")
    recomputed = billing.ride_total(F.col("duration_seconds"), F.col("price_per_minute"),
                                    F.col("price_unlock"), threshold)
    o = offers.select(F.col("id").alias("_of_id"), F.col("price_per_minute").alias("_of_ppm"),
                      F.col("price_unlock").alias("_of_unlock"), F.col("deposit").alias("_of_dep"))
    j = orders.join(o, orders["offer_id"] == o["_of_id"], "left")
    checks = {
        "order.status.valid": ~F.col("status").isin(*schemas.ORDER_STATUSES),
        "order.finished.fields": closed & (F.col("finish_time").isNull()
                                           | F.col("duration_seconds").isNull()),
        "order.finished.total": closed & (F.col("total_amount") != recomputed),
        "order.prices_match_offer": F.col("_of_id").isNotNull() & (
            (F.col("price_per_minute") != F.col("_of_ppm"))
            | (F.col("price_unlock") != F.col("_of_unlock"))
            | (F.col("deposit") != F.col("_of_dep"))),
    }
    per_offer = _dup_keys(orders, "offer_id", "order.one_per_offer")
    return _report(j, checks).unionByName(per_offer)


def ledger_invariants(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """Q08: successful HOLD without an order; Q09: more than one successful
    CLEAR per order; Q10: FINISHED without a successful REFUND."""
    ids = orders.select(F.col("id").alias("order_id"))
    hold = ledger.where((F.col("transaction_type") == "HOLD") & (F.col("status") == "SUCCESS"))
    lost = hold.join(ids, "order_id", "left_anti").agg(F.count(F.lit(1)).alias("violations"))
    clears = (ledger.where((F.col("transaction_type") == "CLEAR") & (F.col("status") == "SUCCESS"))
              .groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
              .agg(F.count(F.lit(1)).alias("violations")))
    refunds = ledger.where((F.col("transaction_type") == "REFUND")
                           & (F.col("status") == "SUCCESS")).select("order_id")
    unrefunded = (orders.where(F.col("status") == "FINISHED").select(F.col("id").alias("order_id"))
                  .join(refunds, "order_id", "left_anti").agg(F.count(F.lit(1)).alias("violations")))
    return (lost.select(F.lit("hold_without_order").alias("rule"), "violations")
            .unionByName(clears.select(F.lit("charged_twice").alias("rule"), "violations"))
            .unionByName(unrefunded.select(F.lit("finished_without_refund").alias("rule"),
                                           "violations")))

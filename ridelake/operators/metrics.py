"""Business and scenario metrics (A07-A10, A13) and the order read cache
replay (T06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ttl import ttl_chain

ORDER_CACHE_TTL_SECONDS = 1800  # fixed value: orders are cached for thirty minutes


def scenario_report(results: DataFrame, success: str = "success", ts: str = "ts") -> DataFrame:
    """Successes, failures, throughput (per second of the covered span)
    and success percentage (0 when there is nothing to divide)."""
    agg = results.agg(
        F.sum(F.col(success).cast("long")).alias("successes"),
        F.sum((~F.col(success)).cast("long")).alias("failures"),
        F.count(F.lit(1)).alias("total"),
        F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)).alias("_span_us"))
    return agg.select(
        "successes", "failures", "total",
        F.round(F.try_divide(F.col("total").cast("double") * 1e6,
                             F.col("_span_us").cast("double")), 6).alias("throughput_per_sec"),
        F.round(F.coalesce(F.try_divide(F.col("successes") * 100.0, F.col("total").cast("double")),
                           F.lit(0.0)), 6).alias("success_pct"))


def per_user_outcomes(results: DataFrame, user: str = "user_id",
                      success: str = "success") -> DataFrame:
    """Successes and failures per user."""
    return results.groupBy(user).agg(
        F.sum(F.col(success).cast("long")).alias("successes"),
        F.sum((~F.col(success)).cast("long")).alias("failures"))


def business_counters(offer_results: DataFrame, admission: DataFrame, orders: DataFrame,
                      ledger: DataFrame) -> DataFrame:
    """Offers created, orders created, active rides, payment errors
    (failed holds + failed charges) and revenue (successful CLEAR amounts).
    Five global aggregates combined by a union + sum (no join)."""
    z = F.lit(0).cast("long")

    def part(df, **cols):
        names = ["offers_created", "orders_created", "active_rides", "payment_errors",
                 "revenue"]
        return df.select(*[cols.get(n, z).cast("long").alias(n) for n in names])

    parts = [
        part(offer_results, offers_created=F.col("is_new_offer").cast("long")),
        part(admission, orders_created=(F.col("outcome") == "CREATED").cast("long"),
             payment_errors=(F.col("outcome") == "PAYMENT_HOLD_FAILED").cast("long")),
        part(orders, active_rides=(F.col("status") == "ACTIVE").cast("long"),
             payment_errors=(F.col("status") == "PAYMENT_FAILED").cast("long")),
        part(ledger, revenue=F.when((F.col("transaction_type") == "CLEAR")
                                    & (F.col("status") == "SUCCESS"), F.col("amount"))
             .otherwise(0)),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in u.columns])


def conversion_rate(offers: DataFrame, orders: DataFrame) -> DataFrame:
    """A10: share of offers that became an order (distinct offer ids)."""
    o = offers.select(F.col("offer_id").alias("_id")).where(F.col("_id").isNotNull()).distinct()
    used = orders.select(F.col("offer_id").alias("_id")).distinct()
    j = o.join(used.withColumn("_used", F.lit(1)), "_id", "left")
    agg = j.agg(F.count(F.lit(1)).alias("offers"), F.count("_used").alias("converted"))
    return agg.withColumn("conversion_rate", F.try_divide(F.col("converted").cast("double"),
                                                          F.col("offers").cast("double")))


def order_cache_replay(creates: DataFrame, reads: DataFrame, finishes: DataFrame,
                       orders: DataFrame, order_cols: list[str],
                       ttl_seconds: int = ORDER_CACHE_TTL_SECONDS) -> DataFrame:
    """Replay the read-through order cache.

    Creates and successful finishes always (re)start the TTL; a read is a
    ``HIT`` inside the TTL of the latest (re)start and does not extend it; a
    read outside it is a ``MISS`` that reloads and restarts the TTL when the
    order exists at that time, else ``ABSENT`` (not cached).  Inputs carry
    ``order_id``, ``ts`` and the ``order_cols`` tie-break.  One output row per
    read.
    """
    ev = (creates.select("order_id", "ts", *order_cols).withColumn("kind", F.lit(0))
          .unionByName(finishes.select("order_id", "ts", *order_cols).withColumn("kind", F.lit(1)))
          .unionByName(reads.select("order_id", "ts", *order_cols).withColumn("kind", F.lit(2))))
    known = orders.select(F.col("id").alias("_e_id"), F.col("created_at").alias("_e_created"))
    ev = ev.join(known, ev["order_id"] == known["_e_id"], "left")
    ev = ev.withColumn("_exists", F.col("_e_id").isNotNull() & (F.col("_e_created") <= F.col("ts"))) \
        .drop("_e_id", "_e_created")
    exists = F.col("_exists")
    ch = ttl_chain(ev, ["order_id"], "ts", ["kind"] + order_cols, ttl_seconds,
                   eligible=(F.col("kind") == 2) & exists, force=F.col("kind") < 2)
    result = (F.when(~exists, "ABSENT").when(F.col("is_anchor"), "MISS")
              .when(F.col("covered"), "HIT").otherwise("MISS"))
    return ch.where(F.col("kind") == 2).select("order_id", "ts", *order_cols,
                                               result.alias("cache_result"))


def cache_hit_rate(replay: DataFrame) -> DataFrame:
    """Hits / reads."""
    agg = replay.agg(F.count(F.lit(1)).alias("reads"),
                     F.sum((F.col("cache_result") == "HIT").cast("long")).alias("hits"))
    return agg.withColumn("hit_rate", F.try_divide(F.col("hits").cast("double"),
                                                   F.col("reads").cast("double")))

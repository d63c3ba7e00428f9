"""Retention: periodic cleanup of old orders.

``cleanup`` is one run of the hourly job as a batch function of an explicit
``as_of``: select orders created before ``as_of - older_than`` (any status,
ACTIVE included), write one audit line per order, and produce the new orders
and ledger snapshots without them (anti joins; the ledger cascade follows the
order ids).  Scheduling is the caller's.

Snapshots are rewritten, never updated in place: ``publish_snapshot`` writes
orders and ledger under one new ``batch_id=`` folder and writes the manifest
last, so readers of the previous batch are never disturbed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import jsonfmt
from ..plans import partitions
from .lookup import expired_orders

DEFAULT_OLDER_THAN_HOURS = 24  # fixed value: orders older than one day are removed


def audit_lines(expired: DataFrame, as_of) -> DataFrame:
    """One ``order_deleted`` JSON line per removed order, embedding the
    order document (P12)."""
    doc = jsonfmt.order_json(*[F.col(c) for c in (
        "current_amount", "deposit", "duration_seconds", "finish_time", "id", "offer_id",
        "price_per_minute", "price_unlock", "scooter_id", "start_time", "status", "user_id")])
    line = F.concat(
        F.lit('{"level":"info","event":"order_deleted","order_id":'), jsonfmt.json_string(F.col("id"), html=False),
        F.lit(',"user_id":'), jsonfmt.json_string(F.col("user_id"), html=False),
        F.lit(',"status":'), jsonfmt.json_string(F.col("status"), html=False),
        F.lit(',"order_data":'), F.col("order_data"),
        F.lit(',"time":'), jsonfmt.json_string(jsonfmt.rfc3339(F.lit(as_of).cast("timestamp_ntz"))),
        F.lit(',"message":"Deleting old order"}'))
    return (expired.withColumn("order_data", doc)
            .select(F.lit("order_deleted").alias("event"), F.col("id").alias("order_id"),
                    "user_id", "status", "order_data", line.alias("log_line")))


def cleanup(orders: DataFrame, ledger: DataFrame, as_of,
            older_than_hours: int = DEFAULT_OLDER_THAN_HOURS) -> dict[str, DataFrame]:
    """Returns ``expired`` (O02 order), ``audit``, ``orders`` and
    ``ledger`` (kept rows) and a one-row ``summary`` (A06)."""
    expired = expired_orders(orders, as_of, older_than_hours)
    gone = expired.select(F.col("id").alias("_gone_id"))
    kept_orders = orders.join(gone, orders["id"] == gone["_gone_id"], "left_anti")
    kept_ledger = ledger.join(gone, ledger["order_id"] == gone["_gone_id"], "left_anti")
    deleted_txns = ledger.join(gone, ledger["order_id"] == gone["_gone_id"], "left_semi")
    summary = _summary(expired, deleted_txns, as_of, older_than_hours)
    return {"expired": expired, "audit": audit_lines(expired, as_of), "orders": kept_orders,
            "ledger": kept_ledger, "summary": summary}


def _summary(expired: DataFrame, deleted_txns: DataFrame, as_of, older_than_hours) -> DataFrame:
    """Deleted orders and ledger rows in one row (two global aggregates
    combined column-wise by a union + sum, no join)."""
    a = expired.select(F.lit(1).alias("o"), F.lit(0).alias("t"))
    b = deleted_txns.select(F.lit(0).alias("o"), F.lit(1).alias("t"))
    agg = a.unionByName(b).agg(F.coalesce(F.sum("o"), F.lit(0)).cast("long").alias("orders_deleted"),
                               F.coalesce(F.sum("t"), F.lit(0)).cast("long")
                               .alias("ledger_rows_deleted"))
    return agg.select(
        F.lit(as_of).cast("timestamp_ntz").alias("as_of"),
        F.lit(int(older_than_hours)).alias("older_than_hours"),
        "orders_deleted", "ledger_rows_deleted",
        F.when(F.col("orders_deleted") == 0, "NO_OLD_ORDERS").otherwise("DELETED").alias("result"))


class NothingDeleted(LookupError):
    """A cleanup named orders, and none of them was there to delete."""


def publish_cleanup(spark: SparkSession, root: str, old: str, new: str, as_of,
                    older_than_hours: int = DEFAULT_OLDER_THAN_HOURS, ids: DataFrame | None = None,
                    span: str = partitions.DAY) -> dict:
    """K03/A06 on a published orders table: partitions wholly before the cutoff
    leave the manifest (only counted) and the cutoff's own is rewritten.  With
    ``ids`` (``id``) those orders are deleted instead, whatever their age, and
    it is an error if none exists.  Returns the orders deleted, the partitions
    rewritten and dropped, and the run's time in milliseconds."""
    began = time.monotonic()
    table = partitions.read(spark, root, old, schemas.ORDERS)
    if ids is not None:
        gone = ids.select(F.col("id").alias("_g")).distinct()
        parts = partitions.touched(table, "id", gone, "_g", "created_at", span)
        if not parts:
            raise NothingDeleted("no orders deleted")
        some = partitions.read(spark, root, old, schemas.ORDERS, parts)
        kept = some.join(gone, some["id"] == gone["_g"], "left_anti")
        n = some.join(gone, some["id"] == gone["_g"], "left_semi").count()
    else:
        cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(int(older_than_hours)))
        at = spark.range(1).select(cutoff.alias("c")).first()["c"]
        edge = partitions.part_at(at, span)
        parts = [d for d in partitions.folders_of(spark, root, old) if d <= edge and d != partitions.NO_DATE]
        some = partitions.read(spark, root, old, schemas.ORDERS, [edge])
        is_old = F.col("created_at") < F.lit(at).cast("timestamp_ntz")
        kept = some.where(~is_old)
        n = partitions.read(spark, root, old, schemas.ORDERS, parts).where(is_old).count()
        if not n:
            parts = []
    rewritten = partitions.republish(spark, root, old, new, parts, kept, "created_at", span)
    return {"orders_deleted": n, "parts_rewritten": rewritten, "parts_dropped": sorted(set(parts) - set(rewritten)),
            "duration_ms": int((time.monotonic() - began) * 1000)}


def publish_snapshot(frames: dict[str, DataFrame], root: str, batch_id: str,
                     partition_by: dict[str, list[str]] | None = None) -> str:
    """K01-K03 atomicity: write every frame under ``{root}/batch_id={id}/{name}``
    and then the manifest; a batch without a manifest is invisible."""
    base = os.path.join(root, f"batch_id={batch_id}")
    for name, df in frames.items():
        w = df.write.mode("overwrite")
        cols = (partition_by or {}).get(name)
        if cols:
            w = w.partitionBy(*cols)
        w.parquet(os.path.join(base, name))
    spark = next(iter(frames.values())).sparkSession
    manifest = json.dumps({"batch_id": batch_id, "tables": sorted(frames)})
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode(
        "overwrite").text(os.path.join(base, "_manifest"))
    return base

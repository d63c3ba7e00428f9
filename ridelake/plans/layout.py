"""Physical layout of the orders table.

Orders are routed to ``shard = hash(user_id) % n`` so one user's rows are
co-located; inside a shard, files are split by creation date and sorted by
``(user_id, created_at)`` so Parquet min/max statistics skip files for a user
or time-range read (W05).  ``bucketBy`` gives the same co-location to a
catalog table, letting later joins on ``user_id`` skip the shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import shard_of
from ..session import scratch_dir
from .broadcast import broadcast_if_small


def with_layout_columns(orders: DataFrame, num_shards: int) -> DataFrame:
    return (orders.withColumn("shard", shard_of(F.col("user_id"), num_shards))
            .withColumn("date", F.to_date(F.col("created_at"))))


def write_orders_layout(orders: DataFrame, path: str, num_shards: int) -> None:
    """A shard's rows of one date lie together, sorted, under the date's
    folder.  The rebalance keys are (date, shard), so shards and days spread
    over tasks independently, and Spark splits a large one and joins small
    ones into files of the advisory size."""
    (with_layout_columns(orders, num_shards)
     .hint("rebalance", "date", "shard")
     .sortWithinPartitions("date", "shard", "user_id", "created_at")
     .write.mode("overwrite").partitionBy("date").parquet(path))


def save_bucketed(orders: DataFrame, table: str, num_buckets: int, key: str = "user_id",
                  sort: str = "created_at", path: str | None = None) -> None:
    """L01 for catalog tables: bucketed by ``key``; ``path`` places the files
    outside the warehouse."""
    w = orders.write.mode("overwrite").bucketBy(num_buckets, key).sortBy(sort)
    (w.option("path", path) if path else w).saveAsTable(table)


def bucketed(df: DataFrame, key: str, num_buckets: int) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key``, below the shared
    checkpoint folder.  Tables of equal bucket number join on their keys
    without a shuffle, however often they are read."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex[:16]}"
    # one task per bucket writes one sorted file
    save_bucketed(df.repartition(num_buckets, key), name, num_buckets, key, key, scratch_dir(spark, name))
    return spark.table(name)


def ledger_totals(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """Orders with the number and sum of their ledger rows (zero without any),
    aggregated and joined on the order id alone."""
    sums = ledger.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("long").alias("amount"))
    return orders.join(sums.hint("merge"), orders["id"] == sums["order_id"], "left").select(
        *orders.columns, F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("amount", F.lit(0)).alias("ledger_amount"))


def write_sharded(orders: DataFrame, path: str, num_shards: int) -> None:
    """One folder per shard, rows sorted by order id."""
    (with_layout_columns(orders, num_shards).drop("date").hint("rebalance", "shard")
     .sortWithinPartitions("shard", "id").write.mode("overwrite").partitionBy("shard").parquet(path))


def orders_of_shards(orders: DataFrame, shard_map: DataFrame, ids: DataFrame) -> DataFrame:
    """The orders named by ``ids`` (``order_id``).  The ids are joined to
    their shards first; the join of those with the sharded table prunes at run
    time the folders no id lies in."""
    # blank ids and those that name no order drop out here
    named = shard_map.join(broadcast_if_small(ids.where("order_id <> ''")), "order_id").select(
        F.col("order_id").alias("_id"), F.col("shard").alias("_shard"))
    return orders.join(broadcast_if_small(named), (orders["shard"] == F.col("_shard")) & (orders["id"] == F.col("_id"))
                       ).drop("_id", "_shard")

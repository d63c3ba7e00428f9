"""Cold archive and history.

Archive rows are orders and their ledger rows as one tagged record stream
(``type`` = ``order`` / ``transaction``), grouped by the *order's* creation
hour (one folder per hour) and sorted by creation time within it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_archive

PARTITION_COLS = ["yyyy", "mm", "dd", "hh"]
ARCHIVE_RETENTION_YEARS = 3  # fixed value: cold data is kept three years


def _hour_parts(ts) -> list:
    # padding is many times cheaper than format_string, which is left the rest
    def digits(n: Column, width: int) -> Column:
        plain = n.between(0, 10 ** width - 1)
        return F.when(plain, F.lpad(n.cast("string"), width, "0")).otherwise(F.format_string(f"%0{width}d", n))

    return [digits(F.year(ts), 4).alias("yyyy"), digits(F.month(ts), 2).alias("mm"),
            digits(F.dayofmonth(ts), 2).alias("dd"), digits(F.hour(ts), 2).alias("hh")]


def archive_records(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """Tagged union of orders and their transactions with the order's
    creation hour as partition columns."""
    o = orders.select(F.lit("order").alias("type"), "*",
                      F.col("created_at").alias("order_created_at"))
    owner = orders.select(F.col("id").alias("_a_id"),
                          F.col("created_at").alias("order_created_at"))
    t = (ledger.join(owner, ledger["order_id"] == owner["_a_id"], "inner").drop("_a_id")
         .select(F.lit("transaction").alias("type"), "*"))
    u = o.unionByName(t, allowMissingColumns=True)
    return u.select("*", *_hour_parts(F.col("order_created_at")))


def write_archive(records: DataFrame, root: str, batch: str) -> None:
    """Gzip NDJSON under ``batch=<batch>`` and one folder per
    order-creation hour below it, rows sorted by creation time.  A batch
    written again replaces itself (its ``_SUCCESS`` file is written last).
    Range partitioning on (hour, creation time) gives a quiet hour one file and
    splits a busy hour into several ordered files written by several tasks,
    instead of funnelling an hour into one."""
    # (rows in order of creation are in order of their hours)
    (records.repartitionByRange("order_created_at", "type", "id")
     .sortWithinPartitions(*PARTITION_COLS, "order_created_at", "type", "id")
     .write.mode("overwrite").partitionBy(*PARTITION_COLS)
     .option("compression", "gzip").json(f"{root.rstrip('/')}/batch={batch}"))


def read_archive_range(spark: SparkSession, root: str, schema, start_day: str,
                       end_day: str) -> DataFrame:
    """Archive rows whose order was created in ``[start_day, end_day)``
    (``YYYY-MM-DD``); the day filter prunes partition folders."""
    df = read_archive(spark, root, schema)
    day = F.concat_ws("-", F.col("yyyy"), F.col("mm"), F.col("dd"))
    return df.where((day >= F.lit(start_day)) & (day < F.lit(end_day)))


def hot_cold_history(hot_orders: DataFrame, hot_ledger: DataFrame, cold: DataFrame,
                     start, end, user_id: str | None = None) -> DataFrame:
    """Orders created in ``[start, end)`` and their transactions from the
    hot tables and the archive, of one user if ``user_id`` is given, merged
    and sorted by creation time; a record present in both is taken from the
    hot side.  Archive records of both types lie in the folder of the order's
    creation hour, so the range prunes folders before any file is opened."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    day = F.concat_ws("-", F.col("yyyy"), F.col("mm"), F.col("dd"))
    cold = cold.where((day >= F.lit(str(start)[:10])) & (day <= F.lit(str(end)[:10])))
    in_range = (F.col("created_at") >= lo) & (F.col("created_at") < hi)
    if user_id is not None:
        in_range = in_range & (F.col("user_id") == user_id)
    cold_orders = cold.where((F.col("type") == "order") & in_range).select(hot_orders.columns)
    orders = (hot_orders.where(in_range).withColumn("_hot", F.lit(1))
              .unionByName(cold_orders.withColumn("_hot", F.lit(0))))
    orders = (orders.groupBy("id").agg(F.max_by(F.struct(*hot_orders.columns), F.col("_hot"))
                                        .alias("o")).select("o.*"))
    ids = orders.select(F.col("id").alias("order_id"))
    cold_tx = cold.where(F.col("type") == "transaction").select(hot_ledger.columns)
    tx = (hot_ledger.withColumn("_hot", F.lit(1))
          .unionByName(cold_tx.withColumn("_hot", F.lit(0)))
          .join(ids, "order_id", "left_semi"))
    tx = tx.groupBy("id").agg(F.max_by(F.struct(*hot_ledger.columns), F.col("_hot"))
                              .alias("t")).select("t.*")
    return (orders.select(F.lit("order").alias("type"), "*")
            .unionByName(tx.select(F.lit("transaction").alias("type"), "*"),
                         allowMissingColumns=True).orderBy("created_at", "type", "id"))


def payment_retry_worklist(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """PAYMENT_FAILED orders without a successful CLEAR -> retry the
    charge (CLEAR) and the deposit release (REFUND)."""
    cleared = ledger.where((F.col("transaction_type") == "CLEAR")
                           & (F.col("status") == "SUCCESS")).select("order_id")
    failed = orders.where(F.col("status") == "PAYMENT_FAILED").select(
        F.col("id").alias("order_id"), "user_id", "total_amount", "deposit")
    todo = failed.join(cleared, "order_id", "left_anti")
    ops = F.array(F.struct(F.lit("CLEAR").alias("retry_op"), F.col("total_amount").alias("amount")),
                  F.struct(F.lit("REFUND").alias("retry_op"), F.col("deposit").alias("amount")))
    return todo.select("order_id", "user_id", F.inline(ops))


def rotate(orders: DataFrame, ledger: DataFrame, as_of, root: str,
           older_than_hours: int = 24) -> dict[str, DataFrame]:
    """Archive orders older than the hot window (K06) as the batch of
    ``as_of``, then return the hot snapshots without them (K03 anti joins).
    Run again for the same ``as_of`` it writes the same batch again."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(0), F.lit(int(older_than_hours)))
    old = orders.where(F.col("created_at") < cutoff)
    write_archive(archive_records(old, ledger), root,
                  str(as_of).replace(" ", "T").replace(":", ""))
    gone = old.select(F.col("id").alias("_g"))
    return {"orders": orders.join(gone, orders["id"] == gone["_g"], "left_anti"),
            "ledger": ledger.join(gone, ledger["order_id"] == gone["_g"], "left_anti")}


def _expired_folders(spark: SparkSession, root: str, as_of, years: int):
    """File system and (day, folder) of archive days older than the retention,
    by listing folder names; no data file is opened."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/batch=*/yyyy=*/mm=*/dd=*")
    fs = pattern.getFileSystem(conf)
    day = dt.date.fromisoformat(str(as_of)[:10])
    try:
        cutoff = day.replace(year=day.year - years)
    except ValueError:  # 29 February
        cutoff = day.replace(year=day.year - years, day=28)
    out = []
    for status in fs.globStatus(pattern) or []:
        parts = dict(p.split("=", 1) for p in str(status.getPath()).split("/") if "=" in p)
        folder_day = dt.date(int(parts["yyyy"]), int(parts["mm"]), int(parts["dd"]))
        if folder_day < cutoff:
            out.append((folder_day, status.getPath()))
    return fs, sorted(out, key=lambda x: x[0])


def expired_archive_days(spark: SparkSession, root: str, as_of,
                         years: int = ARCHIVE_RETENTION_YEARS) -> DataFrame:
    """T12 purge list: archive days older than the retention (one row per
    day, from folder names)."""
    days = sorted({d for d, _ in _expired_folders(spark, root, as_of, years)[1]})
    return spark.createDataFrame([(d,) for d in days], "day date")


def purge_archive(spark: SparkSession, root: str, as_of,
                  years: int = ARCHIVE_RETENTION_YEARS) -> list[str]:
    """T12 purge: delete the folders of expired days; returns the days."""
    fs, folders = _expired_folders(spark, root, as_of, years)
    for _, path in folders:
        fs.delete(path, True)
    return sorted({d.isoformat() for d, _ in folders})

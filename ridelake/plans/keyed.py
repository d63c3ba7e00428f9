"""Per-key ordered computations without putting a key's rows in one task.

Windows are partitioned by ``(keys, time bucket)``; what crosses a bucket
boundary (row counts before a bucket, the first time of the next bucket) comes
from a per-bucket summary -- one row per key and bucket -- whose own window
is small.  A hot key is therefore spread over as many tasks as it has
buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pricing import epoch_micros

DEFAULT_BUCKET_SECONDS = 86_400


def _bucket(ts: str, bucket_seconds: int) -> Column:
    return F.floor(epoch_micros(F.col(ts)) / F.lit(int(bucket_seconds) * 1_000_000)).cast("long")


def sequence_number(df: DataFrame, keys: list[str], ts: str, order_cols: list[str],
                    out: str = "seq", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``row_number()`` over ``(keys)`` ordered by ``(ts, order_cols)``."""
    b = df.withColumn("_kb", _bucket(ts, bucket_seconds))
    kb = keys + ["_kb"]
    w = Window.partitionBy(*kb).orderBy(F.col(ts), *[F.col(c) for c in order_cols])
    b = b.withColumn("_rn", F.row_number().over(w))
    cnt = b.groupBy(*kb).agg(F.count(F.lit(1)).alias("_n"))
    cnt = cnt.withColumn("_pre", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    return (b.join(cnt.select(*kb, "_pre"), kb, "left")
            .withColumn(out, (F.col("_pre") + F.col("_rn")).cast("long"))
            .drop("_kb", "_rn", "_pre"))


def next_time(df: DataFrame, keys: list[str], ts: str, out: str,
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``lead(ts)`` over ``(keys)`` ordered by ``ts`` (null for the last row)."""
    b = df.withColumn("_kb", _bucket(ts, bucket_seconds))
    kb = keys + ["_kb"]
    w = Window.partitionBy(*kb).orderBy(F.col(ts))
    b = b.withColumn("_nx", F.lead(F.col(ts)).over(w))
    first = b.groupBy(*kb).agg(F.min(ts).alias("_bmin"))
    wk = Window.partitionBy(*keys).orderBy("_kb") if keys else Window.orderBy("_kb")
    first = first.withColumn("_nb", F.lead("_bmin").over(wk))
    return (b.join(first.select(*kb, "_nb"), kb, "left")
            .withColumn(out, F.coalesce(F.col("_nx"), F.col("_nb")))
            .drop("_kb", "_nx", "_nb"))


def changed_rows(df: DataFrame, keys: list[str], ts: str, values: list[str],
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """The rows whose ``values`` differ from those of the row before them
    (per ``keys``, in ``ts`` order; one row per key and instant)."""
    b = df.withColumn("_kb", _bucket(ts, bucket_seconds)).withColumn("_v", F.struct(*values))
    kb = keys + ["_kb"]
    w = Window.partitionBy(*kb).orderBy(F.col(ts))
    b = b.withColumn("_prev", F.lag("_v").over(w)).withColumn("_rn", F.row_number().over(w))
    last = b.groupBy(*kb).agg(F.max_by("_v", ts).alias("_last"))
    wk = Window.partitionBy(*keys).orderBy("_kb") if keys else Window.orderBy("_kb")
    last = last.withColumn("_before", F.lag("_last").over(wk))
    before = F.when(F.col("_rn") == 1, F.col("_before")).otherwise(F.col("_prev"))
    return (b.join(last.select(*kb, "_before"), kb, "left")
            .where(~F.col("_v").eqNullSafe(before)).drop("_kb", "_v", "_prev", "_rn", "_before"))

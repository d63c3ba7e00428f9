"""Exact grouped quantiles without gathering a group into one task.

``percentile`` keeps every distinct value of a group in one aggregation
buffer, which does not survive a hot group.  Here the values are sorted
globally by ``(group, value)`` (range partitioning spreads even one huge group
over many tasks), each row gets its global rank from
``monotonically_increasing_id`` (consecutive inside a sorted partition) plus
the row counts of earlier partitions, and only the few rows at the target
ranks are read back and interpolated linearly:
``q = v[floor(h)] + (h - floor(h)) * (v[ceil(h)] - v[floor(h)])`` with
``h = (n - 1) * p`` (the same definition as SQL ``quantile_cont``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.broadcast import broadcast_if_small
from ..plans.materialize import materialize
from ..session import ensure_checkpoint_dir

_LOCAL_BITS = (1 << 33) - 1


def quantile_names(probs: list[float]) -> list[str]:
    """``q99`` for 0.99, ``q99_9`` for 0.999."""
    return ["q" + f"{p * 100:.10g}".replace(".", "_") for p in probs]


def exact_quantiles(df: DataFrame, group_cols: list[str], value: str, probs: list[float],
                    names: list[str] | None = None) -> DataFrame:
    names = names or quantile_names(probs)
    ensure_checkpoint_dir(df.sparkSession)
    d = df.select(*group_cols, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull())
    s = materialize(d.orderBy(*group_cols, "_v")
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()), "quantile-sorted")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per sorted partition: bounded by the partition count
    ranked = s.join(F.broadcast(offsets.select("_pid", "_off")), "_pid").withColumn(
        "_g", F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_BITS)))
    grp = ranked.groupBy(*group_cols).agg(F.min("_g").alias("_first"),
                                          F.count(F.lit(1)).alias("_cnt"))
    pr = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p"))
                   for n, p in zip(names, probs)])
    t = grp.select(*group_cols, "_first", "_cnt", F.explode(pr).alias("_q"))
    pos = (F.col("_cnt") - 1).cast("double") * F.col("_q.p")
    t = t.select(*group_cols, F.col("_q.name").alias("_name"),
                 (F.col("_first") + F.floor(pos)).cast("long").alias("_lo"),
                 (F.col("_first") + F.ceil(pos)).cast("long").alias("_hi"),
                 (pos - F.floor(pos)).alias("_frac"))
    need = broadcast_if_small(t.select(F.col("_lo").alias("_g"))
                              .unionByName(t.select(F.col("_hi").alias("_g"))).distinct())
    vals = ranked.join(need, "_g", "left_semi").select("_g", "_v")
    lo = vals.select(F.col("_g").alias("_lo"), F.col("_v").alias("_vlo"))
    hi = vals.select(F.col("_g").alias("_hi"), F.col("_v").alias("_vhi"))
    q = t.join(lo, "_lo").join(hi, "_hi").withColumn(
        "_val", F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo")))
    return q.groupBy(*group_cols).pivot("_name", names).agg(F.first("_val"))

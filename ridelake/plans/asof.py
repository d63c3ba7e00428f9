"""As-of joins (J05, J06, T13) as bucketed interval equi-joins.

Each version row carries a validity interval ``[valid_from, valid_to)``.  The
interval is exploded over the coarse time buckets it touches and joined to the
facts on ``(keys, bucket)``; the exact range test then keeps the one version
whose interval contains the fact time.  No window is partitioned by the key
(a hot key is split by AQE's skew join), no pairs beyond the fact's own
bucket are formed, and validity intervals come from the versions alone
(successor per key found by bucketed windows, ``plans.keyed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pricing import epoch_micros
from .keyed import changed_rows, next_time

DEFAULT_BUCKET_SECONDS = 3600


def validity_intervals(versions: DataFrame, keys: list[str], valid_from: str,
                       max_age_seconds: int | None = None, collapse: bool = False) -> DataFrame:
    """``valid_to`` = next version's ``valid_from`` for the same key, capped at
    ``valid_from + max_age`` when a staleness bound applies (null = open).
    Of several versions of a key at one instant the one with the greatest
    values counts.  ``collapse`` joins consecutive versions with equal values
    into one (not with a staleness bound, where each renews the age).
    The successor is found per (key, day) with a per-day summary for the day
    boundary (``plans.keyed.next_time``), not by one window per key."""
    values = [c for c in versions.columns if c not in (*keys, valid_from)]
    v = (versions.groupBy(*keys, valid_from).agg(F.max(F.struct(*values)).alias("_v"))
         .select(*keys, valid_from, "_v.*"))
    if collapse and max_age_seconds is None:
        v = changed_rows(v, keys, valid_from, values)
    v = next_time(v, keys, valid_from, "valid_to")
    if max_age_seconds is not None:
        cap = F.col(valid_from) + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.lit(int(max_age_seconds)).cast("decimal(18,6)"))
        v = v.withColumn("valid_to", F.when(F.col("valid_to").isNull() | (cap < F.col("valid_to")),
                                            cap).otherwise(F.col("valid_to")))
    return v


def asof_join(facts: DataFrame, versions: DataFrame, keys: list[str], fact_ts: str,
              valid_from: str = "valid_from", valid_to: str = "valid_to",
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Left join every fact to the version valid at ``fact_ts`` (null if none).

    Open-ended versions (``valid_to`` null) are closed at the last fact time
    so the bucket explosion stays bounded by the facts' time span."""
    b_us = int(bucket_seconds) * 1_000_000
    # one aggregated scalar: the latest fact time closes open-ended versions
    last = facts.agg(F.max(fact_ts)).first()[0]
    if last is None:
        last_col = F.lit(None).cast("timestamp_ntz")
    else:
        last_col = F.lit(last).cast("timestamp_ntz")
    end = F.coalesce(F.col(valid_to), last_col + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(1).cast("decimal(18,6)")))
    lo = F.floor(epoch_micros(F.col(valid_from)) / F.lit(b_us)).cast("long")
    hi = F.floor((epoch_micros(end) - F.lit(1)) / F.lit(b_us)).cast("long")
    v = (versions.withColumn("_end", end)
         .where(F.col("_end") > F.col(valid_from))
         .withColumn("_b", F.explode(F.sequence(lo, F.greatest(lo, hi)))))
    f = facts.withColumn("_b", F.floor(epoch_micros(F.col(fact_ts)) / F.lit(b_us)).cast("long"))
    cond: Column = F.col("_vb") == F.col("_b")
    vv = v.withColumnRenamed("_b", "_vb")
    for k in keys:
        vv = vv.withColumnRenamed(k, f"_v_{k}")
        cond = cond & (F.col(f"_v_{k}") == F.col(k))
    cond = cond & (F.col(valid_from) <= F.col(fact_ts)) & (F.col(fact_ts) < F.col("_end"))
    return f.join(vv, cond, "left").drop("_b", "_vb", "_end", *[f"_v_{k}" for k in keys])

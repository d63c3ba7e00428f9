"""Interval join (J09): points with the intervals that contain them.

Intervals of a key may overlap and differ in length by any factor, so no one
bucket width fits: narrow buckets repeat long intervals, wide ones pair every
point with everything near it.  Each interval has a width of its own instead,
the power of two at least as long as it is, and so lies in at most two buckets
of that width; each point lies in one bucket of every width that occurs (at
most 64).  Points and intervals meet on (keys, width, bucket), an equi-join
whose keys spread one busy key over its time; the exact test follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pricing import epoch_micros


def _bucket(us: Column, level: Column) -> Column:
    """Number of the bucket of width ``2 ** level`` microseconds."""
    return F.floor(us / F.pow(F.lit(2.0), level.cast("double"))).cast("long")


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str,
                  start: str, end: str) -> DataFrame:
    """Every pair of a point and an interval ``[start, end)`` of equal ``keys``
    that holds ``at``: the point's columns, then the interval's other than the
    keys.  Null keys or times, and intervals that end before they start, match
    nothing."""
    clash = (set(points.columns) & set(intervals.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    lo, hi = epoch_micros(F.col(start)), epoch_micros(F.col(end))
    spans = (intervals.where(F.col(start) < F.col(end)).withColumn("_lo", lo).withColumn("_hi", hi)
             .withColumn("_level", F.ceil(F.log2((F.col("_hi") - F.col("_lo")).cast("double"))).cast("int")))
    # bounded: a width per power of two
    levels = sorted(r["_level"] for r in spans.select("_level").distinct().collect())
    first, last = _bucket(F.col("_lo"), F.col("_level")), _bucket(F.col("_hi") - 1, F.col("_level"))
    spans = spans.withColumn("_bucket", F.explode(F.sequence(first, F.greatest(first, last))))
    placed = (points.where(F.col(at).isNotNull()).withColumn("_at", epoch_micros(F.col(at)))
              .withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
              .withColumn("_bucket", _bucket(F.col("_at"), F.col("_level"))))
    met = placed.join(spans, [*keys, "_level", "_bucket"]).where(
        (F.col("_lo") <= F.col("_at")) & (F.col("_at") < F.col("_hi")))
    return met.select(*points.columns, *[c for c in intervals.columns if c not in keys])


def latest_interval(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str,
                    point_id: list[str], tiebreak: list[str]) -> DataFrame:
    """Left form: every point with the number ``n_live`` of intervals that hold
    it and the columns (prefixed ``latest_``) of the one that started last;
    equal starts are decided by ``tiebreak``, the greatest first.  ``point_id``
    identifies a point."""
    values = [c for c in intervals.columns if c not in keys]
    met = interval_join(points.select(*dict.fromkeys([*point_id, *keys, at])), intervals, keys, at, start, end)
    best = met.groupBy(*point_id).agg(
        F.count(F.lit(1)).alias("n_live"),
        F.max_by(F.struct(*values), F.struct(start, *tiebreak)).alias("_latest"))
    same = [F.col(f"_p.{c}").eqNullSafe(F.col(f"_b.{c}")) for c in point_id]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return points.alias("_p").join(best.alias("_b"), cond, "left").select(
        *[F.col(f"_p.{c}") for c in points.columns], F.coalesce("_b.n_live", F.lit(0)).alias("n_live"),
        *[F.col(f"_b._latest.{c}").alias(f"latest_{c}") for c in values])

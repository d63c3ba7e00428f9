"""Mergeable quantile sketches (A11 at scale).

One KLL sketch per group and minute is kept as a column; sketches merge to any
window without reading the log again and without a global sort.  With size
``k`` the rank of an answer is off by at most ``rank_error(k)`` of the values
(99 % confidence); groups of up to ``k`` values are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_SIZE = 400


def rank_error(k: int = SKETCH_SIZE) -> float:
    """Bound of the single-sided normalised rank error of a KLL sketch."""
    return 2.296 / k ** 0.9021


def minute_sketches(records: DataFrame, group_cols: list[str], value: str, ts: str = "ts",
                    k: int = SKETCH_SIZE) -> DataFrame:
    """``group_cols``, ``minute``, ``sketch`` and ``n`` (null values left out)."""
    minute = F.date_trunc("minute", ts).cast("timestamp_ntz").alias("minute")
    v = F.col(value).cast("double")
    return (records.where(v.isNotNull()).groupBy(*group_cols, minute)
            .agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n")))


def window_quantiles(sketches: DataFrame, group_cols: list[str], window: str, probs: list[float],
                     names: list[str], k: int = SKETCH_SIZE) -> DataFrame:
    """Quantiles per group and value of column ``window`` from stored
    sketches (``window`` is derived from ``minute`` by the caller; filter on
    ``minute`` for a range)."""
    merged = sketches.groupBy(*group_cols, window).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("_s"), F.sum("n").alias("n"))
    return merged.select(*group_cols, window, "n", *[
        F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(name) for p, name in zip(probs, names)])

"""Ride billing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_INCOMPLETE_RIDE_SECONDS = 5  # fixed value: rides shorter than this are free


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def ride_seconds(start, finish) -> Column:
    """Whole seconds between start and finish, truncated, floored at 0."""
    us = F.timestamp_diff("MICROSECOND", _c(start), _c(finish))
    return F.greatest(F.lit(0), F.floor(us / F.lit(1_000_000))).cast("int")


def billable_minutes(seconds) -> Column:
    """ceil(seconds / 60) in integer arithmetic."""
    s = _c(seconds).cast("long")
    return F.floor((s + 59) / 60).cast("long")


def ride_total(seconds, price_per_minute, price_unlock,
               threshold=DEFAULT_INCOMPLETE_RIDE_SECONDS) -> Column:
    """0 below the incomplete-ride threshold, else unlock + minutes * ppm
    (null prices count as 0)."""
    ppm = F.coalesce(_c(price_per_minute), F.lit(0)).cast("long")
    unlock = F.coalesce(_c(price_unlock), F.lit(0)).cast("long")
    total = unlock + billable_minutes(seconds) * ppm
    return F.when(_c(seconds) < _c(threshold), F.lit(0)).otherwise(total).cast("int")


def final_status(charge_ok) -> Column:
    """FINISHED when the charge succeeded, else PAYMENT_FAILED."""
    return F.when(_c(charge_ok), F.lit("FINISHED")).otherwise(F.lit("PAYMENT_FAILED"))


def unhold_ok(charge_ok, unhold_result) -> Column:
    """The deposit is released only after a successful charge."""
    return _c(charge_ok) & F.coalesce(_c(unhold_result), F.lit(False))


def running_cost(start, as_of, price_per_minute, price_unlock,
                 threshold=DEFAULT_INCOMPLETE_RIDE_SECONDS) -> Column:
    """Cost of an active ride if it were finished at ``as_of``."""
    return ride_total(ride_seconds(start, as_of), price_per_minute, price_unlock, threshold)

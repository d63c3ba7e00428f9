"""Offer pricing as pure Column expressions.

All arithmetic stays in JVM expressions (whole-stage codegen); the price per
minute is computed in IEEE double in the order ``(ppm * surge) * discount`` and
rounded half away from zero (``round``; never ``rint``/``bround``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFER_TTL_SECONDS = 300  # fixed value: offers expire five minutes after creation


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def safe_factor(v, default) -> Column:
    """A non-positive factor falls back to its default."""
    v = _c(v)
    return F.when(v <= 0, _c(default)).otherwise(v)


def low_charge_applies(charge, threshold) -> Column:
    """Discount iff ``charge >= 0 and threshold > 0 and charge < threshold``."""
    charge, threshold = _c(charge), _c(threshold)
    return (charge >= 0) & (threshold > 0) & (charge < threshold)


def round_half_away_clamped(x) -> Column:
    """Round half away from zero, then clamp at zero."""
    return F.greatest(F.round(_c(x), 0).cast("int"), F.lit(0))


def price_per_minute(zone_ppm, surge, discount, threshold, charge) -> Column:
    """E02+E03+E04: surge, optional low-charge discount, rounding."""
    base = _c(zone_ppm).cast("double") * safe_factor(_c(surge).cast("double"), 1.0)
    disc = base * safe_factor(_c(discount).cast("double"), 1.0)
    return round_half_away_clamped(F.when(low_charge_applies(charge, threshold), disc)
                                   .otherwise(base))


def price_unlock(zone_unlock, has_subscription) -> Column:
    """Free unlock with a subscription, clamp at zero."""
    return F.greatest(F.when(_c(has_subscription), F.lit(0)).otherwise(_c(zone_unlock)),
                      F.lit(0)).cast("int")


def deposit(zone_deposit, trusted) -> Column:
    """No deposit for trusted users, clamp at zero."""
    return F.greatest(F.when(_c(trusted), F.lit(0)).otherwise(_c(zone_deposit)),
                      F.lit(0)).cast("int")


def price_columns(zone_ppm, zone_unlock, zone_deposit, surge, discount, threshold,
                  charge, has_subscription, trusted) -> dict[str, Column]:
    """The whole pricing row as three Columns."""
    return {
        "price_per_minute": price_per_minute(zone_ppm, surge, discount, threshold, charge),
        "price_unlock": price_unlock(zone_unlock, has_subscription),
        "deposit": deposit(zone_deposit, trusted),
    }


def offer_expiry(created_at, ttl_seconds: int = OFFER_TTL_SECONDS) -> Column:
    """expiry = creation + TTL (NTZ interval arithmetic, zone-free)."""
    return _c(created_at) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                               F.lit(ttl_seconds).cast("decimal(18,6)"))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of session zone."""
    return F.timestamp_diff("MICROSECOND",
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts))


def offer_id(user_id, scooter_id, created_at) -> Column:
    """Deterministic offer id = sha256 of ``user:scooter:created_micros``."""
    return F.sha2(F.concat_ws(":", _c(user_id), _c(scooter_id),
                              epoch_micros(created_at).cast("string")), 256)


def hold_txn_id(order_id) -> Column:
    """Ledger id of the deposit hold."""
    return F.concat(F.lit("txn-"), _c(order_id))


def clear_txn_id(order_id) -> Column:
    return F.concat(F.lit("txn-clear-"), _c(order_id))


def refund_txn_id(order_id) -> Column:
    return F.concat(F.lit("txn-refund-"), _c(order_id))

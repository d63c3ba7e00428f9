"""Time-versioned dimensions.

* ``config_snapshots`` (T13): the effective config after each poll -- a failed
  poll keeps the last good value; defaults apply until the first success.
* ``configs_as_of`` (J05): each request gets the config in force at its time.
* ``zones_as_of`` (J06): each request gets the latest successful tariff fetch
  of its zone if it is younger than the cache TTL (10 min), else the zone is
  unavailable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.asof import asof_join, validity_intervals
from ..sources.tables import DEFAULT_CONFIG

CONFIG_FIELDS = list(DEFAULT_CONFIG)
# Config versions have no key to join on; at one poll every 5 seconds a bucket
# holds at most 60 of them.
CONFIG_BUCKET_SECONDS = 300


def config_snapshots(polls: DataFrame, ts: str = "polled_at", ok: str = "success") -> DataFrame:
    """Config versions from a poll log (successful polls only; a failure
    changes nothing, so the previous version stays valid; nor does a poll that
    returns the values already in force, so there is a version per change)."""
    good = polls.where(F.col(ok)).select(F.col(ts).alias("valid_from"), *CONFIG_FIELDS)
    return validity_intervals(good, [], "valid_from", collapse=True)


def configs_as_of(requests: DataFrame, versions: DataFrame, ts: str = "ts") -> DataFrame:
    """Attach the config valid at each request (defaults before the first
    successful poll, and per missing key)."""
    j = asof_join(requests, versions.select("valid_from", "valid_to", *[
        F.col(c).alias(f"_cfg_{c}") for c in CONFIG_FIELDS]), [], ts, bucket_seconds=CONFIG_BUCKET_SECONDS)
    for c in CONFIG_FIELDS:
        j = j.withColumn(c, F.coalesce(F.col(f"_cfg_{c}"), F.lit(DEFAULT_CONFIG[c])))
    return j.drop("valid_from", "valid_to", *[f"_cfg_{c}" for c in CONFIG_FIELDS])


def zones_as_of(requests: DataFrame, fetches: DataFrame, ttl_seconds: int = 600,
                ts: str = "ts", zone_col: str = "zone_id") -> DataFrame:
    """Tariff of the request's zone from the latest successful fetch at or
    before the request, valid for ``ttl_seconds``; ``zone_available`` is false
    when no fetch is fresh enough."""
    good = fetches.where(F.col("success")).select(
        F.col("zone_id").alias(zone_col), F.col("fetched_at").alias("valid_from"),
        "price_per_minute", "price_unlock", "default_deposit")
    v = validity_intervals(good, [zone_col], "valid_from", max_age_seconds=ttl_seconds)
    j = asof_join(requests, v, [zone_col], ts)
    return (j.withColumn("zone_available", F.col("valid_from").isNotNull())
            .withColumnRenamed("valid_from", "zone_fetched_at").drop("valid_to"))

"""Offer request enrichment and pricing.

``price_offer_requests`` is the set-at-a-time form of the offer endpoint: every
request is validated, joined to its scooter, the scooter's tariff zone, the
user profile and the config, priced, and turned into an offer row or a
classified reject.  Reuse of live offers (T01) is layered on top in
``ridelake.operators.offers``.

Join strategy: zones are a bounded dimension and go out as a size-checked
broadcast; scooters and users grow with the fleet and the customer base, so
they are broadcast only when the bounded probe proves them small, and
otherwise shuffle-joined on their key (AQE splits a hot scooter or user).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pricing
from ..functions.status import OFFER_STATUS, status_code
from ..plans.broadcast import broadcast_all_if_small
from ..sources.tables import resolve_configs


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def offer_request_reject(user_id: Column, scooter_id: Column,
                         corrupt: Column | None = None) -> Column:
    """first failing check in order body -> user_id -> scooter_id, else null."""
    checks = [] if corrupt is None else [(corrupt, "INVALID_BODY")]
    checks += [(_blank(user_id), "USER_ID_REQUIRED"), (_blank(scooter_id), "SCOOTER_ID_REQUIRED")]
    out = F.when(checks[0][0], F.lit(checks[0][1]))
    for cond, code in checks[1:]:
        out = out.when(cond, F.lit(code))
    return out


def enrich_offer_requests(requests: DataFrame, scooters: DataFrame, zones: DataFrame,
                          users: DataFrame) -> DataFrame:
    """Attach scooter, zone and profile columns (all left joins).

    Output adds ``scooter_found``, ``zone_id``, ``charge``, ``zone_found``,
    ``zone_price_per_minute``, ``zone_price_unlock``, ``zone_default_deposit``,
    ``has_subscription`` and ``trusted`` (profile miss -> false, false).
    """
    s, z, u = broadcast_all_if_small([
        scooters.select(F.col("id").alias("_s_id"), F.col("zone_id").alias("_s_zone"),
                        F.col("charge").alias("_s_charge")),
        zones.select(F.col("id").alias("_z_id"),
                     F.col("price_per_minute").alias("zone_price_per_minute"),
                     F.col("price_unlock").alias("zone_price_unlock"),
                     F.col("default_deposit").alias("zone_default_deposit")),
        users.select(F.col("id").alias("_u_id"), F.col("has_subscription").alias("_u_sub"),
                     F.col("trusted").alias("_u_trusted"))])
    j = (requests.join(s, requests["scooter_id"] == s["_s_id"], "left")
         .join(z, F.col("_s_zone") == z["_z_id"], "left")
         .join(u, requests["user_id"] == u["_u_id"], "left"))
    return (j.withColumn("scooter_found", F.col("_s_id").isNotNull())
            .withColumn("zone_found", F.col("_z_id").isNotNull())
            .withColumn("has_subscription", F.coalesce(F.col("_u_sub"), F.lit(False)))
            .withColumn("trusted", F.coalesce(F.col("_u_trusted"), F.lit(False)))
            .withColumnRenamed("_s_zone", "zone_id")
            .withColumnRenamed("_s_charge", "charge")
            .drop("_s_id", "_z_id", "_u_id", "_u_sub", "_u_trusted"))


def price_offer_requests(requests: DataFrame, scooters: DataFrame, zones: DataFrame,
                         users: DataFrame, configs: DataFrame | None = None,
                         ts_col: str = "ts", with_lookup_zone: bool = False,
                         lookup_failed_col: str | None = None) -> DataFrame:
    """Price every offer request (flagship): one output row per request.

    ``lookup_failed_col`` marks requests whose scooter lookup itself failed
    (J01): they are ``SCOOTERS_UNAVAILABLE``, whatever the scooter table holds.

    Columns: request_id, user_id, scooter_id, requested_at, outcome,
    http_status, zone_id, price_per_minute, price_unlock, deposit, offer_id,
    expires_at.  Prices and ids are null unless ``outcome = 'CREATED'``.
    ``with_lookup_zone`` adds ``lookup_zone_id``: the zone looked up for the
    request (the scooter's zone, whether or not the zone was found).
    """
    spark = requests.sparkSession
    cfg = resolve_configs(configs, spark)
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in requests.columns \
        else None
    e = enrich_offer_requests(requests, scooters, zones, users)
    reject = offer_request_reject(F.col("user_id"), F.col("scooter_id"), corrupt)
    failed = F.coalesce(F.col(lookup_failed_col), F.lit(False)) if lookup_failed_col else F.lit(False)
    outcome = (F.when(reject.isNotNull(), reject)
               .when(failed, F.lit("SCOOTERS_UNAVAILABLE"))
               .when(~F.col("scooter_found"), F.lit("SCOOTER_NOT_FOUND"))
               .when(~F.col("zone_found"), F.lit("ZONE_UNAVAILABLE"))
               .otherwise(F.lit("CREATED")))
    prices = pricing.price_columns(
        F.col("zone_price_per_minute"), F.col("zone_price_unlock"),
        F.col("zone_default_deposit"), F.lit(cfg["surge"]).cast("double"),
        F.lit(cfg["low_charge_discount"]).cast("double"),
        F.lit(cfg["low_charge_threshold_percent"]).cast("int"), F.col("charge"),
        F.col("has_subscription"), F.col("trusted"))
    ok = F.col("outcome") == "CREATED"
    ts = F.col(ts_col)
    return (e.withColumn("outcome", outcome)
            .select(
                "request_id", "user_id", "scooter_id", ts.alias("requested_at"), "outcome",
                status_code(F.col("outcome"), OFFER_STATUS).alias("http_status"),
                F.when(ok, F.col("zone_id")).alias("zone_id"),
                *[F.when(ok, c).alias(n) for n, c in prices.items()],
                F.when(ok, pricing.offer_id(F.col("user_id"), F.col("scooter_id"), ts))
                .alias("offer_id"),
                F.when(ok, pricing.offer_expiry(ts)).alias("expires_at"),
                *([F.col("zone_id").alias("lookup_zone_id")] if with_lookup_zone else []),
            ))


def price_offer_requests_versioned(requests: DataFrame, scooters: DataFrame,
                                   zone_fetches: DataFrame, users: DataFrame,
                                   config_polls: DataFrame, zone_ttl_seconds: int = 600,
                                   ts_col: str = "ts") -> DataFrame:
    """Offer pricing against versioned dimensions (J05, J06, T13): the tariff
    of the request's zone as of the request (latest successful fetch, at most
    ``zone_ttl_seconds`` old, else ``ZONE_UNAVAILABLE``) and the config as of
    the request (last good poll, defaults before the first)."""
    from .versions import config_snapshots, configs_as_of, zones_as_of

    s, u = broadcast_all_if_small([
        scooters.select(F.col("id").alias("_s_id"), F.col("zone_id").alias("zone_id"),
                        F.col("charge").alias("charge")),
        users.select(F.col("id").alias("_u_id"), F.col("has_subscription").alias("_u_sub"),
                     F.col("trusted").alias("_u_trusted"))])
    j = (requests.join(s, requests["scooter_id"] == s["_s_id"], "left")
         .join(u, requests["user_id"] == u["_u_id"], "left"))
    j = zones_as_of(j, zone_fetches, zone_ttl_seconds, ts=ts_col)
    j = configs_as_of(j, config_snapshots(config_polls), ts=ts_col)
    reject = offer_request_reject(F.col("user_id"), F.col("scooter_id"))
    outcome = (F.when(reject.isNotNull(), reject)
               .when(F.col("_s_id").isNull(), F.lit("SCOOTER_NOT_FOUND"))
               .when(~F.col("zone_available"), F.lit("ZONE_UNAVAILABLE"))
               .otherwise(F.lit("CREATED")))
    prices = pricing.price_columns(
        F.col("price_per_minute"), F.col("price_unlock"), F.col("default_deposit"),
        F.col("surge"), F.col("low_charge_discount"), F.col("low_charge_threshold_percent"),
        F.col("charge"), F.coalesce(F.col("_u_sub"), F.lit(False)),
        F.coalesce(F.col("_u_trusted"), F.lit(False)))
    ok = F.col("outcome") == "CREATED"
    ts = F.col(ts_col)
    return (j.withColumn("outcome", outcome)
            .select("request_id", "user_id", "scooter_id", ts.alias("requested_at"), "outcome",
                    status_code(F.col("outcome"), OFFER_STATUS).alias("http_status"),
                    F.when(ok, F.col("zone_id")).alias("zone_id"),
                    *[F.when(ok, c).alias(n) for n, c in prices.items()],
                    F.when(ok, F.col("zone_fetched_at")).alias("tariff_fetched_at"),
                    F.when(ok, F.col("surge")).alias("surge")))

"""Offer creation over a request log (T01, T02, T10 batch form, T14, J09, K05).

``create_offers`` answers every offer request the way the offer endpoint
would, replayed set-at-a-time:

* invalid requests (F01) are rejected first;
* a request falling inside the TTL of the latest offer created for the same
  ``(user_id, scooter_id)`` returns that offer (``REUSED``) -- decided before
  any lookup, so it holds even when a lookup would now fail;
* otherwise the request is priced (J01-J04, E07); a successful pricing
  creates a new offer and starts a new TTL (anchor), a failed one leaves no
  anchor.

Anchors come from :func:`ridelake.operators.ttl.ttl_chain` over the
successfully priced requests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pricing
from ..functions.status import OFFER_STATUS, status_code
from .enrich import price_offer_requests
from .ttl import ttl_chain

VALIDATION_REJECTS = ["INVALID_BODY", "USER_ID_REQUIRED", "SCOOTER_ID_REQUIRED"]
ZONE_CACHE_TTL_SECONDS = 600  # fixed value: tariff zones are cached for ten minutes


def create_offers(requests: DataFrame, scooters: DataFrame, zones: DataFrame,
                  users: DataFrame, configs: DataFrame | None = None,
                  ttl_seconds: int = pricing.OFFER_TTL_SECONDS,
                  keys: tuple[str, ...] = ("user_id", "scooter_id"),
                  bucket_seconds: int = 3600,
                  prior_anchors: DataFrame | None = None,
                  claims: DataFrame | None = None,
                  min_remaining_seconds: int = 0) -> DataFrame:
    """One row per request: outcome (CREATED, REUSED or a reject), the offer
    returned (id, prices, expiry) and ``is_new_offer``.  A request that the log
    repeats (same id, key and time) is one request.

    ``prior_anchors`` (same columns as the output) carries the live offers of
    earlier batches (streaming): they take part in the chain as forced
    anchors and are not returned.

    T14 (strict reuse): with ``min_remaining_seconds`` an offer is reused
    only while more than that much of its TTL remains, and with ``claims``
    (``offer_id``, ``claimed_at``) a claimed offer is no longer reused from
    its first claim on -- the next request creates a new offer."""
    once = requests.dropDuplicates(["request_id", "user_id", "scooter_id", "ts"])
    priced = price_offer_requests(once, scooters, zones, users, configs,
                                  with_lookup_zone=True).withColumn("_prior", F.lit(False))
    if prior_anchors is not None:
        prior = prior_anchors.select(
            F.lit("").alias("request_id"), "user_id", "scooter_id", "requested_at",
            F.lit("CREATED").alias("outcome"), F.lit(201).alias("http_status"), "zone_id",
            "price_per_minute", "price_unlock", "deposit", "offer_id", "expires_at",
            F.col("zone_id").alias("lookup_zone_id"), F.lit(True).alias("_prior"))
        priced = priced.unionByName(prior)
    valid = ~F.col("outcome").isin(*VALIDATION_REJECTS)
    end = None
    if claims is not None or min_remaining_seconds:
        reuse_secs = max(int(ttl_seconds) - int(min_remaining_seconds), 0)
        end = F.col("requested_at") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.lit(reuse_secs).cast("decimal(18,6)"))
        if claims is not None:
            first = claims.groupBy(F.col("offer_id").alias("_c_offer")).agg(
                F.min("claimed_at").alias("_c_at"))
            priced = priced.join(first, priced["offer_id"] == first["_c_offer"], "left") \
                .drop("_c_offer")
            end = F.least(end, F.coalesce(F.col("_c_at"), end))
    offer = ["zone_id", "price_per_minute", "price_unlock", "deposit", "offer_id", "expires_at"]
    j = ttl_chain(priced, list(keys), "requested_at", ["request_id"], ttl_seconds,
                  eligible=valid & (F.col("outcome") == "CREATED"),
                  force=F.col("_prior"), bucket_seconds=bucket_seconds, end=end,
                  carry=offer).where(~F.col("_prior"))
    reused = valid & F.col("covered") & ~F.col("is_anchor")
    outcome = (F.when(reused, F.lit("REUSED"))
               .when(F.col("is_anchor"), F.lit("CREATED")).otherwise(F.col("outcome")))

    def pick(c):
        return F.when(reused, F.col(f"anchor_{c}")).otherwise(F.col(c)).alias(c)

    return j.select(
        "request_id", "user_id", "scooter_id", "requested_at",
        outcome.alias("outcome"),
        status_code(outcome, OFFER_STATUS).alias("http_status"),
        pick("zone_id"), pick("price_per_minute"), pick("price_unlock"), pick("deposit"),
        pick("offer_id"), pick("expires_at"),
        F.col("is_anchor").alias("is_new_offer"),
        F.when(~reused, F.col("lookup_zone_id")).alias("lookup_zone_id"),
    )


def offer_saves(created: DataFrame, now_col: str = "requested_at") -> DataFrame:
    """Every new offer with ``ttl_seconds = expires_at - now`` floored at
    one second and ``save_result``: SAVED, or EXPIRED for an offer that had
    already run out at save time (null ``ttl_seconds``)."""
    new = created.where(F.col("is_new_offer"))
    late = F.col(now_col) > F.col("expires_at")
    ttl = F.greatest(F.timestamp_diff("SECOND", F.col(now_col), F.col("expires_at")), F.lit(1))
    return new.select(
        F.col("offer_id").alias("id"), "user_id", "scooter_id", "zone_id",
        "price_per_minute", "price_unlock", "deposit",
        F.col(now_col).alias("created_at"), "expires_at",
        F.when(~late, ttl).cast("long").alias("ttl_seconds"),
        F.when(late, F.lit("EXPIRED")).otherwise(F.lit("SAVED")).alias("save_result"))


def saved_offers(created: DataFrame, now_col: str = "requested_at") -> DataFrame:
    """The offers to store."""
    return offer_saves(created, now_col).where("save_result = 'SAVED'").drop("save_result")


def zone_cache_replay(created: DataFrame, ttl_seconds: int = ZONE_CACHE_TTL_SECONDS,
                      bucket_seconds: int = 3600) -> DataFrame:
    """Replay the per-zone tariff cache over the requests that looked a zone up.

    A lookup is a ``HIT`` when the latest successful fetch for the zone is
    younger than the TTL, else a ``FETCH`` (which restarts the TTL) or, when the
    zone cannot be fetched, ``UNAVAILABLE``.
    """
    lookups = created.where(F.col("is_new_offer") | (F.col("outcome") == "ZONE_UNAVAILABLE"))
    ch = ttl_chain(lookups, ["lookup_zone_id"], "requested_at", ["request_id"], ttl_seconds,
                   eligible=F.col("outcome") == "CREATED", bucket_seconds=bucket_seconds)
    result = (F.when(F.col("covered") & ~F.col("is_anchor"), F.lit("HIT"))
              .when(F.col("is_anchor"), F.lit("FETCH")).otherwise(F.lit("UNAVAILABLE")))
    return ch.select("request_id", F.col("lookup_zone_id").alias("zone_id"), "requested_at",
                     result.alias("cache_result"))

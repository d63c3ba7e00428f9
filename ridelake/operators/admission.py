"""Order admission over a request log (F02, J08, F04, F05, F09, W01, W02, T03,
T04, P03, P04, K01).

Every order request gets the outcome the order endpoint would have given when
the requests are served in ``(requested_at, tiebreak)`` order:

1. ``INVALID_BODY`` (S07, when the requests carry ``_corrupt_record``), then
   ``ORDER_ID_REQUIRED`` / ``OFFER_ID_REQUIRED`` / ``USER_ID_REQUIRED`` (F02);
2. ``DUPLICATE`` when the same ``order_id`` was created strictly earlier (W02);
3. ``OFFER_NOT_FOUND`` (F09), ``OFFER_EXPIRED`` (strict ``ts > expires_at``,
   F04), ``INVALID_USER`` (F05);
4. ``OFFER_ALREADY_USED`` unless the request is the offer's first valid claim
   (W01) -- the claim precedes the hold, so a failed hold burns the offer;
5. ``PAYMENT_HOLD_FAILED``, ``PERSIST_FAILED`` (hold taken, order not stored:
   an UNHOLD compensation is emitted, T04), else ``CREATED``.

Skew: the first claim per offer is one aggregation (map-side partial
aggregation) joined back to the requests, so a hot offer never forces its rows
through one window task; the duplicate test reads the same first-claim row.

When a client reuses one ``order_id`` across several offers, rules 2 and 4
depend on each other.  The claims of the offers such order ids touch are found
in a few rounds of joins and aggregations; what then still waits is decided
component by component (``_linked_claims``), a bounded number of rows in a task.

State from before the batch -- orders already stored, offers already used --
comes in as tables, so a day's log can be admitted after the days before it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pricing
from ..functions.status import ORDER_CREATE_STATUS, status_code
from ..plans.components import components
from ..plans.materialize import has_rows, materialize

# Rounds before components are looked for, and the most requests of a
# component that one task decides.
FIRST_ROUNDS = 4
FOLD_REQUESTS = 100_000


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def _key(ts: str, tiebreak: list[str]) -> Column:
    return F.struct(F.col(ts).alias("_k0"), *[F.col(c) for c in tiebreak])


def _offer_columns(offers: DataFrame) -> DataFrame:
    return offers.select(
        F.col("id").alias("_o_id"), F.col("user_id").alias("_o_owner"),
        F.col("scooter_id").alias("_o_scooter"), F.col("expires_at").alias("_o_expires"),
        F.col("price_per_minute").alias("_o_ppm"), F.col("price_unlock").alias("_o_unlock"),
        F.col("deposit").alias("_o_deposit"))


def _reject(requests: DataFrame) -> Column:
    """the first check of the body that a request fails."""
    corrupt = (F.col("_corrupt_record").isNotNull() if "_corrupt_record" in requests.columns
               else F.lit(False))
    return (F.when(corrupt, "INVALID_BODY")
            .when(_blank(F.col("order_id")), "ORDER_ID_REQUIRED")
            .when(_blank(F.col("offer_id")), "OFFER_ID_REQUIRED")
            .when(_blank(F.col("user_id")), "USER_ID_REQUIRED"))


def _offer_check(ts: str) -> Column:
    """what is wrong with the offer a request names."""
    return (F.when(F.col("_o_id").isNull(), "OFFER_NOT_FOUND")
            .when(F.col(ts) > F.col("_o_expires"), "OFFER_EXPIRED")
            .when(F.col("user_id") != F.col("_o_owner"), "INVALID_USER"))


def admit_orders(requests: DataFrame, offers: DataFrame, tiebreak: list[str],
                 ts: str = "requested_at", hold_col: str = "hold_success",
                 persist_col: str | None = None, existing_orders: DataFrame | None = None,
                 used_offers: DataFrame | None = None) -> DataFrame:
    """One row per request: the input columns plus ``outcome``, ``http_status``
    and the offer columns used to build an order (``scooter_id``, prices).

    ``existing_orders`` (``id``): orders stored before the batch, whose ids are
    duplicates; ``used_offers`` (``offer_id``): offers claimed before it."""
    o = _offer_columns(offers)
    # Joins and claims go by ``_offer``, never null: the planner then adds no
    # null filter to one use of the requests only, and both read one shuffle.
    j = requests.withColumn("_offer", F.coalesce(F.col("offer_id"), F.lit("")))
    named = F.col("offer_id").isNotNull()
    if existing_orders is not None:
        known = existing_orders.select(F.col("id").alias("_p_id")).distinct().withColumn("_was", F.lit(True))
        j = j.join(known, j["order_id"] == known["_p_id"], "left").drop("_p_id").fillna(False, ["_was"])
    else:
        j = j.withColumn("_was", F.lit(False))
    j = j.join(o, (j["_offer"] == o["_o_id"]) & named, "left")
    if used_offers is not None:
        used = used_offers.select(F.col("offer_id").alias("_p_offer")).distinct().withColumn("_used", F.lit(True))
        j = j.join(used, (j["_offer"] == used["_p_offer"]) & named, "left").drop("_p_offer").fillna(False, ["_used"])
    else:
        j = j.withColumn("_used", F.lit(False))
    j = j.withColumn("_k", _key(ts, tiebreak))
    persist_ok = F.coalesce(F.col(persist_col), F.lit(True)) if persist_col else F.lit(True)
    hold_ok = F.coalesce(F.col(hold_col), F.lit(False))
    j = (j.withColumn("_reject", _reject(requests)).withColumn("_ocheck", _offer_check(ts))
         .withColumn("_valid", F.col("_reject").isNull() & F.col("_ocheck").isNull()
                     & ~F.col("_was") & ~F.col("_used"))
         .withColumn("_hold_ok", hold_ok).withColumn("_persist_ok", persist_ok))

    # First valid claim per offer, by one aggregation (map-side partial).
    # W02 follows from the same row: outside conflict components an order id
    # names a single offer, so the only row that can have created it is that
    # offer's first claim -- created when its hold (and persist) succeeded.
    # The condition stands inside the aggregate, not before it: both uses of
    # ``j`` then read the same shuffle of the requests, written once.
    claim = F.struct(F.col("_k").alias("k"), F.col("order_id").alias("order_id"),
                     (F.col("_hold_ok") & F.col("_persist_ok")).alias("ok"))
    first = (j.groupBy(F.col("_offer").alias("_f_offer"))
             .agg(F.min(F.when(F.col("_valid"), claim)).alias("_f")))
    j = j.join(first, j["_offer"] == first["_f_offer"], "left").drop("_f_offer")
    j = j.withColumn("_first", F.col("_valid") & (F.col("_k") == F.col("_f.k")))
    dup = (F.col("_f.ok") & (F.col("_f.order_id") == F.col("order_id"))
           & (F.col("_f.k") < F.col("_k")))

    j = j.withColumn("_dup", F.col("_was") | F.coalesce(dup, F.lit(False)))
    linked = _linked_offers(requests)
    if linked is not None:
        j = _linked_claims(j, linked, _key(ts, tiebreak))
    outcome = (F.when(F.col("_reject").isNotNull(), F.col("_reject"))
               .when(F.col("_dup"), "DUPLICATE")
               .when(F.col("_ocheck").isNotNull(), F.col("_ocheck"))
               .when(F.col("_used") | ~F.col("_first"), "OFFER_ALREADY_USED")
               .when(~F.col("_hold_ok"), "PAYMENT_HOLD_FAILED")
               .when(~F.col("_persist_ok"), "PERSIST_FAILED")
               .otherwise("CREATED"))
    return _finish(j.withColumn("outcome", outcome))


CLAIMED = ("CREATED", "PAYMENT_HOLD_FAILED", "PERSIST_FAILED")


def offer_claims(requests: DataFrame, offers: DataFrame, tiebreak: list[str], columns: list[str],
                 ts: str = "requested_at", hold_col: str = "hold_success") -> DataFrame:
    """``columns`` of the rows of ``admit_orders`` that claim an offer, written
    once: only the first request of a user for an offer is shuffled (with those
    of an equal key), by offer and user, and meets the offers of that owner.
    That loses no claim: an offer that a user's first request finds expired has
    expired for the later ones.

    Where an offer has no owner any user may claim it, and where two owners share
    an offer id they compete: then all requests meet the offers by offer alone,
    and of those allowed the first per offer stays.

    Where no order id claims two offers and no offer has two first claims, those
    claims hold whatever the other requests name: by induction in time no
    creation before one has its order id.  Else ``admit_orders`` decides, unless
    no order id names several offers."""
    def written(first: DataFrame, by: list[str]) -> DataFrame:
        outcome = F.when(~F.coalesce(F.col(hold_col), F.lit(False)), "PAYMENT_HOLD_FAILED").otherwise("CREATED")
        first = first.withColumn("_mates", F.count(F.lit(1)).over(Window.partitionBy(*by))).withColumn("outcome", outcome)
        return materialize(first.withColumnsRenamed(_RENAMED).select(*columns, "_mates"), "claims")

    def turn(by: list[str]) -> Column:
        return F.rank().over(Window.partitionBy(*by).orderBy(ts, *tiebreak))

    o = _offer_columns(offers)
    sound, allowed = requests.where(_reject(requests).isNull()), _offer_check(ts).isNull()
    made = None
    if not has_rows(offers.where(F.col("user_id").isNull())):
        by = ["offer_id", "user_id"]
        first = sound.withColumn("_turn", turn(by)).where(F.col("_turn") == 1)
        met = first.join(o, (first["offer_id"] == o["_o_id"]) & (first["user_id"] == o["_o_owner"]))
        made = written(met.where(allowed), by)
        # an offer with more rows than any one user's claim of it has two claimants
        rivals = made.groupBy("offer_id").agg(F.count(F.lit(1)).alias("_n"), F.max("_mates").alias("_m")).where("_n > _m")
        if has_rows(rivals):
            made = None
    if made is None:
        met = sound.join(o, sound["offer_id"] == o["_o_id"]).where(allowed)
        made = written(met.withColumn("_turn", turn(["offer_id"])).where(F.col("_turn") == 1), ["offer_id"])
    odd = (made.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"), F.max("_mates").alias("_m"))
           .where("_n > 1 or _m > 1"))
    if has_rows(odd) and _linked_offers(requests) is not None:
        every = admit_orders(requests, offers, tiebreak, ts, hold_col)
        return materialize(every.where(F.col("outcome").isin(*CLAIMED)).select(*columns), "claims")
    return made.drop("_mates")


def claimed_offers(admitted: DataFrame) -> DataFrame:
    """``offer_id`` of every offer a batch claimed (also where the hold or the
    storing failed afterwards): the next batch's ``used_offers``."""
    return admitted.where(F.col("outcome").isin(*CLAIMED)) \
        .select("offer_id").distinct()


_RENAMED = {"_o_scooter": "offer_scooter_id", "_o_ppm": "offer_price_per_minute",
            "_o_unlock": "offer_price_unlock", "_o_deposit": "offer_deposit"}


def _finish(out: DataFrame) -> DataFrame:
    return (out.withColumn("http_status", status_code(F.col("outcome"), ORDER_CREATE_STATUS))
            .withColumnsRenamed(_RENAMED)
            .drop("_o_id", "_o_owner", "_o_expires", "_k", "_reject", "_ocheck", "_valid",
                  "_hold_ok", "_persist_ok", "_f", "_first", "_dup", "_was", "_used", "_offer"))


def _linked_offers(requests: DataFrame) -> DataFrame | None:
    """Offers named together with an order id that names several offers (null
    if there is none)."""
    named = requests.where(~_blank(F.col("order_id")) & ~_blank(F.col("offer_id")))
    # two hash aggregations (distinct pairs, then pairs per order id): exact,
    # and no string min/max, which would force a sort-based aggregation
    pairs = materialize(named.select("order_id", "offer_id").distinct(), "admission-pairs")
    multi = (pairs.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1).select("order_id"))
    if not has_rows(multi):
        return None
    # written: the requests meet them twice, for the claims and for the outcomes
    return materialize(pairs.join(multi, "order_id", "left_semi").select("offer_id").distinct(), "admission-linked-offers")


def _linked_claims(j: DataFrame, linked: DataFrame, key: Column) -> DataFrame:
    """``_first`` and ``_dup`` of the requests of linked offers; ``key`` is
    their ``_k``, made anew from the request where it is read, neither written
    nor shuffled with it.

    A valid request that is the earliest undecided one of its offer and of its
    order id is a claim, whatever comes later: nothing undecided can make its
    order or take its offer before it.  A round decides all such requests at
    once, then leaves out the requests of claimed offers and those whose order
    was created.  What waits for one another after ``FIRST_ROUNDS`` falls into
    components of order ids and offers: those of up to ``FOLD_REQUESTS`` requests
    are decided in one pass each, in order; rounds go on for larger ones only,
    and end, as the earliest request of all is always decided."""
    ids = linked.select(F.col("offer_id").alias("_l_offer"), F.lit(True).alias("_linked"))
    marked = materialize(
        j.join(ids, j["_offer"] == ids["_l_offer"], "left")
        .drop("_l_offer", "_offer", "_k", "_f", "_o_id", "_o_owner", "_o_expires")
        .fillna(False, ["_linked"]).withColumn("_rid", F.monotonically_increasing_id()), "admission-linked")
    left = materialize(marked.where(F.col("_linked") & F.col("_valid")).select(
        "_rid", "offer_id", "order_id", F.struct(key.alias("_k"), "_rid").alias("_at"),
        (F.col("_hold_ok") & F.col("_persist_ok")).alias("_ok")), "admission-undecided")
    rounds = []
    while left.limit(1).count() > 0:
        if len(rounds) == FIRST_ROUNDS:
            folded, left = _folded(left)
            rounds.append(folded)
            if left.limit(1).count() == 0:
                break
        # the earliest of each offer, aggregated with its columns, meets that of its order id
        by_offer = (left.groupBy("offer_id").agg(F.min(F.struct("_at", "order_id", "_ok")).alias("_head"))
                    .select("offer_id", "_head.*"))
        by_order = left.groupBy("order_id").agg(F.min("_at").alias("_by_order"))
        claims = materialize(
            by_offer.join(by_order, "order_id").where(F.col("_at") == F.col("_by_order"))
            .select(F.col("_at._rid").alias("_rid"), "offer_id", "order_id", "_at", "_ok"), "admission-claims")
        rounds.append(claims)
        left = materialize(left.join(claims.select("offer_id"), "offer_id", "left_anti")
                           .join(claims.where("_ok").select("order_id"), "order_id", "left_anti")
                           .select(*left.columns), "admission-undecided")
    claims = left.limit(0)
    for part in rounds:
        claims = claims.unionByName(part)
    created = claims.where("_ok").select("order_id", F.col("_at").alias("_made"))
    # only requests that could claim look for their claim, by their number
    able = F.col("_linked") & F.col("_valid")
    marked = (marked.where(able).join(claims.select("_rid", F.lit(True).alias("_claim")), "_rid", "left")
              .unionByName(marked.where(~able).withColumn("_claim", F.lit(None).cast("boolean")))
              .join(created, "order_id", "left"))
    dup = F.col("_was") | F.coalesce(F.col("_made") < F.struct(key.alias("_k"), F.col("_rid")), F.lit(False))
    return (marked.withColumn("_first", F.when(F.col("_linked"), F.col("_claim").isNotNull())
                              .otherwise(F.col("_first")))
            .withColumn("_dup", F.when(F.col("_linked"), dup).otherwise(F.col("_dup")))
            .drop("_linked", "_rid", "_claim", "_made"))


def _folded(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The claims among undecided requests in components of at most
    ``FOLD_REQUESTS``, and the requests of larger ones.  Nodes are hashes of
    offers and order ids; two that share one only make a component larger."""
    node = F.xxhash64(F.lit("offer"), "offer_id")
    named = left.withColumn("_node", node)
    found = components(named.select("_node", F.xxhash64(F.lit("order"), "order_id").alias("_order")), "_node", "_order")
    placed = materialize(named.join(found.withColumnRenamed("node", "_node"), "_node").drop("_node"),
                         "admission-components")
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
    small = sizes.where(F.col("_n") <= FOLD_REQUESTS).select("component")
    # bounded: a window and a group hold one small component
    turn = F.row_number().over(Window.partitionBy("component").orderBy("_at")).alias("turn")
    rows = placed.join(small, "component", "left_semi").select("component", turn, "_rid", "offer_id", "order_id", "_ok")

    def decide(group: pd.DataFrame) -> pd.DataFrame:
        taken, made, won = set(), set(), []
        for rid, offer, order, ok in group.sort_values("turn")[["_rid", "offer_id", "order_id", "_ok"]].itertuples(index=False):
            if offer not in taken and order not in made:
                won.append(rid)
                taken.add(offer)
                if ok:
                    made.add(order)
        return pd.DataFrame({"_rid": pd.Series(won, dtype="int64")})

    claims = rows.groupBy("component").applyInPandas(decide, "_rid long")
    large = placed.join(small, "component", "left_anti").select(*left.columns)
    return (materialize(left.join(claims, "_rid", "left_semi").select(*left.columns), "admission-claims"),
            materialize(large, "admission-undecided"))


def admission_summary(admitted: DataFrame) -> DataFrame:
    """Outcome counts."""
    return admitted.groupBy("outcome").agg(F.count(F.lit(1)).alias("requests"))


def created_orders(admitted: DataFrame, ts: str = "requested_at") -> DataFrame:
    """Order rows for the admitted requests (status ACTIVE, prices
    copied from the offer, total = unlock price)."""
    c = admitted.where(F.col("outcome") == "CREATED")
    unlock = F.col("offer_price_unlock")
    return c.select(
        F.col("order_id").alias("id"), "user_id", F.col("offer_scooter_id").alias("scooter_id"),
        "offer_id",
        F.coalesce(F.col("offer_price_per_minute"), F.lit(0)).alias("price_per_minute"),
        F.coalesce(unlock, F.lit(0)).alias("price_unlock"),
        F.coalesce(F.col("offer_deposit"), F.lit(0)).alias("deposit"),
        F.coalesce(unlock, F.lit(0)).alias("total_amount"),
        F.lit("ACTIVE").alias("status"),
        F.col(ts).alias("start_time"),
        F.lit(None).cast("timestamp_ntz").alias("finish_time"),
        F.lit(None).cast("int").alias("duration_seconds"),
        F.col(ts).alias("created_at"), F.col(ts).alias("updated_at"))


def hold_ledger_rows(admitted: DataFrame, ts: str = "requested_at",
                     external_id_col: str | None = None) -> DataFrame:
    """The HOLD ledger row written with each created order."""
    c = admitted.where(F.col("outcome") == "CREATED")
    ext = F.col(external_id_col) if external_id_col else F.lit(None).cast("string")
    return c.select(
        pricing.hold_txn_id(F.col("order_id")).alias("id"), "order_id", "user_id",
        F.lit("HOLD").alias("transaction_type"),
        F.coalesce(F.col("offer_deposit"), F.lit(0)).alias("amount"),
        F.lit("SUCCESS").alias("status"), ext.alias("external_transaction_id"),
        F.lit(None).cast("string").alias("error_message"), F.col(ts).alias("created_at"))


def hold_compensations(admitted: DataFrame) -> DataFrame:
    """Hold taken but order not persisted -> UNHOLD call to emit."""
    return admitted.where(F.col("outcome") == "PERSIST_FAILED").select(
        "order_id", "user_id", F.lit("unhold").alias("op"))

"""Golden cases for pricing (E01-E07) and billing."""

from pyspark.sql import functions as F

from ridelake.functions import billing, pricing
from ridelake.operators.enrich import price_offer_requests


def _price(spark, rows):
    df = spark.createDataFrame(rows, "ppm int, unlock int, dep int, surge double, disc double, "
                                     "thr int, charge int, sub boolean, trusted boolean")
    cols = pricing.price_columns(F.col("ppm"), F.col("unlock"), F.col("dep"), F.col("surge"),
                                 F.col("disc"), F.col("thr"), F.col("charge"), F.col("sub"),
                                 F.col("trusted"))
    return [tuple(r) for r in df.select(*[c.alias(n) for n, c in cols.items()]).collect()]


def test_full_privileges_low_charge(spark):
    assert _price(spark, [(10, 20, 200, 1.2, 0.5, 30, 10, True, True)]) == [(6, 0, 0)]


def test_surge_only_and_low_charge(spark):
    rows = [(7, 50, 200, 1.2, 0.7, 28, 85, False, False),     # 8.4 -> 8
            (10, 75, 300, 1.2, 0.7, 28, 25, False, False),    # 10*1.2*0.7 = 8.4 -> 8
            (10, 0, 0, 1.2, 0.7, 28, 80, False, False),       # default surge -> 12
            (10, 0, 0, 1.5, 0.7, 28, 80, False, False)]       # configured surge -> 15
    assert [r[0] for r in _price(spark, rows)] == [8, 8, 12, 15]


def test_threshold_is_strict_and_safe_factors(spark):
    rows = [(10, 0, 0, 1.0, 0.5, 28, 28, False, False),   # charge == thr: no discount
            (10, 0, 0, 1.0, 0.5, 28, 27, False, False),   # charge < thr: discount
            (10, 0, 0, -1.0, 0.0, 28, 27, False, False),  # non-positive factors -> 1
            (10, 0, 0, 1.0, 0.5, 0, 5, False, False)]     # threshold 0: never
    assert [r[0] for r in _price(spark, rows)] == [10, 5, 10, 10]


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(8.5,), (9.5,), (-8.5,)], "x double")
    got = [r[0] for r in df.select(pricing.round_half_away_clamped(F.col("x"))).collect()]
    assert got == [9, 10, 0]


def test_privilege_matrix(spark):
    # users 1-4 on scooter-1 (zone-1: 7/50/200, charge 85)
    rows = [(7, 50, 200, 1.2, 0.7, 28, 85, s, t) for s, t in
            [(True, True), (False, True), (False, False), (True, False)]]
    got = _price(spark, rows)
    assert [r[1] for r in got] == [0, 50, 50, 0]
    assert [r[2] for r in got] == [0, 0, 200, 200]


def test_ride_totals(spark):
    df = spark.createDataFrame(
        [(120, 10, 20, 5), (10, 10, 20, 5), (3, 10, 20, 5), (73, 8, 0, 5), (5, 10, 20, 5),
         (4, 10, 20, 5), (60, 1, 0, 5), (61, 1, 0, 5), (100, None, None, 5)],
        "s int, ppm int, unlock int, thr int")
    got = [r[0] for r in df.select(billing.ride_total(F.col("s"), F.col("ppm"), F.col("unlock"),
                                                      F.col("thr"))).collect()]
    assert got == [40, 30, 0, 16, 30, 0, 1, 2, 0]


def test_ride_seconds_truncates_and_floors(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' s, "
                   "timestamp_ntz'2024-01-01 00:00:59.999' f1, timestamp_ntz'2023-12-31 23:59:00' f2")
    r = df.select(billing.ride_seconds(F.col("s"), F.col("f1")),
                  billing.ride_seconds(F.col("s"), F.col("f2"))).first()
    assert tuple(r) == (59, 0)


def test_final_status_and_unhold(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True)], "c boolean, u boolean")
    got = df.select(billing.final_status(F.col("c")), billing.unhold_ok(F.col("c"), F.col("u"))) \
        .collect()
    assert [tuple(r) for r in got] == [("FINISHED", True), ("FINISHED", False),
                                       ("PAYMENT_FAILED", False)]


def test_offer_pricing_outcomes(spark):
    req = spark.createDataFrame(
        [("r1", "user-1", "scooter-1"), ("r2", "user-2", "scooter-4"), ("r3", "", "scooter-1"),
         ("r4", "user-3", ""), ("r5", "user-9", "scooter-9"), ("r6", "user-3", "scooter-5")],
        "request_id string, user_id string, scooter_id string") \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    scooters = spark.createDataFrame([("scooter-1", "zone-1", 85), ("scooter-4", "zone-2", 25),
                                      ("scooter-5", "zone-9", 50)], "id string, zone_id string, charge int")
    zones = spark.createDataFrame([("zone-1", 7, 50, 200), ("zone-2", 10, 75, 300)],
                                  "id string, price_per_minute int, price_unlock int, default_deposit int")
    users = spark.createDataFrame([("user-1", True, True), ("user-2", False, True)],
                                  "id string, has_subscription boolean, trusted boolean")
    out = {r.request_id: r for r in price_offer_requests(req, scooters, zones, users).collect()}
    assert (out["r1"].outcome, out["r1"].price_per_minute, out["r1"].price_unlock,
            out["r1"].deposit) == ("CREATED", 8, 0, 0)
    assert (out["r2"].price_per_minute, out["r2"].price_unlock, out["r2"].deposit) == (8, 75, 0)
    assert out["r3"].outcome == "USER_ID_REQUIRED" and out["r3"].http_status == 400
    assert out["r4"].outcome == "SCOOTER_ID_REQUIRED"
    assert out["r5"].outcome == "SCOOTER_NOT_FOUND" and out["r5"].http_status == 400
    assert out["r6"].outcome == "ZONE_UNAVAILABLE" and out["r6"].http_status == 503
    assert out["r1"].offer_id is not None and out["r5"].offer_id is None


def test_strict_reuse_claims_and_min_remaining(spark):
    import datetime as dt
    from ridelake.operators.offers import create_offers
    t0 = dt.datetime(2024, 1, 1)
    req = spark.createDataFrame(
        [("r1", "user-1", "scooter-1", t0), ("r2", "user-1", "scooter-1", t0 + dt.timedelta(seconds=60)),
         ("r3", "user-1", "scooter-1", t0 + dt.timedelta(seconds=120)),
         ("r4", "user-1", "scooter-1", t0 + dt.timedelta(seconds=200)),
         ("r5", "user-1", "scooter-1", t0 + dt.timedelta(seconds=260))],
        "request_id string, user_id string, scooter_id string, ts timestamp_ntz")
    scooters = spark.createDataFrame([("scooter-1", "zone-1", 85)], "id string, zone_id string, charge int")
    zones = spark.createDataFrame([("zone-1", 7, 50, 200)],
                                  "id string, price_per_minute int, price_unlock int, default_deposit int")
    users = spark.createDataFrame([("user-1", False, False)],
                                  "id string, has_subscription boolean, trusted boolean")
    plain = {r.request_id: r.outcome for r in create_offers(req, scooters, zones, users).collect()}
    assert plain == {"r1": "CREATED", "r2": "REUSED", "r3": "REUSED", "r4": "REUSED", "r5": "REUSED"}
    # r1's offer claimed at +90 s: r3 starts a new offer; 60 s minimum remaining
    first = create_offers(req, scooters, zones, users).where("request_id = 'r1'").first().offer_id
    claims = spark.createDataFrame([(first, t0 + dt.timedelta(seconds=90))],
                                   "offer_id string, claimed_at timestamp_ntz")
    strict = {r.request_id: r.outcome for r in create_offers(
        req, scooters, zones, users, claims=claims, min_remaining_seconds=60).collect()}
    assert strict == {"r1": "CREATED", "r2": "REUSED", "r3": "CREATED", "r4": "REUSED",
                      "r5": "REUSED"}

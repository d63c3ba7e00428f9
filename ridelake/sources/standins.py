"""Stand-in inputs derived from the driver's test tables.

The test data holds no rental tables, so each function below maps a driver
table onto one input schema of the engine (users, zones, scooters, offer and
order requests, rides, request logs).  These functions only shape rows; all
the engine's work happens in ``ridelake.operators`` on whatever rows arrive.

A few stand-ins leave deliberate gaps (a missing profile, zone or scooter, an
absent offer, an empty id, a wrong user) so the reject branches of the engine
see real rows.  The gaps follow the stand-in definitions fixed in FIXTURES.md.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.materialize import shuffles_dropped
from ..session import scratch_dir
from .tables import read_table


def _sid(prefix: str, c) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % 11 != 10).select(
        _sid("user-", F.col("c_custkey")).alias("id"),
        (F.col("c_mktsegment") == "MACHINERY").alias("has_subscription"),
        (F.col("c_acctbal") >= 4000).alias("trusted"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.where(F.col("n_nationkey") != 24).select(
        _sid("zone-", F.col("n_nationkey")).alias("id"),
        (5 + F.col("n_nationkey") % 6).cast("int").alias("price_per_minute"),
        (40 + 5 * (F.col("n_nationkey") % 8)).cast("int").alias("price_unlock"),
        (150 + 50 * F.col("n_regionkey")).cast("int").alias("default_deposit"),
    )


def scooters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.where(F.col("p_partkey") % 100 != 99).select(
        _sid("scooter-", F.col("p_partkey")).alias("id"),
        _sid("zone-", F.col("p_partkey") % 25).alias("zone_id"),
        (F.col("p_size") * 2).cast("int").alias("charge"),
    )


def offer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offer_requests_from_events(read_table(spark, sf_dir, "events", spread=True))


def offer_requests_from_events(e: DataFrame) -> DataFrame:
    """Offer requests from an events frame (batch or streaming)."""
    return e.where(F.col("event_type").isin("view", "click")).select(
        _sid("req-", F.col("event_id")).alias("request_id"),
        _sid("user-", F.col("user_id")).alias("user_id"),
        F.concat(F.lit("scooter-"), _k(F.col("props"))).alias("scooter_id"),
        F.col("ts"),
    )


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", spread=True)
    k = F.col("o_orderkey")
    return o.where(k % 50 != 49).select(
        _sid("offer-", k).alias("id"),
        _sid("user-", F.col("o_custkey")).alias("user_id"),
        _sid("scooter-", k % 200).alias("scooter_id"),
        _sid("zone-", (k % 200) % 25).alias("zone_id"),
        (5 + k % 6).cast("int").alias("price_per_minute"),
        (40 + k % 8).cast("int").alias("price_unlock"),
        (100 + k % 5).cast("int").alias("deposit"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + F.expr("INTERVAL 300 SECONDS")).alias("expires_at"),
    )


ORDER_REQUEST_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                          "l_extendedprice", "l_shipdate"]


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_requests_from_lineitem(read_table(spark, sf_dir, "lineitem", spread=True),
                                        read_table(spark, sf_dir, "orders", spread=True))


def order_requests_from_lineitem(li: DataFrame, orders: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Order requests from line items (batch or streaming) and static orders;
    ``carry`` names columns of the line items to keep."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.when(F.col("l_partkey") % 97 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("order-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                            (F.col("l_linenumber") % 2).cast("string"))).alias("order_id"),
        _sid("offer-", F.col("l_orderkey")).alias("offer_id"),
        _sid("user-", F.when(F.col("l_suppkey") % 10 == 0, F.col("o_custkey") + 1)
             .otherwise(F.col("o_custkey"))).alias("user_id"),
        (F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (70 * F.col("l_linenumber")).cast("decimal(18,6)")))
        .alias("requested_at"),
        (F.col("l_returnflag") != "R").alias("hold_success"),
        *ORDER_REQUEST_TIEBREAK, *(carry or []),
    )


def order_requests_with_persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order requests plus a storage outcome per request (``persisted`` false
    for line items with line status 'O')."""
    li = read_table(spark, sf_dir, "lineitem", spread=True)
    # every line item meets the storage outcomes of all of its key (none, where
    # a part of the key is null): one shuffle of the line items by that key
    whole = F.lit(True)
    for c in ORDER_REQUEST_TIEBREAK:
        whole = whole & F.col(c).isNotNull()
    outcome = F.struct((F.col("l_linestatus") != "O").alias("persisted"))
    stored = F.collect_list(F.when(whole, outcome)).over(Window.partitionBy(*ORDER_REQUEST_TIEBREAK))
    met = li.withColumn("_stored", stored).select(*li.columns, F.explode_outer("_stored").alias("_s"))
    met = met.select(*li.columns, F.col("_s.persisted").alias("persisted"))
    req = order_requests_from_lineitem(met, read_table(spark, sf_dir, "orders", spread=True), ["persisted"])
    return req.select(*ORDER_REQUEST_TIEBREAK, *[c for c in req.columns if c not in ORDER_REQUEST_TIEBREAK])


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders fact (ride rows) with a recorded duration for closed rides."""
    o = read_table(spark, sf_dir, "orders", spread=True)
    k = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "O", "ACTIVE")
              .when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("PAYMENT_FAILED"))
    return o.select(
        _sid("order-", k).alias("id"),
        _sid("user-", F.col("o_custkey")).alias("user_id"),
        _sid("scooter-", k % 200).alias("scooter_id"),
        _sid("offer-", k).alias("offer_id"),
        (5 + k % 6).cast("int").alias("price_per_minute"),
        (40 + k % 8).cast("int").alias("price_unlock"),
        (100 + k % 5).cast("int").alias("deposit"),
        status.alias("status"),
        F.col("o_orderdate").alias("start_time"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None))
        .otherwise((k * 37) % 3600).cast("int").alias("duration_seconds"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), ((k * 37) % 3600).cast("decimal(18,6)")))
        .alias("finish_time"),
        (40 + k % 8).cast("int").alias("total_amount"),
        F.col("o_orderdate").alias("updated_at"),
    )


def _order_suffix_id(k: Column, line: Column) -> Column:
    return F.concat(F.lit("order-"), k.cast("string"), F.lit("-"), (line % 2).cast("string"))


def finish_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finish calls: one per line item at its ship time, naming the order id the
    same line item's order request used."""
    li = read_table(spark, sf_dir, "lineitem", spread=True)
    return li.select(
        _order_suffix_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("order_id"),
        F.col("l_shipdate").alias("requested_at"),
        *ORDER_REQUEST_TIEBREAK,
    )


def payment_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S09 feed: charge and unhold results for both order ids of an order key."""
    # one scan: both results of an order id lie in one task, and aggregate there
    results = F.array(
        F.struct(F.lit("charge").alias("op"), (F.col("o_orderstatus") != "P").alias("success")),
        F.struct(F.lit("unhold").alias("op"), (F.col("o_orderpriority") != "5-LOW").alias("success")))
    o = read_table(spark, sf_dir, "orders", spread=True).select(
        "o_orderkey", results.alias("_r"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_b"))
    return o.select(_order_suffix_id(F.col("o_orderkey"), F.col("_b")).alias("order_id"), F.inline("_r"))


def payment_outcomes_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S09 feed with the payment service's ids (none for every seventh order)."""
    p = payment_outcomes(spark, sf_dir)
    number = F.regexp_extract("order_id", r"^order-(\d+)-", 1).cast("long")
    return p.withColumn("transaction_id", F.when(
        number % 7 != 0, F.concat(F.lit("pay-"), F.col("op"), F.lit("-"), F.col("order_id"))))


def offer_request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bodies of offer requests: cut short, no object, absent or without a
    scooter for some."""
    r = offer_requests(spark, sf_dir)
    n = F.regexp_extract("request_id", r"(\d+)$", 1).cast("long")
    whole = F.concat(F.lit('{"user_id":"'), F.col("user_id"), F.lit('","scooter_id":"'), F.col("scooter_id"),
                     F.lit('","extra":1}'))
    body = (F.when(n % 17 == 0, F.lit(None).cast("string")).when(n % 13 == 0, F.concat(F.lit("["), whole, F.lit("]")))
            .when(n % 11 == 0, F.expr("left(body, length(body) - 2)")).when(n % 7 == 0, F.lit("{}"))
            .when(n % 5 == 0, F.concat(F.lit('{"user_id":"'), F.col("user_id"), F.lit('"}'))).otherwise(F.col("body")))
    return r.withColumn("body", whole).select("request_id", "ts", body.alias("body"))


def request_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request-start records with the URI asked for; some have a query string,
    some an empty one."""
    log = request_log(spark, sf_dir).where(F.col("event_id") % 10 == 0)
    n = F.col("event_id")
    query = (F.when(n % 30 == 0, F.concat(F.lit("?from=/orders/x?&n="), n.cast("string")))
             .when(n % 50 == 0, F.lit("?")).otherwise(F.lit("")))
    return log.select("ts", "event_id", "method", F.concat("path", query).alias("uri"))


def zone_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tariff-zone fetch log: signup/purchase/error events are fetches of zone
    ``k % 25``; an error event is a failed fetch.  Tariffs come from ``zones``."""
    e = read_table(spark, sf_dir, "events", spread=True).where(
        F.col("event_type").isin("signup", "purchase", "error"))
    f = e.select(_sid("zone-", _k(F.col("props")).cast("int") % 25).alias("zone_id"),
                 F.col("ts").alias("fetched_at"),
                 (F.col("event_type") != "error").alias("success"))
    z = zones(spark, sf_dir)
    return f.join(z, f["zone_id"] == z["id"], "left").select(
        "zone_id", "fetched_at", (F.col("success") & F.col("id").isNotNull()).alias("success"),
        "price_per_minute", "price_unlock", "default_deposit")


def config_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config poll log: one poll per purchase event; a poll fails when the
    event value is below 20; surge and threshold vary with ``k``."""
    e = read_table(spark, sf_dir, "events", spread=True).where(F.col("event_type") == "purchase")
    k = _k(F.col("props")).cast("int")
    return e.select(
        F.col("ts").alias("polled_at"), (F.col("value") >= 20).alias("success"),
        (F.lit(1.0) + (k % 5).cast("double") / F.lit(10.0)).alias("surge"),
        F.lit(0.7).alias("low_charge_discount"),
        (20 + k % 15).cast("int").alias("low_charge_threshold_percent"),
        F.lit(5).alias("incomplete_ride_threshold_seconds"))


def order_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order reads: one GET per line item, spaced 7 minutes per line number."""
    li = read_table(spark, sf_dir, "lineitem", spread=True).select("l_orderkey", "l_linenumber", *[
        c for c in ORDER_REQUEST_TIEBREAK if c not in ("l_orderkey", "l_linenumber")])
    o = read_table(spark, sf_dir, "orders", spread=True).select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        _order_suffix_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("order_id"),
        (F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), F.lit(0), (7 * F.col("l_linenumber")).cast("int"), F.lit(0)))
        .alias("ts"),
        *ORDER_REQUEST_TIEBREAK,
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw service log lines (one JSON record per line) from ``events``."""
    return request_log_from_events(read_table(spark, sf_dir, "events", spread=True))


def request_log_from_events(e: DataFrame) -> DataFrame:
    """Service log lines from an events frame (batch or streaming)."""
    k = _k(F.col("props"))
    et = F.col("event_type")
    method = F.when(et == "view", "GET").otherwise("POST")
    path = (F.when(et == "view", F.concat(F.lit("/orders/order-"), k))
            .when(et == "click", F.lit("/offers"))
            .when(et == "purchase", F.concat(F.lit("/orders/order-"), k, F.lit("/finish")))
            .otherwise(F.lit("/orders")))
    status = (F.when(et == "error", 500).when(et.isin("view", "purchase"), 200)
              .otherwise(201))
    event = F.when(F.col("event_id") % 10 == 0, "request_start").otherwise("request_complete")
    rec = F.struct(
        F.lit("info").alias("level"), event.alias("event"), method.alias("method"),
        path.alias("path"), status.alias("status_code"), F.col("value").alias("duration_ms"),
        _sid("req-", F.col("event_id")).alias("request_id"),
        _sid("user-", F.col("user_id")).alias("user_id"),
    )
    line = F.to_json(rec)
    # error records carry a second "level" key, as the service emits them
    line = F.when(status >= 400, F.concat(F.regexp_replace(line, r"\}$", ""),
                                          F.lit(',"level":"error","error_code":'),
                                          status.cast("string"), F.lit("}"))).otherwise(line)
    user = _sid("user-", F.col("user_id"))
    pad = F.when(F.col("event_id") % 3 == 0,
                 F.concat(F.lit(',"note":"'),
                          F.repeat(F.lit("xé漢"), (F.floor(F.col("value") * 10) % 500).cast("int")),
                          F.lit('"'))).when(F.col("event_id") % 7 == 0, F.lit(',"offer_id":17,"order_id":true')
                                            ).otherwise(F.lit(""))
    req_body = (F.when(et == "click", F.concat(F.lit('{"user_id":"'), user, F.lit('","scooter_id":"scooter-'),
                                               k, F.lit('"'), pad, F.lit("}")))
                .when(et == "signup", F.concat(F.lit('{"order_id":"order-'), k, F.lit('","offer_id":"offer-'),
                                               k, F.lit('","user_id":"'), user, F.lit('"}'))))
    resp_body = (F.when(et == "click", F.concat(F.lit('{"id":"offer-'), F.col("event_id").cast("string"),
                                                F.lit('","user_id":"'), user,
                                                F.lit('","expires_at":"2024-01-01T00:05:00Z"}')))
                 .when(et == "signup", F.concat(F.lit('{"id":"order-'), k, F.lit('","offer_id":"offer-'), k,
                                                F.lit('","user_id":"'), user, F.lit('","status":"ACTIVE"}')))
                 .when((et == "view") & (F.col("event_id") % 9 == 0),
                       F.concat(F.lit('{"id":'), k, F.lit(',"status":["FINISHED"],"user_id":"a\\tb"}')))
                 .when(et == "view", F.concat(F.lit('{"id":"order-'), k, F.lit('","status":"FINISHED"}')))
                 .when(et == "purchase", F.concat(F.lit('{"id":"x-'), F.col("event_id").cast("string"),
                                                  F.lit('","order_id":"order-'), k,
                                                  F.lit('","status":"FINISHED"}')))
                 .otherwise(F.concat(F.lit("Internal server error "),
                                     F.repeat(F.lit("ü"), (F.col("event_id") % 900).cast("int")))))
    return e.select(
        F.col("ts"), method.alias("method"), path.alias("path"),
        status.cast("int").alias("status_code"), F.col("value").alias("duration_ms"),
        F.col("event_id"), line.alias("log_line"),
        req_body.alias("request_body"), resp_body.alias("response_body"),
        F.floor(F.col("value") * 1_000_000).cast("long").alias("duration_ns"),
    )


# Rows of one file of an arrival, about.
ARRIVING_FILE_ROWS = 50_000


def arriving_files(df: DataFrame, name: str, arrival: Column, parts: int = 4) -> DataFrame:
    """A file stream over ``df``: its rows in ``parts`` arrivals, by ``arrival``
    (a number from 0; none counts as 0, larger ones as the last), and read one
    arrival per micro-batch.  The rows are
    written once by all tasks, into a folder per arrival; each folder is then
    copied, in order, as equally many files (empty ones where rows lack)."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"arriving-{name}-{uuid.uuid4().hex[:12]}")
    part = F.coalesce(arrival.cast("int"), F.lit(0))
    numbered = df.withColumn("_part", F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1)))
    with shuffles_dropped(spark):
        numbered.write.partitionBy("_part").parquet(f"{path}-parts")
    split = spark.read.schema(numbered.schema).parquet(f"{path}-parts")
    most = max((r["count"] for r in split.groupBy("_part").count().collect()), default=0)
    files = max(1, -(-most // ARRIVING_FILE_ROWS))
    arrived = spark.read.schema(df.schema)
    for k in range(parts):
        with shuffles_dropped(spark):
            split.where(F.col("_part") == k).drop("_part").repartition(files).write.mode("append").parquet(path)
        for _ in range(files * (k + 1) - len(arrived.parquet(path).inputFiles())):
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def in_quarters(df: DataFrame, ts: str) -> Column:
    """Arrival in time order: the quarter of the time span a row lies in."""
    with shuffles_dropped(df.sparkSession):
        lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    if lo is None:
        return F.lit(0)
    cuts = [lo + (hi - lo) * k / 4 for k in (1, 2, 3)]
    return sum(((F.col(ts) >= F.lit(c).cast("timestamp_ntz")).cast("int") for c in cuts), F.lit(0))

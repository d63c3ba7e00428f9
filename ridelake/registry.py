"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's test tables through the stand-in inputs of
``ridelake.sources.standins`` and runs one engine operator over them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import schemas
from .functions import jsonfmt, logfmt, pricing
from .operators import (admission, archive, enrich, finish, logs, lookup, metrics, offers,
                        quality, retention, ttl)
from .plans import intervals, layout, partitions, sketches
from .plans.broadcast import broadcast_if_small
from .plans.materialize import materialize
from .streaming import jobs
from .session import scratch_dir
from .sources import standins as si
from .sources import payloads, tables

Query = Callable[[SparkSession, str], DataFrame]


def offer_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price every offer request: F01, J01-J04, E01-E07, P05, P11."""
    return enrich.price_offer_requests(
        si.offer_requests(spark, sf_dir), si.scooters(spark, sf_dir),
        si.zones(spark, sf_dir), si.users(spark, sf_dir))


def offer_pricing_degraded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer pricing where the scooter lookup of every 13th request failed."""
    n = F.regexp_extract("request_id", r"(\d+)$", 1).cast("long")
    req = si.offer_requests(spark, sf_dir).withColumn("lookup_failed", n % 13 == 0)
    return enrich.price_offer_requests(req, si.scooters(spark, sf_dir), si.zones(spark, sf_dir),
                                       si.users(spark, sf_dir), lookup_failed_col="lookup_failed")


# Rows of one JSON document, about.
_DOCUMENT_ROWS = 1000


def _document(df: DataFrame, name: str) -> str:
    """Folder of ``df`` as JSON documents, each a top-level array of objects;
    their number grows with the counted rows."""
    path = scratch_dir(df.sparkSession, f"document-{name}-{uuid.uuid4().hex[:12]}")
    documents = max(4, -(-df.count() // _DOCUMENT_ROWS))
    (df.groupBy(F.pmod(F.xxhash64(*df.columns), F.lit(documents)).alias("part"))
     .agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")).select("value")
     .write.option("maxRecordsPerFile", 1).text(path))
    return path


def offer_pricing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer pricing on dimension documents and a config document
    (one of its keys missing), written from the tables and read back."""
    dims = {"scooters": schemas.SCOOTERS, "zones": schemas.ZONES, "users": schemas.USERS}
    scooters, zones, users = (
        tables.read_dimension_json(spark, _document(getattr(si, name)(spark, sf_dir), name), schema)
        for name, schema in dims.items())
    path = scratch_dir(spark, f"document-config-{uuid.uuid4().hex[:12]}")
    config = si.zones(spark, sf_dir).agg((F.count(F.lit(1)) / 16).alias("surge"),
                                         (F.max("price_per_minute") * 4).alias("low_charge_threshold_percent"))
    config.coalesce(1).write.json(path)
    return enrich.price_offer_requests(si.offer_requests(spark, sf_dir), scooters, zones, users,
                                       tables.read_configs_json(spark, path))


def orders_snapshot_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders snapshot written and read with its fixed schema."""
    path = scratch_dir(spark, f"orders-{uuid.uuid4().hex[:12]}")
    _world(spark, sf_dir)[3].write.parquet(path)
    return tables.read_orders(spark, path)


def ledger_snapshot_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment ledger written and read with its fixed schema."""
    path = scratch_dir(spark, f"ledger-{uuid.uuid4().hex[:12]}")
    _world(spark, sf_dir)[4].write.parquet(path)
    return tables.read_payment_transactions(spark, path)


def hold_ledger_payment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOLD ledger rows with the payment service's id of each hold."""
    req = si.order_requests(spark, sf_dir).withColumn("hold_id", F.concat(
        F.lit("hold-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")))
    admitted = admission.admit_orders(req, si.offers(spark, sf_dir), si.ORDER_REQUEST_TIEBREAK)
    return admission.hold_ledger_rows(admitted, external_id_col="hold_id")


def offer_creation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer endpoint replay: F01, T01 reuse per (user, scooter) for 5 min, J01-J04, E07."""
    return offers.create_offers(
        si.offer_requests(spark, sf_dir), si.scooters(spark, sf_dir),
        si.zones(spark, sf_dir), si.users(spark, sf_dir))


def ttl_chain_user_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T01 engine on every offer request, keyed by user with a 6 h TTL."""
    r = si.offer_requests(spark, sf_dir)
    out = ttl.ttl_chain(r, ["user_id"], "ts", ["request_id"], 6 * 3600)
    return out.select("request_id", "user_id", "ts", "is_anchor", "anchor_ts", "covered")


def zone_cache_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tariff-zone cache replay (10 min TTL per zone) over offer creation."""
    return offers.zone_cache_replay(offer_creation(spark, sf_dir))


def _admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.admit_orders(si.order_requests(spark, sf_dir), si.offers(spark, sf_dir),
                                  si.ORDER_REQUEST_TIEBREAK)


def order_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every order request (F02, W02, F09, F04, F05, W01, hold)."""
    return _admitted(spark, sf_dir).select(
        "order_id", "offer_id", "user_id", "requested_at", "hold_success",
        *si.ORDER_REQUEST_TIEBREAK, "outcome", "http_status")


def admission_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T03 outcome counts."""
    return admission.admission_summary(_admitted(spark, sf_dir))


def admitted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows written for admitted requests."""
    return admission.created_orders(_admitted(spark, sf_dir))


def hold_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOLD ledger rows written with each admitted order."""
    return admission.hold_ledger_rows(_admitted(spark, sf_dir))


def _finished(spark: SparkSession, sf_dir: str):
    # written once: the finish reads the orders for the first calls and for all
    # calls, with other columns, and the snapshot reads them again
    orders = materialize(admission.created_orders(_admitted(spark, sf_dir)), "orders")
    done = finish.finish_rides(orders, si.finish_requests(spark, sf_dir),
                               si.payment_outcomes(spark, sf_dir), si.ORDER_REQUEST_TIEBREAK)
    return orders, done


def finish_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every finish call on admitted orders."""
    return _finished(spark, sf_dir)[1]


def finish_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLEAR and REFUND rows of billed finishes."""
    return finish.finish_ledger(_finished(spark, sf_dir)[1])


def finish_ledger_payment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLEAR and REFUND rows with the payment service's ids."""
    orders = admission.created_orders(_admitted(spark, sf_dir))
    done = finish.finish_rides(orders, si.finish_requests(spark, sf_dir),
                               si.payment_outcomes_with_ids(spark, sf_dir), si.ORDER_REQUEST_TIEBREAK)
    return finish.finish_ledger(done)


# What the snapshot reads of a finish.
_SNAPSHOT_COLUMNS = ["order_id", "requested_at", "outcome", "duration_seconds", "total_amount"]


def orders_after_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders snapshot after applying finishes (upsert by rewrite)."""
    orders, done = _finished(spark, sf_dir)
    # written: the snapshot's filter would else go down one of the two uses of the
    # finish calls and split their shuffle
    done = materialize(done.select(*_SNAPSHOT_COLUMNS), "finished")
    return finish.apply_finish(orders, done)


def _published_finish(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Folder of the orders published by month, before (version 1) and after
    (version 2) the finishes of the months they touch."""
    _, orders, done, _, _ = _world(spark, sf_dir)
    root = scratch_dir(spark, f"orders-by-month-{uuid.uuid4().hex[:12]}")
    partitions.publish(orders, root, "1", "created_at", partitions.MONTH)
    finish.publish_finish(spark, root, "1", "2", done, partitions.MONTH)
    return root, done


def orders_after_finish_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after finishes, only touched months rewritten."""
    return partitions.read(spark, _published_finish(spark, sf_dir)[0], "2", schemas.ORDERS)


def orders_after_cleanup_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after a cleanup, expired months dropped from the manifest
    and one rewritten."""
    root = _published_finish(spark, sf_dir)[0]
    retention.publish_cleanup(spark, root, "2", "3", RIDES_AS_OF, span=partitions.MONTH)
    return partitions.read(spark, root, "3", schemas.ORDERS)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _world(spark, sf_dir)[4]


def ledger_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order pivot of HOLD, CLEAR and REFUND amounts and statuses."""
    return finish.ledger_rollup(_ledger(spark, sf_dir))


def ride_billing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E08-E10 over the rides fact: rides, billed total and short rides per status."""
    return finish.ride_billing_summary(si.rides(spark, sf_dir))


RIDES_AS_OF = "1998-01-01 00:00:00"


def order_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every GET /orders/{id} of the request log resolved against orders."""
    log = si.request_log(spark, sf_dir).where(F.col("method") == "GET")
    ids = log.select("path", logfmt.path_order_id(F.col("path")).alias("requested_id"))
    return lookup.lookup_orders(ids, si.rides(spark, sf_dir), id_col="requested_id")


def user_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of 1996 numbered per user."""
    return lookup.user_history(si.rides(spark, sf_dir), "1996-01-01 00:00:00",
                               "1997-01-01 00:00:00")


def latest_order_per_offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest admitted order per offer."""
    return lookup.latest_order_per_offer(admission.created_orders(_admitted(spark, sf_dir)))


def expired_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders older than 24 h at the as-of time, oldest first."""
    return lookup.expired_orders(si.rides(spark, sf_dir), RIDES_AS_OF)


def cleanup_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_deleted audit lines of a cleanup run."""
    return retention.audit_lines(lookup.expired_orders(si.rides(spark, sf_dir), RIDES_AS_OF),
                                 RIDES_AS_OF)


def _cleanup(spark: SparkSession, sf_dir: str) -> dict:
    _, _, _, snap, ledger = _world(spark, sf_dir)
    out = retention.cleanup(snap, ledger, RIDES_AS_OF)
    out["full_ledger"] = ledger
    return out


def cleanup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cleanup run over the order world: counts deleted."""
    return _cleanup(spark, sf_dir)["summary"]


def orders_after_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders snapshot without the removed orders (anti join)."""
    return _cleanup(spark, sf_dir)["orders"]


def ledger_after_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger snapshot with the cascade applied."""
    return _cleanup(spark, sf_dir)["ledger"]


def cascade_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows left without an order if the cascade were skipped."""
    c = _cleanup(spark, sf_dir)
    return lookup.orphan_ledger_rows(c["full_ledger"], c["orders"])


def ride_status_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active rides with scooter charge and running cost at an as-of time."""
    return lookup.ride_status_view(si.rides(spark, sf_dir), si.scooters(spark, sf_dir),
                                   "2001-09-01 00:00:00")


def order_shard_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order id -> shard (64 shards by user)."""
    return lookup.order_shard_map(si.rides(spark, sf_dir), 64)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded request_complete records of the raw log (F12 filter, then from_json)."""
    raw = si.request_log(spark, sf_dir).select("ts", "event_id", "log_line")
    return logs.parse_request_complete(raw).withColumn(
        "route", logfmt.route(F.col("method"), F.col("path")))


def log_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines kept vs dropped by the request_complete filter."""
    return logs.drop_counts(si.request_log(spark, sf_dir))


def panel_rps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-minute RPS of the five dashboard panels."""
    return logs.panel_rps(si.request_log(spark, sf_dir))


def panel_trailing_rps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing-minute RPS of the panels at every 15-second step."""
    return logs.panel_trailing_rps(si.request_log(spark, sf_dir))


def cache_hit_rate_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replayed cache's hit rate if it is below the bound."""
    return logs.hit_rate_alert(cache_hit_rate(spark, sf_dir))


def endpoint_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact p50/p95/p99 latency per route."""
    q = logs.latency_quantiles(_records(spark, sf_dir), ["route"])
    return q.select("route", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


def endpoint_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error share per route."""
    return logs.error_rates(_records(spark, sf_dir), ["route"])


def error_rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes closing two adjacent minutes with error rate > 5 %."""
    return logs.error_rate_alerts(_records(spark, sf_dir))


def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 1000 request_complete records."""
    return logs.tail(_records(spark, sf_dir), 1000, tiebreak="event_id").select(
        "ts", "method", "path", "status_code", "duration_ms", "event_id")


def request_complete_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded request_complete records with derived fields."""
    r = _records(spark, sf_dir)
    st = F.col("status_code")
    return r.select("ts", "method", "path", "status_code", "duration_ms", "route",
                    logfmt.log_level(st).alias("level"), logfmt.log_message(st).alias("message"),
                    logfmt.error_code(st).alias("error_code"),
                    logfmt.path_order_id(F.col("path")).alias("path_order_id"), "user_id")


def container_log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_complete records out of container log files; some lines of
    the files are no envelopes."""
    log = si.request_log(spark, sf_dir)
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    stream = F.when(F.col("status_code") >= 400, "stderr").otherwise("stdout")
    line = F.to_json(F.struct(F.col("log_line").alias("log"), stream.alias("stream"), time.alias("time")))
    path = scratch_dir(spark, f"container-logs-{uuid.uuid4().hex[:12]}")
    log.select(F.when(F.col("event_id") % 19 == 0, "no envelope").otherwise(line).alias("value")).write.text(path)
    r = logs.parse_request_complete(logs.read_container_logs(spark, path))
    return r.select(F.col("envelope_time").cast("timestamp_ntz").alias("ts"), "stream", "method", "path",
                    "status_code", "duration_ms", "user_id")


def daily_log_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in its daily layout, read back with each row's day."""
    path = scratch_dir(spark, f"daily-log-{uuid.uuid4().hex[:12]}")
    columns = ["ts", "event_id", "method", "path", "status_code"]
    logs.write_daily(si.request_log(spark, sf_dir).select(*columns), path)
    return spark.read.parquet(path).select(F.date_format("date", "yyyy-MM-dd").alias("day"), *columns)


def request_start_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request-start records with query string and order id."""
    return logs.request_start_records(si.request_starts(spark, sf_dir))


def offer_request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer request bodies decoded, and the check each fails first."""
    r = payloads.decode_offer_requests(si.offer_request_bodies(spark, sf_dir))
    reject = enrich.offer_request_reject(F.col("user_id"), F.col("scooter_id"), F.col("_corrupt_record").isNotNull())
    return r.select("request_id", "ts", "user_id", "scooter_id", F.col("_corrupt_record").alias("malformed_body"),
                    reject.alias("reject"))


def order_documents_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored order documents decoded, absent prices read as 0."""
    doc = lookup.order_read_model(si.rides(spark, sf_dir))
    value = jsonfmt.order_json(*[F.col(c) for c in (
        "current_amount", "deposit", "duration_seconds", "finish_time", "id", "offer_id", "price_per_minute",
        "price_unlock", "scooter_id", "start_time", "status", "user_id")])
    read = payloads.decode_order_documents(doc.select(value.alias("value")))
    return lookup.null_to_zero(read.drop("_present"), ["price_per_minute", "price_unlock", "deposit", "current_amount"])


# What orders, ledger and metrics read of an admitted request and of a finish.
_ADMITTED_COLUMNS = ["order_id", "user_id", "offer_id", "requested_at", "outcome", "offer_scooter_id",
                     "offer_price_per_minute", "offer_price_unlock", "offer_deposit"]
_FINISHED_COLUMNS = ["order_id", "requested_at", "outcome", "duration_seconds", "total_amount", "charge_ok",
                     "unhold_ok", "order_user_id", "order_deposit"]


def _world(spark: SparkSession, sf_dir: str, all_outcomes: bool = False, order_cols: list[str] | None = None,
           claims: bool = False):
    """Orders snapshot after finishes and the full ledger (HOLD + CLEAR + REFUND).

    Admission and finish outcomes feed several outputs (orders, ledger,
    metrics), so both are written once to the checkpoint folder and read back
    instead of being recomputed per consumer.  Written are the rows that change
    something (offers claimed, rides closed) and the columns read later.  The
    admitted requests are the orders created, with ``claims`` the claims whose
    hold failed too, with ``all_outcomes`` every request; ``order_cols`` are
    columns of the requests to keep."""
    tb = order_cols or []
    columns = [*_ADMITTED_COLUMNS, *tb]
    if all_outcomes:
        admitted = materialize(_admitted(spark, sf_dir).select(*columns), "admitted")
    else:
        admitted = admission.offer_claims(si.order_requests(spark, sf_dir), si.offers(spark, sf_dir),
                                          si.ORDER_REQUEST_TIEBREAK, columns)
        if not claims:
            admitted = admitted.where(F.col("outcome") == "CREATED")
    orders = admission.created_orders(admitted)
    calls, payments = si.finish_requests(spark, sf_dir), si.payment_outcomes(spark, sf_dir)
    if tb:
        done = finish.close_rides(orders, calls, payments, si.ORDER_REQUEST_TIEBREAK)
        done = materialize(done.select(*_FINISHED_COLUMNS, *tb), "finished")
    else:
        done = finish.closed_rides(orders, calls, payments, si.ORDER_REQUEST_TIEBREAK, _FINISHED_COLUMNS)
    ledger = admission.hold_ledger_rows(admitted).unionByName(finish.finish_ledger(done))
    return admitted, orders, done, finish.apply_finish(orders, done), ledger


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL, length, domain and key checks on orders and ledger."""
    _, _, _, snap, ledger = _world(spark, sf_dir)
    return quality.order_constraints(snap).unionByName(quality.ledger_constraints(ledger))


def offer_contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q01/Q02/Q04 on the offers saved by offer creation."""
    return quality.offer_contract(offers.saved_offers(offer_creation(spark, sf_dir)))


def order_contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q03/Q05/Q06/Q07 on the orders snapshot against the offers."""
    _, _, _, snap, _ = _world(spark, sf_dir)
    return quality.order_contract(snap, si.offers(spark, sf_dir))


def ledger_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q08/Q09/Q10 ledger reconciliation."""
    _, _, _, snap, ledger = _world(spark, sf_dir)
    return quality.ledger_invariants(snap, ledger)


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _admitted(spark, sf_dir).select(
        "user_id", F.col("requested_at").alias("ts"),
        (F.col("outcome") == "CREATED").alias("success"))


def scenario_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successes, failures, throughput and success % of order attempts."""
    return metrics.scenario_report(_attempts(spark, sf_dir))


def per_user_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order attempt successes and failures per user."""
    return metrics.per_user_outcomes(_attempts(spark, sf_dir))


def business_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers, orders, active rides, payment errors, revenue."""
    admitted, _, _, snap, ledger = _world(spark, sf_dir, claims=True)
    return metrics.business_counters(offer_creation(spark, sf_dir), admitted, snap, ledger)


def conversion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: offers that became orders."""
    orders = admission.created_orders(_admitted(spark, sf_dir))
    offs = si.offers(spark, sf_dir).select(F.col("id").alias("offer_id"))
    return metrics.conversion_rate(offs, orders)


def _cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    tb = si.ORDER_REQUEST_TIEBREAK
    admitted, orders, done, _, _ = _world(spark, sf_dir, order_cols=tb)
    creates = admitted.where(F.col("outcome") == "CREATED").select(
        "order_id", F.col("requested_at").alias("ts"), *tb)
    fins = done.where(F.col("outcome").isin("FINISHED", "PAYMENT_FAILED")).select(
        "order_id", F.col("requested_at").alias("ts"), *tb)
    return metrics.order_cache_replay(creates, si.order_reads(spark, sf_dir), fins, orders, tb)


def order_cache_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HIT / MISS / ABSENT of every order read under a 30 min read-through cache."""
    return _cache(spark, sf_dir)


def cache_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache hit rate of the replay."""
    return metrics.cache_hit_rate(_cache(spark, sf_dir))


def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged order + transaction archive records with hour partitions."""
    _, _, _, snap, ledger = _world(spark, sf_dir)
    return archive.archive_records(snap, ledger)


def _rotated(spark: SparkSession, sf_dir: str, runs: int = 1):
    """The archive of the removed orders, written by the rotation and read
    back, and the hot tables it leaves; ``runs`` over one repeat it, as a retry
    does."""
    _, _, _, snap, ledger = _world(spark, sf_dir)
    # read by every run, by its archive and by the hot tables
    snap = materialize(snap, "snapshot")
    root = scratch_dir(spark, f"archive-{uuid.uuid4().hex[:12]}")
    hot = {}
    for _ in range(runs):
        hot = archive.rotate(snap, ledger, RIDES_AS_OF, root)
    schema = archive.archive_records(snap, ledger).drop(*archive.PARTITION_COLS).schema
    return hot, tables.read_archive(spark, root, schema), snap, ledger


def archive_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive records written by the rotation, run twice as
    after a retry, read back."""
    _, cold, snap, ledger = _rotated(spark, sf_dir, runs=2)
    return cold.select(*archive.archive_records(snap, ledger).columns)


def hot_cold_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of Jun-Dec 1997 merged from the hot tables left by the
    rotation and the archive it wrote (hot wins)."""
    hot, cold, _, _ = _rotated(spark, sf_dir)
    return archive.hot_cold_history(hot["orders"], hot["ledger"], cold,
                                    "1997-06-01 00:00:00", "1998-01-01 00:00:00")


def payment_retry_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLEAR and REFUND retries for PAYMENT_FAILED orders."""
    _, _, _, snap, ledger = _world(spark, sf_dir)
    return archive.payment_retry_worklist(snap, ledger)


def stream_panel_rps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel RPS of a log that arrives out of order, in four arrivals."""
    events = si.read_table(spark, sf_dir, "events")
    return jobs.stream_panel_rps(si.arriving_files(events, "events", F.col("event_id") % 4))


LATENESS_SECONDS = 600


def stream_panel_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel minutes closed by a watermark, over a log in four arrivals by
    time; every 97th line of the first arrival comes with the last, too late."""
    events = si.read_table(spark, sf_dir, "events")
    quarter = si.in_quarters(events, "ts")
    delayed = F.when((quarter == 0) & (F.col("event_id") % 97 == 5), 3).otherwise(quarter)
    return jobs.stream_panel_windows(si.arriving_files(events, "events", delayed), LATENESS_SECONDS)


def stream_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines kept and dropped by the stream, counted as they flow."""
    log = si.request_log(spark, sf_dir).select("ts", "event_id", "log_line")
    return jobs.stream_drop_counts(si.arriving_files(log, "log-lines", F.col("event_id") % 4))


def stream_order_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming intake over four arrivals, the first request of an order id
    kept and every request without one."""
    req = si.order_requests(spark, sf_dir)
    stream = si.arriving_files(req, "order-requests", si.in_quarters(req, "requested_at"))
    return jobs.stream_order_intake(stream, si.ORDER_REQUEST_TIEBREAK)


def _arriving_offer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = si.offer_requests(spark, sf_dir)
    return si.arriving_files(req, "offer-requests", si.in_quarters(req, "ts"))


def stream_offer_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming offer enrichment and pricing (stream-static joins)."""
    return jobs.stream_offer_pricing(_arriving_offer_requests(spark, sf_dir), si.scooters(spark, sf_dir),
                                     si.zones(spark, sf_dir), si.users(spark, sf_dir))


def stream_offer_creation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T01 streaming: offer creation with reuse carried across micro-batches."""
    return jobs.stream_offer_creation(_arriving_offer_requests(spark, sf_dir), si.scooters(spark, sf_dir),
                                      si.zones(spark, sf_dir), si.users(spark, sf_dir))


def stream_offer_creation_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T01 streaming on out-of-order arrival: every fifth request comes a
    quarter of the time span late, and waits are as long."""
    req = si.offer_requests(spark, sf_dir)
    lo, hi = req.agg(F.min("ts"), F.max("ts")).first()
    lateness = int((hi - lo).total_seconds() / 4) + 1 if lo is not None else 0
    late = (F.regexp_extract("request_id", r"(\d+)$", 1).cast("long") % 5 == 0).cast("int")
    return jobs.stream_offer_creation(
        si.arriving_files(req, "offer-requests", si.in_quarters(req, "ts") + late),
        si.scooters(spark, sf_dir), si.zones(spark, sf_dir), si.users(spark, sf_dir), lateness_seconds=lateness)


def _twice_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer requests whose log repeats every third row, and another request
    at the same instant for every fifth."""
    r = si.offer_requests(spark, sf_dir)
    n = F.regexp_extract("request_id", r"(\d+)$", 1).cast("long")
    same = r.where(n % 5 == 0).withColumn("request_id", F.concat("request_id", F.lit("-again")))
    return r.unionByName(r.where(n % 3 == 0)).unionByName(same)


def offer_creation_repeated_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T01 on an at-least-once log: repeated rows are one request, requests at
    one instant are several."""
    return offers.create_offers(_twice_logged(spark, sf_dir), si.scooters(spark, sf_dir),
                                si.zones(spark, sf_dir), si.users(spark, sf_dir))


def offer_creation_min_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An offer is reused only while more than its whole TTL remains, that
    is never: every valid request, same-instant ones too, creates its own."""
    return offers.create_offers(_twice_logged(spark, sf_dir), si.scooters(spark, sf_dir),
                                si.zones(spark, sf_dir), si.users(spark, sf_dir),
                                min_remaining_seconds=300)


def offer_creation_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers of a week, reused while more than two days of it remain and
    until claimed; the offer of every other request is claimed after a day."""
    r = si.offer_requests(spark, sf_dir)
    n = F.regexp_extract("request_id", r"(\d+)$", 1).cast("long")
    claims = r.where(n % 2 == 0).select(
        pricing.offer_id(F.col("user_id"), F.col("scooter_id"), F.col("ts")).alias("offer_id"),
        (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("claimed_at"))
    return offers.create_offers(r, si.scooters(spark, sf_dir), si.zones(spark, sf_dir), si.users(spark, sf_dir),
                                ttl_seconds=7 * 86400, claims=claims, min_remaining_seconds=2 * 86400)


def live_offers_at_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offers of its user that are alive when a request arrives, their
    number and the latest one; an offer lives as many times its TTL as its
    price per minute says, so lengths differ."""
    made = materialize(offers.saved_offers(offer_creation(spark, sf_dir)), "saved-offers")
    alive = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (
        F.col("ttl_seconds") * F.lit(200) * F.col("price_per_minute")).cast("decimal(18,6)"))
    saved = made.select("user_id", F.col("id").alias("offer_id"), "created_at",
                        (F.col("created_at") + alive).alias("alive_until"))
    points = si.offer_requests(spark, sf_dir).select("request_id", "user_id", "ts")
    return intervals.latest_interval(points, saved, ["user_id"], "ts", "created_at", "alive_until",
                                     ["request_id"], ["offer_id"])


def latency_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p50/p95/p99 latency per route and day merged from stored sketches of
    every minute, and whether each lies within the stated rank error of the
    exact quantile."""
    records = _records(spark, sf_dir).select("route", "ts", F.col("duration_ms").cast("double").alias("v"))
    kept = materialize(sketches.minute_sketches(records, ["route"], "v"), "latency-sketches")
    probs, names = [0.5, 0.95, 0.99], ["p50", "p95", "p99"]
    day = F.date_trunc("day", F.col("minute")).cast("timestamp_ntz")
    q = materialize(sketches.window_quantiles(kept.withColumn("day", day), ["route"], "day", probs, names), "latency-days")
    of_day = records.where("v is not null").withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    met = of_day.join(broadcast_if_small(q), ["route", "day"]).groupBy("route", "day").agg(
        F.count(F.lit(1)).alias("requests"),
        *[F.sum((F.col("v") < F.col(c)).cast("long")).alias(f"{c}_below") for c in names],
        *[F.sum((F.col("v") <= F.col(c)).cast("long")).alias(f"{c}_upto") for c in names])
    off = sketches.rank_error()
    return met.select("route", "day", "requests", *[
        ((F.col(f"{c}_below") <= F.col("requests") * (p + off) + 1)
         & (F.col(f"{c}_upto") >= F.col("requests") * (p - off) - 1)).alias(f"{c}_within")
        for p, c in zip(probs, names)])


# Orders of one bucket, about.
_BUCKET_ORDERS = 100_000


def orders_with_ledger_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their ledger totals joined from bucketed tables,
    without a shuffle of either."""
    admitted, _, _, snap, ledger = _world(spark, sf_dir)
    # one task sorts, writes and joins a bucket, so their number grows with the orders
    buckets = max(8, -(-admitted.count() // _BUCKET_ORDERS))
    with_key = snap.select("id", "user_id", "status", "total_amount")
    left = layout.bucketed(with_key, "id", buckets)
    right = layout.bucketed(ledger.select("order_id", "transaction_type", "amount"), "order_id", buckets)
    return layout.ledger_totals(left, right)


def order_lookup_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders named by GET requests, read from the shards the map names."""
    rides = si.rides(spark, sf_dir)
    path = scratch_dir(spark, f"order-shards-{uuid.uuid4().hex[:12]}")
    layout.write_sharded(rides, path, 64)
    shard_map = materialize(lookup.order_shard_map(rides, 64), "shard-map")
    log = si.request_log(spark, sf_dir).where(F.col("method") == "GET")
    ids = log.select(logfmt.path_order_id(F.col("path")).alias("order_id")).distinct()
    return layout.orders_of_shards(spark.read.parquet(path), shard_map, ids)


def offer_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers to store with their TTL, and those already expired."""
    return offers.offer_saves(offer_creation(spark, sf_dir))


def offer_pricing_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer pricing with the zone tariff and config as of each request."""
    return enrich.price_offer_requests_versioned(
        si.offer_requests(spark, sf_dir), si.scooters(spark, sf_dir),
        si.zone_fetches(spark, sf_dir), si.users(spark, sf_dir), si.config_polls(spark, sf_dir))


def request_records_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_complete records rebuilt from bodies: merged
    business keys, level/message/error code, truncated bodies, duration."""
    log = logs.keep_request_complete(si.request_log(spark, sf_dir))
    r = logs.enriched_records(log, "request_body", "response_body", "status_code", "duration_ns")
    return r.select("event_id", "user_id", "order_id", "offer_id", "scooter_id", "order_status",
                    "level", "message", "error_code", "error_response", "request_body_logged",
                    F.col("duration_ms"))


def minute_latency_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact p99 latency of every minute and the p99 > 1 s alert flag."""
    q = logs.minute_p99(_records(spark, sf_dir))
    return q.select("minute", F.round("p99", 6).alias("p99"), "alert")


def route_rps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A02-A05 normalised by route (P14): per-minute RPS of each service route."""
    return logs.route_rps(_records(spark, sf_dir))


def trailing_requests_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_complete records of the 15 minutes up to an as-of time."""
    r = logs.trailing(_records(spark, sf_dir), "2024-01-15 12:00:00", 15)
    return r.select("ts", "event_id", "method", "path", "status_code", "route")


def _admitted_persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.admit_orders(si.order_requests_with_persist(spark, sf_dir),
                                  si.offers(spark, sf_dir), si.ORDER_REQUEST_TIEBREAK,
                                  persist_col="persisted")


def admission_with_persist_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission when storing the order can fail after the hold."""
    return _admitted_persist(spark, sf_dir).select(
        "order_id", "offer_id", "user_id", "requested_at", "hold_success", "persisted",
        *si.ORDER_REQUEST_TIEBREAK, "outcome", "http_status")


def admission_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W01/W02 with state from before the batch: the later half of the log is
    admitted after the earlier one, whose orders and claimed offers it reads."""
    # read by the cut and by both days, by the search for shared order ids and by admission
    req, offs = materialize(si.order_requests(spark, sf_dir), "requests"), si.offers(spark, sf_dir)
    lo, hi = req.agg(F.min("requested_at"), F.max("requested_at")).first()
    late = F.col("requested_at") >= F.lit(lo + (hi - lo) / 2).cast("timestamp_ntz")
    out = ["order_id", "offer_id", "user_id", "requested_at", "hold_success", *si.ORDER_REQUEST_TIEBREAK,
           "outcome", "http_status"]
    first = materialize(admission.admit_orders(req.where(~late), offs, si.ORDER_REQUEST_TIEBREAK).select(*out), "day-one")
    second = admission.admit_orders(
        req.where(late), offs, si.ORDER_REQUEST_TIEBREAK,
        existing_orders=first.where("outcome = 'CREATED'").select(F.col("order_id").alias("id")),
        used_offers=admission.claimed_offers(first))
    return first.unionByName(second.select(*out))


def admission_shared_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T03 where order ids span offers (four order keys share one id)."""
    req = si.order_requests(spark, sf_dir).withColumn(
        "order_id", F.when(F.col("order_id") != "", F.concat(
            F.lit("order-"), F.floor(F.col("l_orderkey") / 4).cast("string"), F.lit("-"),
            (F.col("l_linenumber") % 2).cast("string"))).otherwise(F.lit("")))
    return admission.admit_orders(req, si.offers(spark, sf_dir), si.ORDER_REQUEST_TIEBREAK).select(
        "order_id", "offer_id", "user_id", "requested_at", "hold_success", *si.ORDER_REQUEST_TIEBREAK,
        "outcome", "http_status")


def hold_compensations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNHOLD calls owed for holds whose order was not stored."""
    return admission.hold_compensations(_admitted_persist(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "offer_pricing_degraded": offer_pricing_degraded,
    "offer_pricing_documents": offer_pricing_documents,
    "orders_snapshot_readback": orders_snapshot_readback,
    "ledger_snapshot_readback": ledger_snapshot_readback,
    "hold_ledger_payment_ids": hold_ledger_payment_ids,
    "finish_ledger_payment_ids": finish_ledger_payment_ids,
    "request_start_records": request_start_records,
    "order_documents_readback": order_documents_readback,
    "offer_request_bodies": offer_request_bodies,
    "panel_trailing_rps": panel_trailing_rps,
    "cache_hit_rate_alert": cache_hit_rate_alert,
    "admission_two_days": admission_two_days,
    "admission_shared_order_ids": admission_shared_order_ids,
    "archive_readback": archive_readback,
    "offer_creation_repeated_log": offer_creation_repeated_log,
    "offer_creation_min_remaining": offer_creation_min_remaining,
    "offer_saves": offer_saves,
    "offer_creation_claims": offer_creation_claims,
    "live_offers_at_requests": live_offers_at_requests,
    "latency_sketches": latency_sketches,
    "orders_with_ledger_bucketed": orders_with_ledger_bucketed,
    "order_lookup_sharded": order_lookup_sharded,
    "admission_with_persist_failures": admission_with_persist_failures,
    "hold_compensations": hold_compensations,
    "trailing_requests_15m": trailing_requests_15m,
    "route_rps": route_rps,
    "minute_latency_p99": minute_latency_p99,
    "request_records_enriched": request_records_enriched,
    "offer_pricing_versioned": offer_pricing_versioned,
    "archive_records": archive_records,
    "hot_cold_history": hot_cold_history,
    "payment_retry_worklist": payment_retry_worklist,
    "stream_panel_rps": stream_panel_rps,
    "stream_panel_windows": stream_panel_windows,
    "stream_drop_counts": stream_drop_counts,
    "stream_offer_creation_out_of_order": stream_offer_creation_out_of_order,
    "stream_order_intake": stream_order_intake,
    "stream_offer_pricing": stream_offer_pricing,
    "stream_offer_creation": stream_offer_creation,
    "constraint_violations": constraint_violations,
    "offer_contract_checks": offer_contract_checks,
    "order_contract_checks": order_contract_checks,
    "ledger_invariants": ledger_invariants,
    "scenario_report": scenario_report,
    "per_user_outcomes": per_user_outcomes,
    "business_counters": business_counters,
    "conversion_rate": conversion_rate,
    "order_cache_replay": order_cache_replay,
    "cache_hit_rate": cache_hit_rate,
    "log_drop_counts": log_drop_counts,
    "panel_rps": panel_rps,
    "endpoint_latency": endpoint_latency,
    "endpoint_error_rate": endpoint_error_rate,
    "error_rate_alerts": error_rate_alerts,
    "log_tail": log_tail,
    "request_complete_records": request_complete_records,
    "container_log_records": container_log_records,
    "daily_log_readback": daily_log_readback,
    "order_lookup": order_lookup,
    "user_order_history": user_order_history,
    "latest_order_per_offer": latest_order_per_offer,
    "expired_orders": expired_orders,
    "cleanup_audit_log": cleanup_audit_log,
    "cleanup_summary": cleanup_summary,
    "orders_after_cleanup": orders_after_cleanup,
    "ledger_after_cleanup": ledger_after_cleanup,
    "cascade_orphans": cascade_orphans,
    "ride_status_view": ride_status_view,
    "order_shard_map": order_shard_map,
    "finish_outcomes": finish_outcomes,
    "finish_ledger": finish_ledger,
    "orders_after_finish": orders_after_finish,
    "orders_after_finish_by_month": orders_after_finish_by_month,
    "orders_after_cleanup_by_month": orders_after_cleanup_by_month,
    "ledger_rollup": ledger_rollup,
    "ride_billing_summary": ride_billing_summary,
    "order_admission": order_admission,
    "admission_summary": admission_summary,
    "admitted_orders": admitted_orders,
    "hold_ledger": hold_ledger,
    "offer_pricing": offer_pricing,
    "offer_creation": offer_creation,
    "ttl_chain_user_6h": ttl_chain_user_6h,
    "zone_cache_replay": zone_cache_replay,
}

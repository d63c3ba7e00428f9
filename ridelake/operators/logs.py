"""Log-derived metrics.

Raw lines are filtered with substring / regex tests *before* any JSON parsing
(the shipper's drop stage); only surviving lines are decoded with
``from_json`` and a fixed schema.  Minute buckets come from ``window`` on the
NTZ event time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import logfmt
from ..functions.pricing import epoch_micros
from ..plans.quantiles import exact_quantiles, quantile_names

REQUEST_COMPLETE = r'"event":"request_complete"'

# The dashboard's panels as conjunctive line filters (raw form).
PANELS = {
    "total": ["request_complete"],
    "offers": ["request_complete", "/offers"],
    "orders_post": ["request_complete", "/orders", "POST"],
    "orders_get": ["request_complete", "/orders/", "GET"],
    "finish": ["request_complete", "/orders/", "finish", "POST"],
}

# Alert bounds.
ERROR_RATE_BOUND = 0.05
ERROR_RATE_MINUTES = 2
P99_BOUND_MS = 1000.0
HIT_RATE_BOUND = 0.90


def read_container_logs(spark, path: str, streaming: bool = False) -> DataFrame:
    """Container log files, one JSON envelope per line -> ``log_line``, ``stream``."""
    src = spark.readStream.text(path) if streaming else spark.read.text(path)
    env = F.from_json(F.col("value"), schemas.CONTAINER_ENVELOPE)
    return src.select(env["log"].alias("log_line"), env["stream"].alias("stream"),
                      env["time"].alias("envelope_time"))


def request_start_records(starts: DataFrame, uri_col: str = "uri") -> DataFrame:
    """Request-start records; ``uri_col`` gives way to ``path``, ``query``
    (null unless non-empty) and the ``order_id`` its path names."""
    path = logfmt.uri_path(F.col(uri_col))
    return starts.select(*[c for c in starts.columns if c != uri_col], path.alias("path"),
                         logfmt.uri_query(F.col(uri_col)).alias("query"),
                         logfmt.path_order_id(path).alias("order_id"))


_REGEX_META = set("\\^$.|?*+()[]{}")


def line_match(line: Column, pattern: str) -> Column:
    """``|~ pattern``: a regex search; a pattern without regex metacharacters is
    a plain substring test (same result, no regex engine)."""
    if any(ch in _REGEX_META for ch in pattern):
        return line.rlike(pattern)
    return line.contains(pattern)


def line_filter(line: Column, patterns: list[str]) -> Column:
    """every pattern must match (``|~ a |~ b``)."""
    return reduce(lambda a, b: a & b, [line_match(line, p) for p in patterns])


def keep_request_complete(logs: DataFrame, line_col: str = "log_line") -> DataFrame:
    """keep only request_complete lines."""
    return logs.where(F.col(line_col).rlike(REQUEST_COMPLETE))


def keep_request_complete_observed(logs: DataFrame, line_col: str = "log_line"):
    """F12 with the drop counter of the shipper: returns ``(kept, observation)``;
    after an action on ``kept``, ``observation.get`` holds ``lines`` and
    ``dropped_not_request_complete`` -- counted while the data flows, with no
    extra pass."""
    from pyspark.sql import Observation
    obs = Observation("request_complete_filter")
    kept = F.col(line_col).rlike(REQUEST_COMPLETE)
    observed = logs.observe(obs, F.count(F.lit(1)).alias("lines"),
                            F.sum((~kept).cast("long")).alias("dropped_not_request_complete"))
    return observed.where(kept), obs


def drop_counts(logs: DataFrame, line_col: str = "log_line") -> DataFrame:
    """kept vs dropped line counts (drop reason ``not_request_complete``)."""
    kept = F.col(line_col).rlike(REQUEST_COMPLETE)
    return logs.select(F.when(kept, "kept").otherwise("not_request_complete").alias("reason")) \
        .groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def parse_request_complete(logs: DataFrame, line_col: str = "log_line") -> DataFrame:
    """K07 input: decode request_complete records (duplicate keys: last wins)."""
    rec = F.from_json(F.col(line_col), schemas.REQUEST_COMPLETE_LOG)
    return keep_request_complete(logs, line_col).withColumn("rec", rec).select("*", "rec.*") \
        .drop("rec")


def trailing(logs: DataFrame, as_of, minutes: int = 15, ts: str = "ts") -> DataFrame:
    """rows in the trailing window ``[as_of - minutes, as_of]``."""
    at = F.lit(as_of).cast("timestamp_ntz")
    return logs.where((F.col(ts) >= at - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)))
                      & (F.col(ts) <= at))


def panel_rps(logs: DataFrame, ts: str = "ts", line_col: str = "log_line",
              panels: dict[str, list[str]] | None = None) -> DataFrame:
    """Per panel and minute, matching lines / 60.  One pass: each line
    is tagged with every panel it matches (explode of a short array), then one
    aggregation over (panel, minute)."""
    t = logs.select(F.window(F.col(ts), "1 minute").start.alias("minute"),
                    F.explode(panel_tags(F.col(line_col), panels)).alias("panel"))
    return t.groupBy("panel", "minute").agg((F.count(F.lit(1)) / F.lit(60.0)).alias("rps"))


def panel_trailing_rps(logs: DataFrame, ts: str = "ts", line_col: str = "log_line",
                       step_seconds: int = 15, panels: dict[str, list[str]] | None = None) -> DataFrame:
    """A01-A05 as the panels draw them: at every step instant, the matching
    lines of the minute up to it (exclusive, inclusive) / 60.  Lines are
    counted per step first; a count then adds to the instants whose minute
    covers its step, so what is expanded are counts, not lines.
    ``step_seconds`` divides 60."""
    step = step_seconds * 1_000_000
    tagged = logs.select(F.ceil(epoch_micros(F.col(ts)) / F.lit(step)).cast("long").alias("_step"),
                         F.explode(panel_tags(F.col(line_col), panels)).alias("panel"))
    counts = tagged.groupBy("panel", "_step").agg(F.count(F.lit(1)).alias("n"))
    reach = F.sequence(F.col("_step"), F.col("_step") + F.lit(60 // step_seconds - 1))
    at = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                            (F.col("_at") * F.lit(step_seconds)).cast("decimal(18,6)"))
    return (counts.select("panel", "n", F.explode(reach).alias("_at"))
            .groupBy("panel", "_at").agg((F.sum("n") / F.lit(60.0)).alias("rps"))
            .select("panel", (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + at).alias("instant"), "rps"))


def route_rps(records: DataFrame, ts: str = "ts") -> DataFrame:
    """A02-A05, normalised variant (P14): per route and minute, requests / 60,
    on decoded request_complete records (a finish call counts only as
    ``finish_order``, unlike the raw "POST /orders" panel)."""
    t = records.select(F.window(F.col(ts), "1 minute").start.alias("minute"),
                       logfmt.route(F.col("method"), F.col("path")).alias("route"))
    return t.groupBy("route", "minute").agg((F.count(F.lit(1)) / F.lit(60.0)).alias("rps"))


def panel_tags(line: Column, panels: dict[str, list[str]] | None = None) -> Column:
    """Names of the panels whose line filters a log line passes."""
    panels = panels or PANELS
    return F.array_compact(F.array(*[F.when(line_filter(line, pats), F.lit(name))
                                     for name, pats in panels.items()]))


def latency_quantiles(logs: DataFrame, group_cols: list[str], value: str = "duration_ms",
                      probs=(0.5, 0.95, 0.99), exact: bool = True,
                      accuracy: int = 10_000) -> DataFrame:
    """p50/p95/p99 per group.  ``exact`` (default): linear interpolation
    over a distributed global sort.  Otherwise ``percentile_approx`` with a
    bounded sketch per group (rank error <= 1/accuracy), the cheaper choice
    for dashboards over very large logs."""
    names = ["p50", "p95", "p99"] if tuple(probs) == (0.5, 0.95, 0.99) else quantile_names(list(probs))
    if exact:
        return exact_quantiles(logs, group_cols, value, list(probs), names=names)
    q = F.percentile_approx(F.col(value).cast("double"), list(probs), accuracy)
    return logs.groupBy(*group_cols).agg(q.alias("_q")).select(
        *group_cols, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def error_rates(logs: DataFrame, group_cols: list[str], status: str = "status_code") -> DataFrame:
    """Share of requests with status >= 400."""
    return logs.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum((F.col(status) >= 400).cast("long")).alias("errors"),
    ).withColumn("error_rate", F.try_divide(F.col("errors").cast("double"),
                                            F.col("requests").cast("double")))


def error_rate_alerts(logs: DataFrame, ts: str = "ts", status: str = "status_code",
                      bound: float = ERROR_RATE_BOUND, minutes: int = ERROR_RATE_MINUTES
                      ) -> DataFrame:
    """Minutes ending a run of ``minutes`` adjacent minutes whose error
    rate exceeds ``bound``.  Adjacency is an equi-join of the breaching
    minutes with themselves shifted by k minutes (no global ordering)."""
    per_min = error_rates(logs.withColumn("minute", F.window(F.col(ts), "1 minute").start),
                          ["minute"], status)
    breach = per_min.where(F.col("error_rate") > F.lit(bound))
    out = breach
    for k in range(1, minutes):
        prev = breach.select((F.col("minute") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(k)))
                             .alias("minute"))
        out = out.join(prev, "minute", "left_semi")
    return out.select("minute", "requests", "errors", "error_rate")


def minute_p99(logs: DataFrame, ts: str = "ts", value: str = "duration_ms",
               bound_ms: float = P99_BOUND_MS) -> DataFrame:
    """A14 input: exact p99 latency of every minute and whether it breaches
    ``bound_ms`` (``alert``)."""
    per_min = logs.withColumn("minute", F.window(F.col(ts), "1 minute").start)
    q = exact_quantiles(per_min, ["minute"], value, [0.99], names=["p99"])
    return q.withColumn("alert", F.col("p99") > F.lit(bound_ms))


def latency_alerts(logs: DataFrame, ts: str = "ts", value: str = "duration_ms",
                   bound_ms: float = P99_BOUND_MS) -> DataFrame:
    """Minutes whose exact p99 latency exceeds ``bound_ms``."""
    return minute_p99(logs, ts, value, bound_ms).where("alert")


def hit_rate_alert(hit_rate: DataFrame, bound: float = HIT_RATE_BOUND) -> DataFrame:
    """The cache hit-rate row when it is below ``bound``."""
    return hit_rate.where(F.col("hit_rate") < F.lit(bound))


def tail(logs: DataFrame, n: int = 1000, ts: str = "ts", tiebreak: str | None = None
         ) -> DataFrame:
    """The newest ``n`` lines (top-k; the limit is the feature)."""
    order = [F.col(ts).desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    return logs.orderBy(*order).limit(n)


def enriched_records(logs: DataFrame, req_body: str, resp_body: str, status: str,
                     duration_ns: str) -> DataFrame:
    """The request_complete record the service writes: merged business
    keys (P06-P08), level/message/error code (P10), truncated error body (P09),
    duration in ms (P13), normalised route (P14)."""
    req = logfmt.request_keys(F.col(req_body))
    resp = logfmt.response_keys(F.col(resp_body))
    keys = logfmt.merged_keys(req, resp)
    st = F.col(status)
    return logs.drop("user_id", "order_id", "offer_id", "scooter_id", "duration_ms").select(
        "*", keys.alias("_keys"),
        logfmt.log_level(st).alias("level"), logfmt.log_message(st).alias("message"),
        logfmt.error_code(st).alias("error_code"),
        F.when(st >= 400, logfmt.truncate_bytes(F.col(resp_body), logfmt.MAX_ERROR_BODY_BYTES))
        .alias("error_response"),
        logfmt.truncate_bytes(F.col(req_body), logfmt.MAX_REQUEST_BODY_BYTES).alias("request_body_logged"),
        logfmt.duration_ms(F.col(duration_ns)).alias("duration_ms"),
    ).select("*", "_keys.*").drop("_keys")


def write_daily(logs: DataFrame, path: str, ts: str = "ts") -> None:
    """Daily layout of the log table (``date=`` partitions)."""
    logs.withColumn("date", F.to_date(F.col(ts))).write.mode("append") \
        .partitionBy("date").parquet(path)

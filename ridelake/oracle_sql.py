"""DuckDB reference SQL for every registered query.

Each query is written independently in plain SQL over the driver's tables
(pre-registered views).  The stand-in inputs appear as CTEs that mirror
``ridelake.sources.standins`` in DuckDB's dialect.
"""

from __future__ import annotations

K = "json_extract_string(props, '$.k')"

STANDINS = {
    "users": """
SELECT 'user-' || CAST(c_custkey AS VARCHAR) AS id, c_mktsegment = 'MACHINERY' AS has_subscription,
       c_acctbal >= 4000 AS trusted
FROM customer WHERE c_custkey % 11 <> 10""",
    "zones": """
SELECT 'zone-' || CAST(n_nationkey AS VARCHAR) AS id, CAST(5 + n_nationkey % 6 AS INTEGER) AS price_per_minute,
       CAST(40 + 5 * (n_nationkey % 8) AS INTEGER) AS price_unlock,
       CAST(150 + 50 * n_regionkey AS INTEGER) AS default_deposit
FROM nation WHERE n_nationkey <> 24""",
    "scooters": """
SELECT 'scooter-' || CAST(p_partkey AS VARCHAR) AS id, 'zone-' || CAST(p_partkey % 25 AS VARCHAR) AS zone_id,
       CAST(p_size * 2 AS INTEGER) AS charge
FROM part WHERE p_partkey % 100 <> 99""",
    "offer_requests": f"""
SELECT 'req-' || CAST(event_id AS VARCHAR) AS request_id, 'user-' || CAST(user_id AS VARCHAR) AS user_id,
       'scooter-' || {K} AS scooter_id, ts
FROM events WHERE event_type IN ('view', 'click')""",
    "offers": """
SELECT 'offer-' || CAST(o_orderkey AS VARCHAR) AS id, 'user-' || CAST(o_custkey AS VARCHAR) AS user_id,
       'scooter-' || CAST(o_orderkey % 200 AS VARCHAR) AS scooter_id,
       'zone-' || CAST((o_orderkey % 200) % 25 AS VARCHAR) AS zone_id,
       CAST(5 + o_orderkey % 6 AS INTEGER) AS price_per_minute, CAST(40 + o_orderkey % 8 AS INTEGER) AS price_unlock,
       CAST(100 + o_orderkey % 5 AS INTEGER) AS deposit, o_orderdate AS created_at,
       o_orderdate + INTERVAL 300 SECOND AS expires_at
FROM orders WHERE o_orderkey % 50 <> 49""",
    "order_requests": """
SELECT CASE WHEN l_partkey % 97 = 0 THEN '' ELSE 'order-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber % 2 AS VARCHAR) END AS order_id,
       'offer-' || CAST(l_orderkey AS VARCHAR) AS offer_id,
       'user-' || CAST(CASE WHEN l_suppkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS VARCHAR) AS user_id,
       o_orderdate + INTERVAL 70 SECOND * l_linenumber AS requested_at, l_returnflag <> 'R' AS hold_success,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "rides": """
SELECT 'order-' || CAST(o_orderkey AS VARCHAR) AS id, 'user-' || CAST(o_custkey AS VARCHAR) AS user_id,
       'scooter-' || CAST(o_orderkey % 200 AS VARCHAR) AS scooter_id, 'offer-' || CAST(o_orderkey AS VARCHAR) AS offer_id,
       CAST(5 + o_orderkey % 6 AS INTEGER) AS price_per_minute, CAST(40 + o_orderkey % 8 AS INTEGER) AS price_unlock,
       CAST(100 + o_orderkey % 5 AS INTEGER) AS deposit,
       CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'FINISHED' ELSE 'PAYMENT_FAILED' END AS status,
       o_orderdate AS start_time, o_orderdate AS created_at,
       CAST(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE (o_orderkey * 37) % 3600 END AS INTEGER) AS duration_seconds,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL 1 SECOND * ((o_orderkey * 37) % 3600) END AS finish_time,
       CAST(40 + o_orderkey % 8 AS INTEGER) AS total_amount, o_orderdate AS updated_at
FROM orders""",
    "finish_requests": """
SELECT 'order-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber % 2 AS VARCHAR) AS order_id, l_shipdate AS requested_at,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
FROM lineitem""",
    "payment_outcomes": """
SELECT 'order-' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(b AS VARCHAR) AS order_id, 'charge' AS op, o_orderstatus <> 'P' AS success
FROM orders, (VALUES (0), (1)) t(b)
UNION ALL
SELECT 'order-' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(b AS VARCHAR) AS order_id, 'unhold' AS op, o_orderpriority <> '5-LOW' AS success
FROM orders, (VALUES (0), (1)) t(b)""",
    "order_reads": """
SELECT 'order-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber % 2 AS VARCHAR) AS order_id, o_orderdate + INTERVAL 7 MINUTE * l_linenumber AS ts,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "zone_fetches": f"""
SELECT f.zone_id, f.fetched_at, f.success AND z.id IS NOT NULL AS success, z.price_per_minute, z.price_unlock, z.default_deposit
FROM (SELECT 'zone-' || CAST(CAST({K} AS INTEGER) % 25 AS VARCHAR) AS zone_id, ts AS fetched_at,
             event_type <> 'error' AS success FROM events WHERE event_type IN ('signup', 'purchase', 'error')) f
LEFT JOIN (SELECT 'zone-' || CAST(n_nationkey AS VARCHAR) AS id, CAST(5 + n_nationkey % 6 AS INTEGER) AS price_per_minute,
       CAST(40 + 5 * (n_nationkey % 8) AS INTEGER) AS price_unlock, CAST(150 + 50 * n_regionkey AS INTEGER) AS default_deposit
       FROM nation WHERE n_nationkey <> 24) z ON f.zone_id = z.id""",
    "config_polls": f"""
SELECT ts AS polled_at, value >= 20 AS success, 1.0 + CAST(CAST({K} AS INTEGER) % 5 AS DOUBLE) / 10.0 AS surge,
       CAST(0.7 AS DOUBLE) AS low_charge_discount, CAST(20 + CAST({K} AS INTEGER) % 15 AS INTEGER) AS low_charge_threshold_percent,
       5 AS incomplete_ride_threshold_seconds
FROM events WHERE event_type = 'purchase'""",
    "request_log": f"""
SELECT ts, CASE event_type WHEN 'view' THEN 'GET' ELSE 'POST' END AS method,
       CASE event_type WHEN 'view' THEN '/orders/order-' || {K} WHEN 'click' THEN '/offers'
            WHEN 'purchase' THEN '/orders/order-' || {K} || '/finish' ELSE '/orders' END AS path,
       CAST(CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 200 WHEN 'purchase' THEN 200 ELSE 201 END AS INTEGER) AS status_code,
       value AS duration_ms, event_id,
       CASE WHEN event_id % 10 = 0 THEN 'request_start' ELSE 'request_complete' END AS event,
       'user-' || CAST(user_id AS VARCHAR) AS user_id,
       CASE event_type WHEN 'click' THEN '{{"user_id":"user-' || CAST(user_id AS VARCHAR) || '","scooter_id":"scooter-' || {K} || '"'
              || CASE WHEN event_id % 3 = 0 THEN ',"note":"' || repeat('xé漢', CAST(CAST(floor(value * 10) AS BIGINT) % 500 AS INTEGER)) || '"'
                WHEN event_id % 7 = 0 THEN ',"offer_id":17,"order_id":true' ELSE '' END || '}}'
            WHEN 'signup' THEN '{{"order_id":"order-' || {K} || '","offer_id":"offer-' || {K} || '","user_id":"user-' || CAST(user_id AS VARCHAR) || '"}}'
       END AS request_body,
       CASE event_type WHEN 'click' THEN '{{"id":"offer-' || CAST(event_id AS VARCHAR) || '","user_id":"user-' || CAST(user_id AS VARCHAR) || '","expires_at":"2024-01-01T00:05:00Z"}}'
            WHEN 'signup' THEN '{{"id":"order-' || {K} || '","offer_id":"offer-' || {K} || '","user_id":"user-' || CAST(user_id AS VARCHAR) || '","status":"ACTIVE"}}'
            WHEN 'view' THEN CASE WHEN event_id % 9 = 0 THEN '{{"id":' || {K} || ',"status":["FINISHED"],"user_id":"a\\tb"}}' ELSE '{{"id":"order-' || {K} || '","status":"FINISHED"}}' END
            WHEN 'purchase' THEN '{{"id":"x-' || CAST(event_id AS VARCHAR) || '","order_id":"order-' || {K} || '","status":"FINISHED"}}'
            ELSE 'Internal server error ' || repeat('ü', CAST(event_id % 900 AS INTEGER)) END AS response_body,
       CAST(floor(value * 1000000) AS BIGINT) AS duration_ns
FROM events""",
}

# Config defaults, as SQL literals.
CONFIG = ("SELECT CAST(1.2 AS DOUBLE) AS surge, CAST(0.7 AS DOUBLE) AS low_charge_discount, "
          "28 AS low_charge_threshold_percent, 5 AS incomplete_ride_threshold_seconds")


def with_standins(*names: str, extra: dict[str, str] | None = None,
                  recursive: bool = False) -> str:
    parts = [f"{n} AS ({STANDINS[n]})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def chain_ctes(name: str, src: str, keys: list[str], ts: str, order: list[str],
               ttl_seconds: int, force: str | None = None) -> dict[str, str]:
    """Sequential TTL chain as a recursive CTE: row n is an anchor iff
    ts >= anchor(n-1) + ttl; returns CTEs ``{name}_b`` and ``{name}``."""
    kl = ", ".join(keys)
    ol = ", ".join([ts] + order)
    on = " AND ".join([f"b.{k} = c.{k}" for k in keys] + ["b._rn = c._rn + 1"])
    carry = ", ".join(f"b.{c}" for c in keys + order)
    cond = f"b.{ts} >= c._anchor + INTERVAL {int(ttl_seconds)} SECOND"
    if force:
        cond = f"(b.{force} OR {cond})"
        order = order + [force]
        carry = carry + f", b.{force}"
    return {
        f"{name}_b": f"SELECT {kl}, {', '.join(order)}, {ts}, row_number() OVER (PARTITION BY {kl} ORDER BY {ol}) AS _rn FROM {src}",
        name: (f"SELECT {kl}, {', '.join(order)}, {ts}, _rn, {ts} AS _anchor, true AS _is_anchor FROM {name}_b WHERE _rn = 1 "
               f"UNION ALL SELECT {carry}, b.{ts}, b._rn, CASE WHEN {cond} THEN b.{ts} ELSE c._anchor END, {cond} "
               f"FROM {name} c JOIN {name}_b b ON {on}"),
    }


def _price_sql(surge="cfg.surge", disc="cfg.low_charge_discount",
               thr="cfg.low_charge_threshold_percent") -> str:
    base = f"(CAST(z.price_per_minute AS DOUBLE) * (CASE WHEN {surge} <= 0 THEN 1.0 ELSE {surge} END))"
    return (f"greatest(CAST(round(CASE WHEN s.charge >= 0 AND {thr} > 0 AND s.charge < {thr} "
            f"THEN {base} * (CASE WHEN {disc} <= 0 THEN 1.0 ELSE {disc} END) ELSE {base} END) AS INTEGER), 0)")


PRICED_REQUESTS = f"""
SELECT r.request_id, r.user_id, r.scooter_id, r.ts,
       CASE WHEN coalesce(r.user_id, '') = '' THEN 'USER_ID_REQUIRED'
            WHEN coalesce(r.scooter_id, '') = '' THEN 'SCOOTER_ID_REQUIRED'
            WHEN s.id IS NULL THEN 'SCOOTER_NOT_FOUND'
            WHEN z.id IS NULL THEN 'ZONE_UNAVAILABLE' ELSE 'CREATED' END AS outcome,
       s.zone_id,
       {_price_sql()} AS ppm,
       CAST(greatest(CASE WHEN coalesce(u.has_subscription, false) THEN 0 ELSE z.price_unlock END, 0) AS INTEGER) AS unlock,
       CAST(greatest(CASE WHEN coalesce(u.trusted, false) THEN 0 ELSE z.default_deposit END, 0) AS INTEGER) AS dep
FROM offer_requests r
LEFT JOIN scooters s ON r.scooter_id = s.id
LEFT JOIN zones z ON s.zone_id = z.id
LEFT JOIN users u ON r.user_id = u.id
CROSS JOIN cfg"""

OFFER_STATUS_SQL = ("CAST(CASE outcome WHEN 'CREATED' THEN 201 WHEN 'REUSED' THEN 201 "
                    "WHEN 'ZONE_UNAVAILABLE' THEN 503 WHEN 'SCOOTERS_UNAVAILABLE' THEN 503 "
                    "ELSE 400 END AS INTEGER)")

OFFER_PRICING = with_standins("users", "zones", "scooters", "offer_requests",
                              extra={"cfg": CONFIG, "priced": PRICED_REQUESTS}) + f"""
SELECT request_id, user_id, scooter_id, ts AS requested_at, outcome,
       {OFFER_STATUS_SQL} AS http_status,
       CASE WHEN outcome = 'CREATED' THEN zone_id END AS zone_id,
       CASE WHEN outcome = 'CREATED' THEN ppm END AS price_per_minute,
       CASE WHEN outcome = 'CREATED' THEN unlock END AS price_unlock,
       CASE WHEN outcome = 'CREATED' THEN dep END AS deposit,
       CASE WHEN outcome = 'CREATED' THEN sha256(user_id || ':' || scooter_id || ':' || CAST(epoch_us(ts) AS VARCHAR)) END AS offer_id,
       CASE WHEN outcome = 'CREATED' THEN ts + INTERVAL 300 SECOND END AS expires_at
FROM priced"""

_CREATION = {
    "cfg": CONFIG,
    "priced": PRICED_REQUESTS,
    **chain_ctes("offer_chain", "priced WHERE outcome = 'CREATED'", ["user_id", "scooter_id"], "ts",
                 ["request_id"], 300),
    "flagged": """SELECT p.*, coalesce(c._is_anchor, false) AS is_anchor FROM priced p
        LEFT JOIN offer_chain c ON p.request_id = c.request_id""",
    "cov": """SELECT *, max(CASE WHEN is_anchor THEN ts END) OVER (PARTITION BY user_id, scooter_id ORDER BY ts, request_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor_ts FROM flagged""",
    "created": f"""SELECT c.*, (c.outcome NOT IN ('INVALID_BODY', 'USER_ID_REQUIRED', 'SCOOTER_ID_REQUIRED')
            AND c.anchor_ts IS NOT NULL AND c.ts < c.anchor_ts + INTERVAL 300 SECOND AND NOT c.is_anchor) AS reused,
            a.zone_id AS a_zone, a.ppm AS a_ppm, a.unlock AS a_unlock, a.dep AS a_dep
        FROM cov c LEFT JOIN (SELECT * FROM flagged WHERE is_anchor) a
          ON c.user_id = a.user_id AND c.scooter_id = a.scooter_id AND c.anchor_ts = a.ts""",
    "offer_out": f"""SELECT request_id, user_id, scooter_id, ts AS requested_at,
            CASE WHEN reused THEN 'REUSED' WHEN is_anchor THEN 'CREATED' ELSE outcome END AS outcome,
            CASE WHEN reused THEN a_zone WHEN is_anchor THEN zone_id END AS zone_id,
            CASE WHEN reused THEN a_ppm WHEN is_anchor THEN ppm END AS price_per_minute,
            CASE WHEN reused THEN a_unlock WHEN is_anchor THEN unlock END AS price_unlock,
            CASE WHEN reused THEN a_dep WHEN is_anchor THEN dep END AS deposit,
            CASE WHEN reused OR is_anchor THEN sha256(user_id || ':' || scooter_id || ':' || CAST(epoch_us(CASE WHEN reused THEN anchor_ts ELSE ts END) AS VARCHAR)) END AS offer_id,
            CASE WHEN reused THEN anchor_ts + INTERVAL 300 SECOND WHEN is_anchor THEN ts + INTERVAL 300 SECOND END AS expires_at,
            is_anchor AS is_new_offer,
            CASE WHEN NOT reused THEN zone_id END AS lookup_zone_id
        FROM created""",
}

OFFER_CREATION = with_standins("users", "zones", "scooters", "offer_requests", extra=_CREATION,
                               recursive=True) + f"""
SELECT *, {OFFER_STATUS_SQL} AS http_status FROM offer_out"""

TTL_CHAIN_USER_6H = with_standins("offer_requests", extra={
    **chain_ctes("ch", "offer_requests", ["user_id"], "ts", ["request_id"], 6 * 3600)},
    recursive=True) + """
SELECT r.request_id, r.user_id, r.ts, c._is_anchor AS is_anchor,
       max(CASE WHEN c._is_anchor THEN r.ts END) OVER (PARTITION BY r.user_id ORDER BY r.ts, r.request_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor_ts,
       true AS covered
FROM offer_requests r JOIN ch c ON r.request_id = c.request_id"""

ZONE_CACHE_REPLAY = with_standins("users", "zones", "scooters", "offer_requests", extra={
    **_CREATION,
    "lookups": "SELECT * FROM offer_out WHERE is_new_offer OR outcome = 'ZONE_UNAVAILABLE'",
    **chain_ctes("zch", "lookups WHERE outcome = 'CREATED'", ["lookup_zone_id"], "requested_at",
                 ["request_id"], 600),
    "zflag": """SELECT l.*, coalesce(z._is_anchor, false) AS is_anchor,
        max(CASE WHEN z._is_anchor THEN l.requested_at END) OVER (PARTITION BY l.lookup_zone_id
            ORDER BY l.requested_at, l.request_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor_ts
        FROM lookups l LEFT JOIN zch z ON l.request_id = z.request_id"""}, recursive=True) + """
SELECT request_id, lookup_zone_id AS zone_id, requested_at,
       CASE WHEN is_anchor THEN 'FETCH'
            WHEN anchor_ts IS NOT NULL AND requested_at < anchor_ts + INTERVAL 600 SECOND THEN 'HIT'
            ELSE 'UNAVAILABLE' END AS cache_result
FROM zflag"""

TB = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"

_ADMISSION = {
    "j": """SELECT r.*, o.id AS o_id, o.user_id AS owner, o.expires_at, o.scooter_id AS o_scooter,
        o.price_per_minute AS o_ppm, o.price_unlock AS o_unlock, o.deposit AS o_dep
        FROM order_requests r LEFT JOIN offers o ON r.offer_id = o.id""",
    "v": """SELECT *, CASE WHEN coalesce(order_id, '') = '' THEN 'ORDER_ID_REQUIRED'
            WHEN coalesce(offer_id, '') = '' THEN 'OFFER_ID_REQUIRED'
            WHEN coalesce(user_id, '') = '' THEN 'USER_ID_REQUIRED' END AS rej,
        CASE WHEN o_id IS NULL THEN 'OFFER_NOT_FOUND' WHEN requested_at > expires_at THEN 'OFFER_EXPIRED'
            WHEN user_id <> owner THEN 'INVALID_USER' END AS ochk FROM j""",
    "w": "SELECT *, rej IS NULL AND ochk IS NULL AS valid FROM v",
    "r1": f"""SELECT *, valid AND row_number() OVER (PARTITION BY offer_id, valid ORDER BY requested_at, {TB}) = 1 AS first
        FROM w""",
    "c1": "SELECT *, first AND hold_success AS created FROM r1",
    "d1": f"""SELECT *, coalesce(max(CASE WHEN created THEN 1 ELSE 0 END) OVER (PARTITION BY order_id ORDER BY requested_at, {TB}
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS dup FROM c1""",
    "admitted": """SELECT *, CASE WHEN rej IS NOT NULL THEN rej WHEN dup THEN 'DUPLICATE' WHEN ochk IS NOT NULL THEN ochk
        WHEN NOT first THEN 'OFFER_ALREADY_USED' WHEN NOT hold_success THEN 'PAYMENT_HOLD_FAILED' ELSE 'CREATED' END AS outcome
        FROM d1""",
}

ORDER_STATUS_SQL = ("CAST(CASE WHEN outcome IN ('CREATED', 'DUPLICATE') THEN 201 "
                    "WHEN outcome IN ('PAYMENT_HOLD_FAILED', 'PERSIST_FAILED') THEN 500 ELSE 400 END AS INTEGER)")

ORDER_ADMISSION = with_standins("order_requests", "offers", extra=_ADMISSION) + f"""
SELECT order_id, offer_id, user_id, requested_at, hold_success, {TB}, outcome, {ORDER_STATUS_SQL} AS http_status
FROM admitted"""

ADMISSION_SUMMARY = with_standins("order_requests", "offers", extra=_ADMISSION) + """
SELECT outcome, count(*) AS requests FROM admitted GROUP BY outcome"""

ADMITTED_ORDERS = with_standins("order_requests", "offers", extra=_ADMISSION) + """
SELECT order_id AS id, user_id, o_scooter AS scooter_id, offer_id, coalesce(o_ppm, 0) AS price_per_minute,
       coalesce(o_unlock, 0) AS price_unlock, coalesce(o_dep, 0) AS deposit, coalesce(o_unlock, 0) AS total_amount,
       'ACTIVE' AS status, requested_at AS start_time, CAST(NULL AS TIMESTAMP) AS finish_time,
       CAST(NULL AS INTEGER) AS duration_seconds, requested_at AS created_at, requested_at AS updated_at
FROM admitted WHERE outcome = 'CREATED'"""

HOLD_LEDGER = with_standins("order_requests", "offers", extra=_ADMISSION) + """
SELECT 'txn-' || order_id AS id, order_id, user_id, 'HOLD' AS transaction_type, coalesce(o_dep, 0) AS amount,
       'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS external_transaction_id, CAST(NULL AS VARCHAR) AS error_message,
       requested_at AS created_at
FROM admitted WHERE outcome = 'CREATED'"""

_ORD = """SELECT order_id AS id, user_id, o_scooter AS scooter_id, offer_id, coalesce(o_ppm, 0) AS price_per_minute,
       coalesce(o_unlock, 0) AS price_unlock, coalesce(o_dep, 0) AS deposit, coalesce(o_unlock, 0) AS total_amount,
       'ACTIVE' AS status, requested_at AS start_time, CAST(NULL AS TIMESTAMP) AS finish_time,
       CAST(NULL AS INTEGER) AS duration_seconds, requested_at AS created_at, requested_at AS updated_at
       FROM admitted WHERE outcome = 'CREATED'"""

_HOLD = """SELECT 'txn-' || order_id AS id, order_id, user_id, 'HOLD' AS transaction_type, coalesce(o_dep, 0) AS amount,
       'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS external_transaction_id, CAST(NULL AS VARCHAR) AS error_message,
       requested_at AS created_at FROM admitted WHERE outcome = 'CREATED'"""

_FINISH = {
    **_ADMISSION,
    "ord": _ORD,
    "fj": """SELECT f.*, o.id AS o_id, o.user_id AS o_user, o.status AS o_status, o.start_time AS o_start,
        o.created_at AS o_created, o.price_per_minute AS f_ppm, o.price_unlock AS f_unlock, o.deposit AS f_dep
        FROM finish_requests f LEFT JOIN ord o ON f.order_id = o.id""",
    "fr": """SELECT *, CASE WHEN coalesce(order_id, '') = '' THEN 'ORDER_ID_REQUIRED'
        WHEN o_id IS NULL OR requested_at < o_created THEN 'ORDER_NOT_FOUND'
        WHEN o_status <> 'ACTIVE' THEN 'ORDER_NOT_ACTIVE' END AS frej FROM fj""",
    "fw": f"""SELECT *, frej IS NULL AND row_number() OVER (PARTITION BY order_id, frej IS NULL
        ORDER BY requested_at, {TB}) = 1 AS win FROM fr""",
    "pay": """SELECT order_id, max(CASE WHEN op = 'charge' THEN CAST(success AS INTEGER) END) = 1 AS charge_ok,
        max(CASE WHEN op = 'unhold' THEN CAST(success AS INTEGER) END) = 1 AS unhold_result
        FROM payment_outcomes GROUP BY order_id""",
    "fb": """SELECT fw.*, coalesce(p.charge_ok, false) AS c_ok,
        coalesce(p.charge_ok, false) AND coalesce(p.unhold_result, false) AS u_ok,
        CAST(greatest(0, (epoch_us(requested_at) - epoch_us(o_start)) // 1000000) AS INTEGER) AS secs
        FROM fw LEFT JOIN pay p ON fw.order_id = p.order_id""",
    "finished": f"""SELECT order_id, requested_at, {TB},
        CASE WHEN frej IS NOT NULL THEN frej WHEN NOT win THEN 'ORDER_NOT_ACTIVE'
             WHEN c_ok THEN 'FINISHED' ELSE 'PAYMENT_FAILED' END AS outcome,
        CASE WHEN win THEN secs END AS duration_seconds,
        CASE WHEN win THEN CAST(CASE WHEN secs < 5 THEN 0 ELSE coalesce(f_unlock, 0) + ((secs + 59) // 60) * coalesce(f_ppm, 0) END AS INTEGER) END AS total_amount,
        CASE WHEN win THEN c_ok END AS charge_ok, CASE WHEN win THEN u_ok END AS unhold_ok,
        o_user AS order_user_id, f_dep AS order_deposit
        FROM fb""",
    "fledger": """SELECT 'txn-clear-' || order_id AS id, order_id, order_user_id AS user_id, 'CLEAR' AS transaction_type,
            total_amount AS amount, CASE WHEN charge_ok THEN 'SUCCESS' ELSE 'FAILED' END AS status,
            '' AS external_transaction_id, CAST(NULL AS VARCHAR) AS error_message, requested_at AS created_at
        FROM finished WHERE outcome IN ('FINISHED', 'PAYMENT_FAILED')
        UNION ALL
        SELECT 'txn-refund-' || order_id, order_id, order_user_id, 'REFUND', coalesce(order_deposit, 0),
            CASE WHEN unhold_ok THEN 'SUCCESS' ELSE 'FAILED' END, '', CAST(NULL AS VARCHAR), requested_at
        FROM finished WHERE outcome IN ('FINISHED', 'PAYMENT_FAILED')""",
}

FINISH_STATUS_SQL = ("CAST(CASE outcome WHEN 'FINISHED' THEN 200 WHEN 'PAYMENT_FAILED' THEN 200 "
                     "WHEN 'ORDER_NOT_ACTIVE' THEN 409 ELSE 400 END AS INTEGER)")
_FIN_SRC = ("order_requests", "offers", "finish_requests", "payment_outcomes")

FINISH_OUTCOMES = with_standins(*_FIN_SRC, extra=_FINISH) + f"""
SELECT *, {FINISH_STATUS_SQL} AS http_status FROM finished"""

FINISH_LEDGER = with_standins(*_FIN_SRC, extra=_FINISH) + "SELECT * FROM fledger"

ORDERS_AFTER_FINISH = with_standins(*_FIN_SRC, extra=_FINISH) + """
SELECT o.id, o.user_id, o.scooter_id, o.offer_id, o.price_per_minute, o.price_unlock, o.deposit,
       CASE WHEN f.order_id IS NOT NULL THEN f.total_amount ELSE o.total_amount END AS total_amount,
       CASE WHEN f.order_id IS NOT NULL THEN f.outcome ELSE o.status END AS status,
       o.start_time, CASE WHEN f.order_id IS NOT NULL THEN f.requested_at ELSE o.finish_time END AS finish_time,
       CASE WHEN f.order_id IS NOT NULL THEN f.duration_seconds ELSE o.duration_seconds END AS duration_seconds,
       o.created_at, CASE WHEN f.order_id IS NOT NULL THEN f.requested_at ELSE o.updated_at END AS updated_at
FROM ord o LEFT JOIN (SELECT * FROM finished WHERE outcome IN ('FINISHED', 'PAYMENT_FAILED')) f ON o.id = f.order_id"""

LEDGER_ROLLUP = with_standins(*_FIN_SRC, extra={**_FINISH, "hold": _HOLD,
                                                "ledger": "SELECT * FROM hold UNION ALL SELECT * FROM fledger"}) + """
SELECT order_id,
  CAST(sum(CASE WHEN transaction_type = 'HOLD' THEN amount END) AS BIGINT) AS hold_amount,
  max(CASE WHEN transaction_type = 'HOLD' THEN status END) AS hold_status,
  CAST(sum(CASE WHEN transaction_type = 'CLEAR' THEN amount END) AS BIGINT) AS clear_amount,
  max(CASE WHEN transaction_type = 'CLEAR' THEN status END) AS clear_status,
  CAST(sum(CASE WHEN transaction_type = 'REFUND' THEN amount END) AS BIGINT) AS refund_amount,
  max(CASE WHEN transaction_type = 'REFUND' THEN status END) AS refund_status
FROM ledger GROUP BY order_id"""

RIDE_BILLING_SUMMARY = with_standins("rides") + """
SELECT status, count(*) AS rides,
  CAST(sum(CASE WHEN duration_seconds IS NULL THEN price_unlock WHEN duration_seconds < 5 THEN 0
                ELSE price_unlock + ((duration_seconds + 59) // 60) * price_per_minute END) AS BIGINT) AS billed_total,
  CAST(sum(CASE WHEN duration_seconds IS NOT NULL AND duration_seconds < 5 THEN 1 ELSE 0 END) AS BIGINT) AS short_rides
FROM rides GROUP BY status"""

def rfc3339_sql(ts: str) -> str:
    frac = f"regexp_replace(lpad(CAST(epoch_us({ts}) % 1000000 AS VARCHAR), 6, '0'), '0+$', '')"
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {frac} = '' THEN '' ELSE '.' || {frac} END || 'Z')")


def _js(c: str) -> str:
    return f"('\"' || replace(replace({c}, '\\', '\\\\'), '\"', '\\\"') || '\"')"


def order_json_sql(p: str = "") -> str:
    def opt(name, v):
        return f"CASE WHEN {v} IS NULL THEN NULL ELSE '\"{name}\":' || CAST({v} AS VARCHAR) END"

    def req(name, v):
        return f"'\"{name}\":' || coalesce({v}, 'null')"
    parts = [
        req("current_amount", f"CAST({p}current_amount AS VARCHAR)"), opt("deposit", f"{p}deposit"),
        req("duration_seconds", f"CAST({p}duration_seconds AS VARCHAR)"),
        req("finish_time", f"CASE WHEN {p}finish_time IS NOT NULL THEN {_js(rfc3339_sql(p + 'finish_time'))} END"),
        req("id", _js(f"{p}id")), req("offer_id", _js(f"{p}offer_id")),
        opt("price_per_minute", f"{p}price_per_minute"), opt("price_unlock", f"{p}price_unlock"),
        req("scooter_id", _js(f"{p}scooter_id")), req("start_time", _js(rfc3339_sql(p + "start_time"))),
        req("status", _js(f"{p}status")), req("user_id", _js(f"{p}user_id")),
    ]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


RIDES_AS_OF = "TIMESTAMP '1998-01-01 00:00:00'"
ORDER_DOC_COLS = ("id, user_id, scooter_id, offer_id, price_per_minute, price_unlock, deposit, "
                  "total_amount AS current_amount, status, start_time, finish_time, duration_seconds")

ORDER_LOOKUP = with_standins("rides", "request_log") + f"""
SELECT q.path, q.order_id AS requested_id, o.*,
       CASE WHEN coalesce(q.order_id, '') = '' THEN 'ORDER_ID_REQUIRED' WHEN o.id IS NULL THEN 'NOT_FOUND' ELSE 'FOUND' END AS outcome,
       CAST(CASE WHEN coalesce(q.order_id, '') = '' THEN 400 WHEN o.id IS NULL THEN 404 ELSE 200 END AS INTEGER) AS http_status
FROM (SELECT path, regexp_extract(path, '^/orders/([^/]+)', 1) AS order_id FROM request_log WHERE method = 'GET') q
LEFT JOIN (SELECT {ORDER_DOC_COLS} FROM rides) o ON q.order_id = o.id"""

USER_HISTORY = with_standins("rides") + """
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at, id) AS seq FROM rides
WHERE created_at >= TIMESTAMP '1996-01-01 00:00:00' AND created_at < TIMESTAMP '1997-01-01 00:00:00'"""

LATEST_ORDER_PER_OFFER = with_standins(*_FIN_SRC, extra={**_FINISH}) + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY offer_id ORDER BY created_at DESC, id DESC) AS rn
FROM ord) WHERE rn = 1"""

EXPIRED_ORDERS = with_standins("rides") + f"""
SELECT {ORDER_DOC_COLS}, created_at FROM rides WHERE created_at < {RIDES_AS_OF} - INTERVAL 24 HOUR"""

CLEANUP_AUDIT_LOG = with_standins("rides", extra={
    "exp": f"SELECT {ORDER_DOC_COLS} FROM rides WHERE created_at < {RIDES_AS_OF} - INTERVAL 24 HOUR",
    "doc": f"SELECT *, {order_json_sql()} AS order_data FROM exp"}) + f"""
SELECT 'order_deleted' AS event, id AS order_id, user_id, status, order_data,
  '{{"level":"info","event":"order_deleted","order_id":' || {_js('id')} || ',"user_id":' || {_js('user_id')}
  || ',"status":' || {_js('status')} || ',"order_data":' || order_data || ',"time":"1998-01-01T00:00:00Z"'
  || ',"message":"Deleting old order"}}' AS log_line
FROM doc"""

_WORLD = {**_FINISH, "hold": _HOLD,
          "ledger": "SELECT * FROM hold UNION ALL SELECT * FROM fledger",
          "snap": """SELECT o.id, o.user_id, o.scooter_id, o.offer_id, o.price_per_minute, o.price_unlock, o.deposit,
       CASE WHEN f.order_id IS NOT NULL THEN f.total_amount ELSE o.total_amount END AS total_amount,
       CASE WHEN f.order_id IS NOT NULL THEN f.outcome ELSE o.status END AS status,
       o.start_time, CASE WHEN f.order_id IS NOT NULL THEN f.requested_at ELSE o.finish_time END AS finish_time,
       CASE WHEN f.order_id IS NOT NULL THEN f.duration_seconds ELSE o.duration_seconds END AS duration_seconds,
       o.created_at, CASE WHEN f.order_id IS NOT NULL THEN f.requested_at ELSE o.updated_at END AS updated_at
       FROM ord o LEFT JOIN (SELECT * FROM finished WHERE outcome IN ('FINISHED', 'PAYMENT_FAILED')) f ON o.id = f.order_id""",
          "gone": f"SELECT id FROM snap WHERE created_at < {RIDES_AS_OF} - INTERVAL 24 HOUR"}

CLEANUP_SUMMARY = with_standins(*_FIN_SRC, extra=_WORLD) + f"""
SELECT {RIDES_AS_OF} AS as_of, 24 AS older_than_hours,
  (SELECT count(*) FROM gone) AS orders_deleted,
  (SELECT count(*) FROM ledger WHERE order_id IN (SELECT id FROM gone)) AS ledger_rows_deleted,
  CASE WHEN (SELECT count(*) FROM gone) = 0 THEN 'NO_OLD_ORDERS' ELSE 'DELETED' END AS result"""

ORDERS_AFTER_CLEANUP = with_standins(*_FIN_SRC, extra=_WORLD) + """
SELECT * FROM snap WHERE id NOT IN (SELECT id FROM gone)"""

LEDGER_AFTER_CLEANUP = with_standins(*_FIN_SRC, extra=_WORLD) + """
SELECT * FROM ledger WHERE order_id NOT IN (SELECT id FROM gone)"""

CASCADE_ORPHANS = with_standins(*_FIN_SRC, extra=_WORLD) + """
SELECT * FROM ledger WHERE order_id NOT IN (SELECT id FROM snap WHERE id NOT IN (SELECT id FROM gone))"""

RIDE_STATUS_VIEW = with_standins("rides", "scooters") + """
SELECT r.id, r.user_id, r.scooter_id, r.start_time, s.charge AS scooter_charge,
  CAST(greatest(0, (epoch_us(TIMESTAMP '2001-09-01 00:00:00') - epoch_us(r.start_time)) // 1000000) AS INTEGER) AS elapsed_seconds,
  CAST(CASE WHEN greatest(0, (epoch_us(TIMESTAMP '2001-09-01 00:00:00') - epoch_us(r.start_time)) // 1000000) < 5 THEN 0
       ELSE r.price_unlock + ((greatest(0, (epoch_us(TIMESTAMP '2001-09-01 00:00:00') - epoch_us(r.start_time)) // 1000000) + 59) // 60)
            * r.price_per_minute END AS INTEGER) AS running_cost
FROM rides r LEFT JOIN scooters s ON r.scooter_id = s.id WHERE r.status = 'ACTIVE'"""

ORDER_SHARD_MAP = with_standins("rides") + """
SELECT id AS order_id, user_id, CAST(('0x' || substr(md5(user_id), 1, 8))::BIGINT % 64 AS INTEGER) AS shard FROM rides"""

ROUTE_SQL = """CASE WHEN method = 'POST' AND path = '/offers' THEN 'create_offer'
  WHEN method = 'POST' AND path = '/orders' THEN 'create_order'
  WHEN method = 'GET' AND regexp_matches(path, '^/orders/[^/]+$') THEN 'get_order'
  WHEN method = 'POST' AND regexp_matches(path, '^/orders/[^/]+/finish$') THEN 'finish_order' ELSE 'other' END"""

LOG_DROP_COUNTS = with_standins("request_log") + """
SELECT CASE WHEN event = 'request_complete' THEN 'kept' ELSE 'not_request_complete' END AS reason, count(*) AS lines
FROM request_log GROUP BY 1"""

_PANEL_TAGGED = {"rc": "SELECT * FROM request_log WHERE event = 'request_complete'",
  "tagged": """SELECT 'total' AS panel, ts FROM rc
    UNION ALL SELECT 'offers', ts FROM rc WHERE path LIKE '%/offers%'
    UNION ALL SELECT 'orders_post', ts FROM rc WHERE path LIKE '%/orders%' AND method = 'POST'
    UNION ALL SELECT 'orders_get', ts FROM rc WHERE path LIKE '%/orders/%' AND method = 'GET'
    UNION ALL SELECT 'finish', ts FROM rc WHERE path LIKE '%/orders/%' AND path LIKE '%finish%' AND method = 'POST'"""}

PANEL_RPS = with_standins("request_log", extra=_PANEL_TAGGED) + """
SELECT panel, date_trunc('minute', ts) AS minute, count(*) / 60.0 AS rps FROM tagged GROUP BY 1, 2"""

# Lines of the first quarter of the time span with a delayed arrival come after
# their minute closed; minutes closed end ten minutes before the newest line.
_DELAYED = {
  "span": "SELECT min(ts) AS lo, max(ts) AS hi FROM events",
  "rc": """SELECT l.*, l.event_id % 97 = 5 AND l.ts < lo + to_microseconds((epoch_us(hi) - epoch_us(lo)) // 4) AS late
    FROM request_log l, span WHERE event = 'request_complete'""",
  "tagged": _PANEL_TAGGED["tagged"].replace("AS panel, ts", "AS panel, ts, late").replace(
    "', ts FROM", "', ts, late FROM")}

STREAM_PANEL_WINDOWS = with_standins("request_log", extra=_DELAYED) + """
SELECT panel, date_trunc('minute', ts) AS minute, count(*) FILTER (NOT late) / 60.0 AS rps,
  count(*) FILTER (late) AS late_lines
FROM tagged GROUP BY 1, 2
HAVING date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM tagged)"""

PANEL_TRAILING_RPS = with_standins("request_log", extra={**_PANEL_TAGGED,
  "steps": "SELECT panel, make_timestamp(((epoch_us(ts) + 14999999) // 15000000 + k) * 15000000) AS instant "
           "FROM tagged, (VALUES (0), (1), (2), (3)) t(k)"}) + """
SELECT panel, instant, count(*) / 60.0 AS rps FROM steps GROUP BY 1, 2"""

ENDPOINT_LATENCY = with_standins("request_log") + f"""
SELECT {ROUTE_SQL} AS route,
  round(quantile_cont(duration_ms, 0.5), 6) AS p50, round(quantile_cont(duration_ms, 0.95), 6) AS p95,
  round(quantile_cont(duration_ms, 0.99), 6) AS p99
FROM request_log WHERE event = 'request_complete' GROUP BY 1"""

ENDPOINT_ERROR_RATE = with_standins("request_log") + f"""
SELECT {ROUTE_SQL} AS route, count(*) AS requests, CAST(sum(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
  CAST(sum(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS error_rate
FROM request_log WHERE event = 'request_complete' GROUP BY 1"""

ERROR_RATE_ALERTS = with_standins("request_log", extra={"pm": """SELECT date_trunc('minute', ts) AS minute, count(*) AS requests,
    CAST(sum(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
    CAST(sum(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS error_rate
    FROM request_log WHERE event = 'request_complete' GROUP BY 1""",
  "lagged": """SELECT *, lag(minute) OVER (ORDER BY minute) AS pmin, lag(error_rate) OVER (ORDER BY minute) AS prate FROM pm"""}) + """
SELECT minute, requests, errors, error_rate FROM lagged
WHERE error_rate > 0.05 AND prate > 0.05 AND pmin = minute - INTERVAL 1 MINUTE"""

LOG_TAIL = with_standins("request_log") + """
SELECT ts, method, path, status_code, duration_ms, event_id FROM request_log WHERE event = 'request_complete'
ORDER BY ts DESC, event_id DESC LIMIT 1000"""

REQUEST_COMPLETE_RECORDS = with_standins("request_log") + f"""
SELECT ts, method, path, status_code, duration_ms, {ROUTE_SQL} AS route,
  CASE WHEN status_code >= 400 THEN 'error' ELSE 'info' END AS level,
  CASE WHEN status_code >= 500 THEN 'HTTP request failed' WHEN status_code >= 400 THEN 'HTTP request client error'
       ELSE 'HTTP request completed' END AS message,
  CASE WHEN status_code >= 400 THEN status_code END AS error_code,
  nullif(regexp_extract(path, '^/orders/([^/]+)', 1), '') AS path_order_id, user_id
FROM request_log WHERE event = 'request_complete'"""

CONTAINER_LOG_RECORDS = with_standins("request_log") + """
SELECT ts, CASE WHEN status_code >= 400 THEN 'stderr' ELSE 'stdout' END AS stream, method, path, status_code,
  duration_ms, user_id
FROM request_log WHERE event = 'request_complete' AND event_id % 19 <> 0"""

DAILY_LOG_READBACK = with_standins("request_log") + """
SELECT strftime(ts, '%Y-%m-%d') AS day, ts, event_id, method, path, status_code FROM request_log"""

def _violations(table: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS rule, CAST(coalesce(sum(CASE WHEN {v} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations FROM {table}"
        for k, v in checks.items())


def _dups(table: str, key: str, name: str) -> str:
    return (f"SELECT '{name}' AS rule, (SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} "
            f"HAVING count(*) > 1)) AS violations")


_ORDER_NN = ["id", "user_id", "scooter_id", "offer_id", "price_per_minute", "price_unlock", "deposit",
             "total_amount", "status", "start_time", "created_at", "updated_at"]
_TXN_NN = ["id", "order_id", "user_id", "transaction_type", "amount", "status", "created_at"]
_ORDER_LEN = {"id": 255, "user_id": 255, "scooter_id": 255, "offer_id": 255, "status": 50}
_TXN_LEN = {"id": 255, "order_id": 255, "user_id": 255, "transaction_type": 50, "status": 50,
            "external_transaction_id": 255}

CONSTRAINT_VIOLATIONS = with_standins(*_FIN_SRC, extra=_WORLD) + " UNION ALL ".join([
    _violations("snap", {**{f"orders.{c}.not_null": f"{c} IS NULL" for c in _ORDER_NN},
                         **{f"orders.{c}.length": f"length({c}) > {n}" for c, n in _ORDER_LEN.items()},
                         "orders.status.domain": "status NOT IN ('ACTIVE', 'FINISHED', 'CANCELLED', 'PAYMENT_FAILED')"}),
    _dups("snap", "id", "orders.id.unique"),
    _violations("ledger", {**{f"ledger.{c}.not_null": f"{c} IS NULL" for c in _TXN_NN},
                           **{f"ledger.{c}.length": f"length({c}) > {n}" for c, n in _TXN_LEN.items()},
                           "ledger.transaction_type.domain": "transaction_type NOT IN ('HOLD', 'CLEAR', 'REFUND')",
                           "ledger.status.domain": "status NOT IN ('SUCCESS', 'FAILED', 'PENDING')"}),
    _dups("ledger", "id", "ledger.id.unique")])

_SAVED = """SELECT offer_id AS id, user_id, scooter_id, zone_id, price_per_minute, price_unlock, deposit,
    requested_at AS created_at, expires_at FROM offer_out WHERE is_new_offer"""

OFFER_CONTRACT_CHECKS = with_standins("users", "zones", "scooters", "offer_requests",
                                      extra={**_CREATION, "saved": _SAVED}, recursive=True) + " UNION ALL ".join([
    _violations("saved", {**{f"offer.{c}.required": f"{c} IS NULL" for c in
                             ["id", "user_id", "scooter_id", "zone_id", "price_per_minute", "price_unlock",
                              "deposit", "expires_at"]},
                          **{f"offer.{c}.non_negative": f"{c} < 0" for c in
                             ("price_per_minute", "price_unlock", "deposit")},
                          "offer.ttl": "abs(date_diff('second', created_at, expires_at) - 300) > 10"}),
    _dups("saved", "id", "offer.id.unique")])

ORDER_CONTRACT_CHECKS = with_standins(*_FIN_SRC, extra={**_WORLD, "oj": """SELECT s.*, o.id AS of_id,
    o.price_per_minute AS of_ppm, o.price_unlock AS of_unlock, o.deposit AS of_dep
    FROM snap s LEFT JOIN offers o ON s.offer_id = o.id"""}) + " UNION ALL ".join([
    _violations("oj", {
        "order.status.valid": "status NOT IN ('ACTIVE', 'FINISHED', 'CANCELLED', 'PAYMENT_FAILED')",
        "order.finished.fields": "status IN ('FINISHED', 'PAYMENT_FAILED') AND (finish_time IS NULL OR duration_seconds IS NULL)",
        "order.finished.total": """status IN ('FINISHED', 'PAYMENT_FAILED') AND total_amount <> CAST(CASE WHEN duration_seconds < 5 THEN 0
            ELSE coalesce(price_unlock, 0) + ((duration_seconds + 59) // 60) * coalesce(price_per_minute, 0) END AS INTEGER)""",
        "order.prices_match_offer": "of_id IS NOT NULL AND (price_per_minute <> of_ppm OR price_unlock <> of_unlock OR deposit <> of_dep)"}),
    _dups("snap", "offer_id", "order.one_per_offer")])

LEDGER_INVARIANTS = with_standins(*_FIN_SRC, extra=_WORLD) + """
SELECT 'hold_without_order' AS rule, (SELECT count(*) FROM ledger WHERE transaction_type = 'HOLD' AND status = 'SUCCESS'
    AND order_id NOT IN (SELECT id FROM snap)) AS violations
UNION ALL SELECT 'charged_twice', (SELECT count(*) FROM (SELECT order_id FROM ledger WHERE transaction_type = 'CLEAR'
    AND status = 'SUCCESS' GROUP BY order_id HAVING count(*) > 1))
UNION ALL SELECT 'finished_without_refund', (SELECT count(*) FROM snap WHERE status = 'FINISHED' AND id NOT IN
    (SELECT order_id FROM ledger WHERE transaction_type = 'REFUND' AND status = 'SUCCESS'))"""

SCENARIO_REPORT = with_standins("order_requests", "offers", extra=_ADMISSION) + """
SELECT CAST(sum(CASE WHEN outcome = 'CREATED' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
  CAST(sum(CASE WHEN outcome <> 'CREATED' THEN 1 ELSE 0 END) AS BIGINT) AS failures, count(*) AS total,
  round(count(*) * 1e6 / CAST(epoch_us(max(requested_at)) - epoch_us(min(requested_at)) AS DOUBLE), 6) AS throughput_per_sec,
  round(coalesce(sum(CASE WHEN outcome = 'CREATED' THEN 1 ELSE 0 END) * 100.0 / count(*), 0.0), 6) AS success_pct
FROM admitted"""

PER_USER_OUTCOMES = with_standins("order_requests", "offers", extra=_ADMISSION) + """
SELECT user_id, CAST(sum(CASE WHEN outcome = 'CREATED' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
  CAST(sum(CASE WHEN outcome <> 'CREATED' THEN 1 ELSE 0 END) AS BIGINT) AS failures
FROM admitted GROUP BY user_id"""

BUSINESS_COUNTERS = with_standins("users", "zones", "scooters", "offer_requests", *_FIN_SRC,
                                  extra={**_CREATION, **_WORLD}, recursive=True) + """
SELECT (SELECT count(*) FROM offer_out WHERE is_new_offer) AS offers_created,
  (SELECT count(*) FROM admitted WHERE outcome = 'CREATED') AS orders_created,
  (SELECT count(*) FROM snap WHERE status = 'ACTIVE') AS active_rides,
  (SELECT count(*) FROM admitted WHERE outcome = 'PAYMENT_HOLD_FAILED') + (SELECT count(*) FROM snap WHERE status = 'PAYMENT_FAILED') AS payment_errors,
  (SELECT CAST(coalesce(sum(amount), 0) AS BIGINT) FROM ledger WHERE transaction_type = 'CLEAR' AND status = 'SUCCESS') AS revenue"""

CONVERSION_RATE = with_standins("order_requests", "offers", extra={**_ADMISSION, "ord": _ORD}) + """
SELECT count(*) AS offers, count(u.offer_id) AS converted, CAST(count(u.offer_id) AS DOUBLE) / count(*) AS conversion_rate
FROM (SELECT DISTINCT id FROM offers) o LEFT JOIN (SELECT DISTINCT offer_id FROM ord) u ON o.id = u.offer_id"""

_CACHE = {
    **_FINISH,
    "ev0": f"""SELECT order_id, requested_at AS ts, {TB}, 0 AS kind FROM admitted WHERE outcome = 'CREATED'
        UNION ALL SELECT order_id, requested_at, {TB}, 1 FROM finished WHERE outcome IN ('FINISHED', 'PAYMENT_FAILED')
        UNION ALL SELECT order_id, ts, {TB}, 2 FROM order_reads""",
    "ev": """SELECT e.*, o.id IS NOT NULL AND o.created_at <= e.ts AS ex, e.kind < 2 AS forced
        FROM ev0 e LEFT JOIN ord o ON e.order_id = o.id""",
    **chain_ctes("cch", "ev WHERE forced OR (kind = 2 AND ex)", ["order_id"], "ts",
                 ["kind", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"],
                 1800, force="forced"),
    "cflag": f"""SELECT e.*, coalesce(c._is_anchor, false) AS is_anchor,
        max(CASE WHEN c._is_anchor THEN e.ts END) OVER (PARTITION BY e.order_id ORDER BY e.ts, e.kind, {', '.join('e.' + c for c in TB.split(', '))}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor_ts
        FROM ev e LEFT JOIN cch c ON e.order_id = c.order_id AND e.kind = c.kind AND e.ts = c.ts
          AND e.l_orderkey = c.l_orderkey AND e.l_linenumber = c.l_linenumber AND e.l_partkey = c.l_partkey
          AND e.l_suppkey = c.l_suppkey AND e.l_extendedprice = c.l_extendedprice AND e.l_shipdate = c.l_shipdate""",
    "replay": f"""SELECT order_id, ts, {TB}, CASE WHEN NOT ex THEN 'ABSENT' WHEN is_anchor THEN 'MISS'
        WHEN anchor_ts IS NOT NULL AND ts < anchor_ts + INTERVAL 1800 SECOND THEN 'HIT' ELSE 'MISS' END AS cache_result
        FROM cflag WHERE kind = 2""",
}
_CACHE_SRC = _FIN_SRC + ("order_reads",)

ORDER_CACHE_REPLAY = with_standins(*_CACHE_SRC, extra=_CACHE, recursive=True) + "SELECT * FROM replay"

CACHE_HIT_RATE = with_standins(*_CACHE_SRC, extra=_CACHE, recursive=True) + """
SELECT count(*) AS reads, CAST(sum(CASE WHEN cache_result = 'HIT' THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  CAST(sum(CASE WHEN cache_result = 'HIT' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS hit_rate FROM replay"""

CACHE_HIT_RATE_ALERT = f"SELECT * FROM ({CACHE_HIT_RATE}) WHERE hit_rate < 0.9"

_ARCH_ORDER_COLS = ("id, user_id, scooter_id, offer_id, price_per_minute, price_unlock, deposit, total_amount, status, "
                    "start_time, finish_time, duration_seconds, created_at, updated_at")
_LEDGER_ONLY = "order_id, transaction_type, amount, external_transaction_id, error_message"


def _archive_union(orders: str, ledger: str) -> str:
    return f"""SELECT 'order' AS type, {_ARCH_ORDER_COLS}, CAST(NULL AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS transaction_type,
        CAST(NULL AS INTEGER) AS amount, CAST(NULL AS VARCHAR) AS external_transaction_id, CAST(NULL AS VARCHAR) AS error_message,
        created_at AS order_created_at FROM {orders}
      UNION ALL
      SELECT 'transaction', l.id, l.user_id, NULL, NULL, NULL, NULL, NULL, NULL, l.status, NULL, NULL, NULL, l.created_at, NULL,
        l.order_id, l.transaction_type, l.amount, l.external_transaction_id, l.error_message, o.created_at
      FROM {ledger} l JOIN {orders} o ON l.order_id = o.id"""


def _hour_cols(c: str) -> str:
    return (f"strftime({c}, '%Y') AS yyyy, strftime({c}, '%m') AS mm, strftime({c}, '%d') AS dd, "
            f"strftime({c}, '%H') AS hh")


ARCHIVE_RECORDS = with_standins(*_FIN_SRC, extra={**_WORLD, "arch": _archive_union("snap", "ledger")}) + f"""
SELECT *, {_hour_cols('order_created_at')} FROM arch"""

_HIST = {**_WORLD,
         "hot_o": "SELECT * FROM snap WHERE id NOT IN (SELECT id FROM gone)",
         "hot_l": "SELECT * FROM ledger WHERE order_id NOT IN (SELECT id FROM gone)",
         "cold": _archive_union("(SELECT * FROM snap WHERE id IN (SELECT id FROM gone))", "ledger"),
         "h_o": f"""SELECT {_ARCH_ORDER_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY hot DESC) AS rn FROM (
             SELECT {_ARCH_ORDER_COLS}, 1 AS hot FROM hot_o UNION ALL SELECT {_ARCH_ORDER_COLS}, 0 FROM cold WHERE type = 'order')
             WHERE created_at >= TIMESTAMP '1997-06-01 00:00:00' AND created_at < TIMESTAMP '1998-01-01 00:00:00') WHERE rn = 1""",
         "h_l": """SELECT id, order_id, user_id, transaction_type, amount, status, external_transaction_id, error_message, created_at
             FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY hot DESC) AS rn FROM (
             SELECT *, 1 AS hot FROM hot_l UNION ALL
             SELECT id, order_id, user_id, transaction_type, amount, status, external_transaction_id, error_message, created_at, 0
             FROM cold WHERE type = 'transaction') WHERE order_id IN (SELECT id FROM h_o)) WHERE rn = 1"""}

HOT_COLD_HISTORY = with_standins(*_FIN_SRC, extra=_HIST) + f"""
SELECT 'order' AS type, {_ARCH_ORDER_COLS}, CAST(NULL AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS transaction_type,
  CAST(NULL AS INTEGER) AS amount, CAST(NULL AS VARCHAR) AS external_transaction_id, CAST(NULL AS VARCHAR) AS error_message FROM h_o
UNION ALL
SELECT 'transaction', id, user_id, NULL, NULL, NULL, NULL, NULL, NULL, status, NULL, NULL, NULL, created_at, NULL,
  order_id, transaction_type, amount, external_transaction_id, error_message FROM h_l"""

PAYMENT_RETRY_WORKLIST = with_standins(*_FIN_SRC, extra=_WORLD) + """
SELECT id AS order_id, user_id, 'CLEAR' AS retry_op, total_amount AS amount FROM snap
WHERE status = 'PAYMENT_FAILED' AND id NOT IN (SELECT order_id FROM ledger WHERE transaction_type = 'CLEAR' AND status = 'SUCCESS')
UNION ALL
SELECT id, user_id, 'REFUND', deposit FROM snap
WHERE status = 'PAYMENT_FAILED' AND id NOT IN (SELECT order_id FROM ledger WHERE transaction_type = 'CLEAR' AND status = 'SUCCESS')"""

STREAM_ORDER_INTAKE = with_standins("order_requests") + f"""
SELECT order_id, offer_id, user_id, requested_at, hold_success, {TB} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY requested_at, {TB}) AS n FROM order_requests)
WHERE n = 1 OR order_id = ''"""

_TWICE = """SELECT * FROM once UNION ALL SELECT request_id || '-again', user_id, scooter_id, ts FROM once
    WHERE CAST(regexp_extract(request_id, '([0-9]+)$', 1) AS BIGINT) % 5 = 0"""

_REPEATED = {"once": STANDINS["offer_requests"], "offer_requests": _TWICE, **_CREATION}

OFFER_CREATION_REPEATED_LOG = with_standins("users", "zones", "scooters", extra=_REPEATED, recursive=True) + f"""
SELECT *, {OFFER_STATUS_SQL} AS http_status FROM offer_out"""

OFFER_CREATION_MIN_REMAINING = with_standins("users", "zones", "scooters", extra={
    k: _REPEATED[k] for k in ("once", "offer_requests", "cfg", "priced")}) + f"""
SELECT request_id, user_id, scooter_id, ts AS requested_at, outcome, {OFFER_STATUS_SQL} AS http_status,
  CASE WHEN outcome = 'CREATED' THEN zone_id END AS zone_id, CASE WHEN outcome = 'CREATED' THEN ppm END AS price_per_minute,
  CASE WHEN outcome = 'CREATED' THEN unlock END AS price_unlock, CASE WHEN outcome = 'CREATED' THEN dep END AS deposit,
  CASE WHEN outcome = 'CREATED' THEN sha256(user_id || ':' || scooter_id || ':' || CAST(epoch_us(ts) AS VARCHAR)) END AS offer_id,
  CASE WHEN outcome = 'CREATED' THEN ts + INTERVAL 300 SECOND END AS expires_at,
  outcome = 'CREATED' AS is_new_offer, zone_id AS lookup_zone_id
FROM priced"""

# Offers reusable for five days, or one where claimed.
_CLAIMED = {
    "cfg": CONFIG, "priced": PRICED_REQUESTS,
    "elig": """SELECT user_id, scooter_id, request_id, ts,
        ts + to_hours(CASE WHEN CAST(regexp_extract(request_id, '([0-9]+)$', 1) AS BIGINT) % 2 = 0 THEN 24 ELSE 120 END) AS fin,
        row_number() OVER (PARTITION BY user_id, scooter_id ORDER BY ts, request_id) AS rn
      FROM priced WHERE outcome = 'CREATED'""",
    "chain": """SELECT user_id, scooter_id, request_id, rn, ts AS a_ts, fin AS a_fin, true AS is_anchor FROM elig WHERE rn = 1
      UNION ALL
      SELECT e.user_id, e.scooter_id, e.request_id, e.rn, CASE WHEN e.ts >= c.a_fin THEN e.ts ELSE c.a_ts END,
        CASE WHEN e.ts >= c.a_fin THEN e.fin ELSE c.a_fin END, e.ts >= c.a_fin
      FROM chain c JOIN elig e ON e.user_id = c.user_id AND e.scooter_id = c.scooter_id AND e.rn = c.rn + 1""",
    "flagged": """SELECT p.*, coalesce(c.is_anchor, false) AS is_anchor, c.a_fin FROM priced p
      LEFT JOIN chain c ON p.request_id = c.request_id""",
    "cov": """SELECT *, max(CASE WHEN is_anchor THEN ts END) OVER (PARTITION BY user_id, scooter_id ORDER BY ts, request_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor_ts FROM flagged""",
    "created": """SELECT c.*, (c.outcome NOT IN ('INVALID_BODY', 'USER_ID_REQUIRED', 'SCOOTER_ID_REQUIRED')
        AND c.anchor_ts IS NOT NULL AND c.ts < a.a_fin AND NOT c.is_anchor) AS reused,
        a.zone_id AS a_zone, a.ppm AS a_ppm, a.unlock AS a_unlock, a.dep AS a_dep
      FROM cov c LEFT JOIN (SELECT * FROM flagged WHERE is_anchor) a
        ON c.user_id = a.user_id AND c.scooter_id = a.scooter_id AND c.anchor_ts = a.ts""",
    "offer_out": _CREATION["offer_out"]}

OFFER_CREATION_CLAIMS = with_standins("users", "zones", "scooters", "offer_requests", extra=_CLAIMED, recursive=True) + f"""
SELECT *, {OFFER_STATUS_SQL} AS http_status FROM offer_out"""

LIVE_OFFERS_AT_REQUESTS = with_standins("users", "zones", "scooters", "offer_requests", extra={
    **_CREATION,
    "saved": """SELECT user_id, offer_id, requested_at AS created_at,
        requested_at + to_microseconds(60000000000::BIGINT * price_per_minute) AS alive_until
      FROM offer_out WHERE is_new_offer""",
    "met": """SELECT r.request_id, s.offer_id, s.created_at, s.alive_until FROM offer_requests r JOIN saved s
      ON r.user_id = s.user_id AND s.created_at <= r.ts AND r.ts < s.alive_until""",
    "best": """SELECT request_id, count(*) OVER (PARTITION BY request_id) AS n_live, offer_id, created_at, alive_until FROM met
      QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY created_at DESC, offer_id DESC) = 1"""}, recursive=True) + """
SELECT r.request_id, r.user_id, r.ts, coalesce(b.n_live, 0) AS n_live, b.offer_id AS latest_offer_id,
  b.created_at AS latest_created_at, b.alive_until AS latest_alive_until
FROM offer_requests r LEFT JOIN best b USING (request_id)"""

LATENCY_SKETCHES = with_standins("request_log") + f"""
SELECT {ROUTE_SQL} AS route, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS requests,
  true AS p50_within, true AS p95_within, true AS p99_within
FROM request_log WHERE event = 'request_complete' GROUP BY 1, 2"""

ORDERS_WITH_LEDGER_BUCKETED = with_standins(*_FIN_SRC, extra={**_WORLD}) + """
SELECT s.id, s.user_id, s.status, s.total_amount, count(l.id) AS n_rows,
  CAST(coalesce(sum(l.amount), 0) AS BIGINT) AS ledger_amount
FROM snap s LEFT JOIN ledger l ON l.order_id = s.id GROUP BY ALL"""

ORDER_LOOKUP_SHARDED = with_standins("rides", "request_log") + """
SELECT r.*, CAST(('0x' || substr(md5(r.user_id), 1, 8))::BIGINT % 64 AS INTEGER) AS shard FROM rides r
WHERE r.id IN (SELECT regexp_extract(path, '^/orders/([^/]+)', 1) FROM request_log WHERE method = 'GET')"""

ARCHIVE_READBACK = with_standins(*_FIN_SRC, extra={**_WORLD, "old": f"""SELECT * FROM snap
    WHERE created_at < {RIDES_AS_OF} - INTERVAL 24 HOUR""", "arch": _archive_union("old", "ledger")}) + f"""
SELECT *, {_hour_cols('order_created_at')} FROM arch"""

OFFER_SAVES = with_standins("users", "zones", "scooters", "offer_requests", extra=_CREATION, recursive=True) + """
SELECT offer_id AS id, user_id, scooter_id, zone_id, price_per_minute, price_unlock, deposit, requested_at AS created_at,
  expires_at, CASE WHEN requested_at <= expires_at THEN CAST(greatest(date_diff('second', requested_at, expires_at), 1) AS BIGINT) END AS ttl_seconds,
  CASE WHEN requested_at > expires_at THEN 'EXPIRED' ELSE 'SAVED' END AS save_result
FROM offer_out WHERE is_new_offer"""

OFFER_PRICING_VERSIONED = with_standins("users", "scooters", "offer_requests", "zone_fetches", "config_polls", extra={
    "rq": """SELECT r.*, s.id AS s_id, s.zone_id, s.charge, u.has_subscription, u.trusted
        FROM offer_requests r LEFT JOIN scooters s ON r.scooter_id = s.id LEFT JOIN users u ON r.user_id = u.id""",
    "zq": """SELECT rq.*, f.fetched_at, f.price_per_minute AS zppm, f.price_unlock AS zunlock, f.default_deposit AS zdep
        FROM rq ASOF LEFT JOIN (SELECT * FROM zone_fetches WHERE success) f ON rq.zone_id = f.zone_id AND rq.ts >= f.fetched_at""",
    "cq": """SELECT zq.*, coalesce(c.surge, 1.2) AS surge, coalesce(c.low_charge_discount, 0.7) AS disc,
            coalesce(c.low_charge_threshold_percent, 28) AS thr
        FROM zq ASOF LEFT JOIN (SELECT * FROM config_polls WHERE success) c ON zq.ts >= c.polled_at""",
    "pq": """SELECT *, CASE WHEN coalesce(user_id, '') = '' THEN 'USER_ID_REQUIRED'
            WHEN coalesce(scooter_id, '') = '' THEN 'SCOOTER_ID_REQUIRED' WHEN s_id IS NULL THEN 'SCOOTER_NOT_FOUND'
            WHEN fetched_at IS NULL OR ts >= fetched_at + INTERVAL 600 SECOND THEN 'ZONE_UNAVAILABLE' ELSE 'CREATED' END AS outcome
        FROM cq"""}) + f"""
SELECT request_id, user_id, scooter_id, ts AS requested_at, outcome, {OFFER_STATUS_SQL} AS http_status,
  CASE WHEN outcome = 'CREATED' THEN zone_id END AS zone_id,
  CASE WHEN outcome = 'CREATED' THEN greatest(CAST(round(CASE WHEN charge >= 0 AND thr > 0 AND charge < thr
      THEN (CAST(zppm AS DOUBLE) * (CASE WHEN surge <= 0 THEN 1.0 ELSE surge END)) * (CASE WHEN disc <= 0 THEN 1.0 ELSE disc END)
      ELSE CAST(zppm AS DOUBLE) * (CASE WHEN surge <= 0 THEN 1.0 ELSE surge END) END) AS INTEGER), 0) END AS price_per_minute,
  CASE WHEN outcome = 'CREATED' THEN CAST(greatest(CASE WHEN coalesce(has_subscription, false) THEN 0 ELSE zunlock END, 0) AS INTEGER) END AS price_unlock,
  CASE WHEN outcome = 'CREATED' THEN CAST(greatest(CASE WHEN coalesce(trusted, false) THEN 0 ELSE zdep END, 0) AS INTEGER) END AS deposit,
  CASE WHEN outcome = 'CREATED' THEN fetched_at END AS tariff_fetched_at,
  CASE WHEN outcome = 'CREATED' THEN surge END AS surge
FROM pq"""

def _jk(body: str, key: str) -> str:
    return (f"CASE WHEN json_valid({body}) AND json_type({body}, '$.{key}') = 'VARCHAR' "
            f"THEN nullif(json_extract_string({body}, '$.{key}'), '') END")


def _cut(body: str, most: int) -> str:
    """The longest character prefix within ``most`` bytes, U+FFFD for each
    byte left of a divided character, and the marker."""
    whole = f"list_max(list_filter(range(0, {most} + 1), lambda x: strlen(left({body}, x)) <= {most}))"
    return (f"CASE WHEN strlen({body}) > {most} THEN left({body}, {whole}) "
            f"|| repeat('\ufffd', CAST({most} - strlen(left({body}, {whole})) AS INTEGER)) || '...(truncated)' ELSE {body} END")


REQUEST_RECORDS_ENRICHED = with_standins("request_log", extra={"k": f"""SELECT *,
    {_jk('request_body', 'user_id')} AS rq_user, {_jk('request_body', 'order_id')} AS rq_order,
    {_jk('request_body', 'offer_id')} AS rq_offer, {_jk('request_body', 'scooter_id')} AS rq_scooter,
    {_jk('response_body', 'id')} AS rs_id, {_jk('response_body', 'order_id')} AS rs_oid,
    CASE WHEN json_valid(response_body) THEN json_exists(response_body, '$.expires_at') END AS rs_offer,
    {_jk('response_body', 'user_id')} AS rs_user, {_jk('response_body', 'status')} AS rs_status
    FROM request_log WHERE event = 'request_complete'"""}) + f"""
SELECT event_id,
  coalesce(rs_user, rq_user) AS user_id,
  coalesce(CASE WHEN rs_id IS NOT NULL THEN CASE WHEN rs_oid IS NOT NULL THEN rs_oid WHEN NOT rs_offer THEN rs_id END END, rq_order) AS order_id,
  coalesce(CASE WHEN rs_id IS NOT NULL AND rs_oid IS NULL AND rs_offer THEN rs_id END, rq_offer) AS offer_id,
  rq_scooter AS scooter_id, rs_status AS order_status,
  CASE WHEN status_code >= 400 THEN 'error' ELSE 'info' END AS level,
  CASE WHEN status_code >= 500 THEN 'HTTP request failed' WHEN status_code >= 400 THEN 'HTTP request client error'
       ELSE 'HTTP request completed' END AS message,
  CASE WHEN status_code >= 400 THEN status_code END AS error_code,
  CASE WHEN status_code >= 400 THEN {_cut('response_body', 500)} END AS error_response,
  {_cut('request_body', 1000)} AS request_body_logged,
  duration_ns / 1e6 AS duration_ms
FROM k"""

MINUTE_LATENCY_P99 = with_standins("request_log") + """
SELECT minute, round(p99, 6) AS p99, p99 > 1000.0 AS alert FROM (
  SELECT date_trunc('minute', ts) AS minute, quantile_cont(duration_ms, 0.99) AS p99
  FROM request_log WHERE event = 'request_complete' GROUP BY 1)"""

ROUTE_RPS = with_standins("request_log") + f"""
SELECT {ROUTE_SQL} AS route, date_trunc('minute', ts) AS minute, count(*) / 60.0 AS rps
FROM request_log WHERE event = 'request_complete' GROUP BY 1, 2"""

TRAILING_REQUESTS_15M = with_standins("request_log") + f"""
SELECT ts, event_id, method, path, status_code, {ROUTE_SQL} AS route FROM request_log
WHERE event = 'request_complete' AND ts >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 15 MINUTE
  AND ts <= TIMESTAMP '2024-01-15 12:00:00'"""

OFFER_PRICING_DEGRADED = OFFER_PRICING.replace(
    "WHEN s.id IS NULL THEN 'SCOOTER_NOT_FOUND'",
    "WHEN CAST(regexp_extract(r.request_id, '([0-9]+)$', 1) AS BIGINT) % 13 = 0 THEN 'SCOOTERS_UNAVAILABLE' "
    "WHEN s.id IS NULL THEN 'SCOOTER_NOT_FOUND'")

OFFER_PRICING_DOCUMENTS = OFFER_PRICING.replace(CONFIG, (
    "SELECT count(*) / 16.0::DOUBLE AS surge, CAST(0.7 AS DOUBLE) AS low_charge_discount, "
    "max(price_per_minute) * 4 AS low_charge_threshold_percent, 5 AS incomplete_ride_threshold_seconds FROM zones"))

LEDGER_SNAPSHOT = with_standins(*_FIN_SRC, extra=_WORLD) + """
SELECT id, order_id, user_id, transaction_type, amount, status, external_transaction_id, error_message, created_at FROM ledger"""

HOLD_LEDGER_PAYMENT_IDS = HOLD_LEDGER.replace(
    "CAST(NULL AS VARCHAR) AS external_transaction_id",
    "'hold-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS external_transaction_id")

FINISH_LEDGER_PAYMENT_IDS = with_standins(*_FIN_SRC, extra=_FINISH) + """
SELECT * REPLACE (CASE WHEN status = 'SUCCESS' AND CAST(split_part(order_id, '-', 2) AS BIGINT) % 7 <> 0
  THEN 'pay-' || CASE transaction_type WHEN 'CLEAR' THEN 'charge' ELSE 'unhold' END || '-' || order_id
  ELSE '' END AS external_transaction_id) FROM fledger"""

REQUEST_START_RECORDS = with_standins("request_log") + """
SELECT ts, event_id, method, path, CASE WHEN event_id % 30 = 0 THEN 'from=/orders/x?&n=' || CAST(event_id AS VARCHAR) END AS query,
  nullif(regexp_extract(path, '^/orders/([^/]+)', 1), '') AS order_id
FROM request_log WHERE event = 'request_start'"""

ORDER_DOCUMENTS_READBACK = with_standins("rides") + """
SELECT id, user_id, scooter_id, offer_id, coalesce(price_per_minute, 0) AS price_per_minute, coalesce(price_unlock, 0) AS price_unlock,
  coalesce(deposit, 0) AS deposit, coalesce(total_amount, 0) AS current_amount, status, start_time, finish_time, duration_seconds,
  CAST(NULL AS VARCHAR) AS _corrupt_record FROM rides"""

OFFER_REQUEST_BODIES = with_standins("offer_requests", extra={
    "raw": """SELECT request_id, ts, CAST(substr(request_id, 5) AS BIGINT) AS n,
        '{"user_id":"' || user_id || '","scooter_id":"' || scooter_id || '","extra":1}' AS whole, user_id FROM offer_requests""",
    "sent": """SELECT request_id, ts, CASE WHEN n % 17 = 0 THEN NULL WHEN n % 13 = 0 THEN '[' || whole || ']'
        WHEN n % 11 = 0 THEN left(whole, length(whole) - 2) WHEN n % 7 = 0 THEN '{}'
        WHEN n % 5 = 0 THEN '{"user_id":"' || user_id || '"}' ELSE whole END AS body FROM raw""",
    "ok": "SELECT *, coalesce(json_valid(body) AND left(body, 1) = '{', false) AS fine FROM sent",
    "got": """SELECT request_id, ts, CASE WHEN fine THEN json_extract_string(body, '$.user_id') END AS user_id,
        CASE WHEN fine THEN json_extract_string(body, '$.scooter_id') END AS scooter_id,
        CASE WHEN NOT fine THEN coalesce(body, '') END AS malformed_body FROM ok"""}) + """
SELECT *, CASE WHEN malformed_body IS NOT NULL THEN 'INVALID_BODY' WHEN coalesce(user_id, '') = '' THEN 'USER_ID_REQUIRED'
  WHEN coalesce(scooter_id, '') = '' THEN 'SCOOTER_ID_REQUIRED' END AS reject FROM got"""

_ADMISSION_COLS = f"order_id, offer_id, user_id, requested_at, hold_success, {TB}, outcome"

ADMISSION_TWO_DAYS = with_standins("offers", "order_requests", extra=_ADMISSION) + f"""
SELECT {_ADMISSION_COLS}, {ORDER_STATUS_SQL} AS http_status FROM admitted"""

# Sequential replay per four order keys (they share order ids, nothing else
# does), carrying the created orders and used offers as lists.
ADMISSION_SHARED_ORDER_IDS = with_standins("offers", extra={
    "base": STANDINS["order_requests"],
    "order_requests": """SELECT * REPLACE (CASE WHEN order_id = '' THEN '' ELSE 'order-' || CAST(l_orderkey // 4 AS VARCHAR) || '-'
        || CAST(l_linenumber % 2 AS VARCHAR) END AS order_id) FROM base""",
    "j": _ADMISSION["j"], "v": _ADMISSION["v"],
    "n": f"SELECT *, l_orderkey // 4 AS comp, row_number() OVER (PARTITION BY l_orderkey // 4 ORDER BY requested_at, {TB}) AS rn FROM v",
    "run": """SELECT comp, CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[]) AS made, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS VARCHAR) AS outcome
        FROM n GROUP BY comp
        UNION ALL
        SELECT n.comp, n.rn,
          CASE WHEN x.o = 'CREATED' THEN list_append(r.made, n.order_id) ELSE r.made END,
          CASE WHEN x.o IN ('CREATED', 'PAYMENT_HOLD_FAILED') THEN list_append(r.used, n.offer_id) ELSE r.used END, x.o
        FROM run r JOIN n ON n.comp = r.comp AND n.rn = r.rn + 1,
        LATERAL (SELECT CASE WHEN n.rej IS NOT NULL THEN n.rej WHEN list_contains(r.made, n.order_id) THEN 'DUPLICATE'
            WHEN n.ochk IS NOT NULL THEN n.ochk WHEN list_contains(r.used, n.offer_id) THEN 'OFFER_ALREADY_USED'
            WHEN NOT n.hold_success THEN 'PAYMENT_HOLD_FAILED' ELSE 'CREATED' END AS o) x""",
    "admitted": "SELECT n.*, run.outcome FROM n JOIN run ON n.comp = run.comp AND n.rn = run.rn"}, recursive=True) + f"""
SELECT {_ADMISSION_COLS}, {ORDER_STATUS_SQL} AS http_status FROM admitted"""

_PERSIST_REQ = """SELECT r.*, li.l_linestatus <> 'O' AS persisted FROM order_requests r
    LEFT JOIN lineitem li ON r.l_orderkey = li.l_orderkey AND r.l_linenumber = li.l_linenumber
     AND r.l_partkey = li.l_partkey AND r.l_suppkey = li.l_suppkey AND r.l_extendedprice = li.l_extendedprice
     AND r.l_shipdate = li.l_shipdate"""

_PERSIST_OVERRIDES = {
    "j": _ADMISSION["j"].replace("FROM order_requests r", "FROM order_requests_p r"),
    "c1": "SELECT *, first AND hold_success AND persisted AS created FROM r1",
    "admitted": """SELECT *, CASE WHEN rej IS NOT NULL THEN rej WHEN dup THEN 'DUPLICATE' WHEN ochk IS NOT NULL THEN ochk
        WHEN NOT first THEN 'OFFER_ALREADY_USED' WHEN NOT hold_success THEN 'PAYMENT_HOLD_FAILED'
        WHEN NOT persisted THEN 'PERSIST_FAILED' ELSE 'CREATED' END AS outcome FROM d1""",
}


def _persist_sql(body: str) -> str:
    ctes = {"order_requests_p": _PERSIST_REQ}
    for name, sql in _ADMISSION.items():        # same order, persistence-aware steps swapped in
        ctes[name] = _PERSIST_OVERRIDES.get(name, sql)
    return with_standins("order_requests", "offers", extra=ctes) + body


ADMISSION_WITH_PERSIST_FAILURES = _persist_sql(f"""
SELECT order_id, offer_id, user_id, requested_at, hold_success, persisted, {TB}, outcome,
  CAST(CASE WHEN outcome IN ('CREATED', 'DUPLICATE') THEN 201
            WHEN outcome IN ('PAYMENT_HOLD_FAILED', 'PERSIST_FAILED') THEN 500 ELSE 400 END AS INTEGER) AS http_status
FROM admitted""")

HOLD_COMPENSATIONS = _persist_sql("""
SELECT order_id, user_id, 'unhold' AS op FROM admitted WHERE outcome = 'PERSIST_FAILED'""")

ORACLE: dict[str, str] = {
    "admission_with_persist_failures": ADMISSION_WITH_PERSIST_FAILURES,
    "hold_compensations": HOLD_COMPENSATIONS,
    "trailing_requests_15m": TRAILING_REQUESTS_15M,
    "route_rps": ROUTE_RPS,
    "minute_latency_p99": MINUTE_LATENCY_P99,
    "request_records_enriched": REQUEST_RECORDS_ENRICHED,
    "offer_pricing_versioned": OFFER_PRICING_VERSIONED,
    "archive_records": ARCHIVE_RECORDS,
    "archive_readback": ARCHIVE_READBACK,
    "offer_pricing_degraded": OFFER_PRICING_DEGRADED,
    "offer_pricing_documents": OFFER_PRICING_DOCUMENTS,
    "orders_snapshot_readback": ORDERS_AFTER_FINISH,
    "ledger_snapshot_readback": LEDGER_SNAPSHOT,
    "hold_ledger_payment_ids": HOLD_LEDGER_PAYMENT_IDS,
    "finish_ledger_payment_ids": FINISH_LEDGER_PAYMENT_IDS,
    "request_start_records": REQUEST_START_RECORDS,
    "order_documents_readback": ORDER_DOCUMENTS_READBACK,
    "offer_request_bodies": OFFER_REQUEST_BODIES,
    "panel_trailing_rps": PANEL_TRAILING_RPS,
    "cache_hit_rate_alert": CACHE_HIT_RATE_ALERT,
    "admission_two_days": ADMISSION_TWO_DAYS,
    "admission_shared_order_ids": ADMISSION_SHARED_ORDER_IDS,
    "offer_creation_repeated_log": OFFER_CREATION_REPEATED_LOG,
    "offer_creation_min_remaining": OFFER_CREATION_MIN_REMAINING,
    "offer_saves": OFFER_SAVES,
    "offer_creation_claims": OFFER_CREATION_CLAIMS,
    "live_offers_at_requests": LIVE_OFFERS_AT_REQUESTS,
    "latency_sketches": LATENCY_SKETCHES,
    "orders_with_ledger_bucketed": ORDERS_WITH_LEDGER_BUCKETED,
    "order_lookup_sharded": ORDER_LOOKUP_SHARDED,
    "hot_cold_history": HOT_COLD_HISTORY,
    "payment_retry_worklist": PAYMENT_RETRY_WORKLIST,
    "stream_panel_rps": PANEL_RPS,
    "stream_panel_windows": STREAM_PANEL_WINDOWS,
    "stream_drop_counts": LOG_DROP_COUNTS,
    "stream_offer_creation_out_of_order": OFFER_CREATION,
    "stream_order_intake": STREAM_ORDER_INTAKE,
    "stream_offer_pricing": OFFER_PRICING,
    "stream_offer_creation": OFFER_CREATION,
    "constraint_violations": CONSTRAINT_VIOLATIONS,
    "offer_contract_checks": OFFER_CONTRACT_CHECKS,
    "order_contract_checks": ORDER_CONTRACT_CHECKS,
    "ledger_invariants": LEDGER_INVARIANTS,
    "scenario_report": SCENARIO_REPORT,
    "per_user_outcomes": PER_USER_OUTCOMES,
    "business_counters": BUSINESS_COUNTERS,
    "conversion_rate": CONVERSION_RATE,
    "order_cache_replay": ORDER_CACHE_REPLAY,
    "cache_hit_rate": CACHE_HIT_RATE,
    "log_drop_counts": LOG_DROP_COUNTS,
    "panel_rps": PANEL_RPS,
    "endpoint_latency": ENDPOINT_LATENCY,
    "endpoint_error_rate": ENDPOINT_ERROR_RATE,
    "error_rate_alerts": ERROR_RATE_ALERTS,
    "log_tail": LOG_TAIL,
    "request_complete_records": REQUEST_COMPLETE_RECORDS,
    "container_log_records": CONTAINER_LOG_RECORDS,
    "daily_log_readback": DAILY_LOG_READBACK,
    "order_lookup": ORDER_LOOKUP,
    "user_order_history": USER_HISTORY,
    "latest_order_per_offer": LATEST_ORDER_PER_OFFER,
    "expired_orders": EXPIRED_ORDERS,
    "cleanup_audit_log": CLEANUP_AUDIT_LOG,
    "cleanup_summary": CLEANUP_SUMMARY,
    "orders_after_cleanup": ORDERS_AFTER_CLEANUP,
    "ledger_after_cleanup": LEDGER_AFTER_CLEANUP,
    "cascade_orphans": CASCADE_ORPHANS,
    "ride_status_view": RIDE_STATUS_VIEW,
    "order_shard_map": ORDER_SHARD_MAP,
    "finish_outcomes": FINISH_OUTCOMES,
    "finish_ledger": FINISH_LEDGER,
    "orders_after_finish": ORDERS_AFTER_FINISH,
    "orders_after_finish_by_month": ORDERS_AFTER_FINISH,
    "orders_after_cleanup_by_month": ORDERS_AFTER_CLEANUP,
    "ledger_rollup": LEDGER_ROLLUP,
    "ride_billing_summary": RIDE_BILLING_SUMMARY,
    "order_admission": ORDER_ADMISSION,
    "admission_summary": ADMISSION_SUMMARY,
    "admitted_orders": ADMITTED_ORDERS,
    "hold_ledger": HOLD_LEDGER,
    "offer_pricing": OFFER_PRICING,
    "offer_creation": OFFER_CREATION,
    "ttl_chain_user_6h": TTL_CHAIN_USER_6H,
    "zone_cache_replay": ZONE_CACHE_REPLAY,
}

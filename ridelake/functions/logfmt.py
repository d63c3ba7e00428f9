"""Request-log field functions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Body truncation limits in bytes, and the truncation marker.
MAX_REQUEST_BODY_BYTES = 1000
MAX_ERROR_BODY_BYTES = 500
TRUNCATION_MARKER = "...(truncated)"

ROUTES = ["create_offer", "create_order", "get_order", "finish_order"]


def _nz(c: Column) -> Column:
    return F.when(c != "", c)


def path_order_id(path: Column) -> Column:
    """``{order_id}`` of ``/orders/{order_id}[...]``, null when absent."""
    return _nz(F.regexp_extract(path, r"^/orders/([^/]+)", 1))


def uri_path(uri: Column) -> Column:
    """The path of a request URI, what is before the first ``?``."""
    return F.regexp_extract(uri, r"^[^?]*", 0)


def uri_query(uri: Column) -> Column:
    """The query string of a request URI, null when it has none or an empty one."""
    return _nz(F.regexp_extract(uri, r"(?s)^[^?]*\?(.*)$", 1))


def route(method: Column, path: Column) -> Column:
    """Normalise method + path to one of the four service routes."""
    return (F.when((method == "POST") & (path == "/offers"), "create_offer")
            .when((method == "POST") & (path == "/orders"), "create_order")
            .when((method == "GET") & path.rlike(r"^/orders/[^/]+$"), "get_order")
            .when((method == "POST") & path.rlike(r"^/orders/[^/]+/finish$"), "finish_order")
            .otherwise("other"))


def truncate_bytes(body: Column, max_bytes: int) -> Column:
    """Keep the first ``max_bytes`` bytes (not characters) and mark the
    cut.  A character the cut divides is no longer valid UTF-8: each byte left
    of it becomes U+FFFD, as the service's log encoder writes it."""
    raw = F.encode(body, "UTF-8")

    def continues(at: int) -> Column:
        return F.hex(F.substring(raw, at, 1)).between("80", "BF")

    # bytes of a divided character before the cut (at most three)
    broken = (F.when(~continues(max_bytes + 1), 0).when(~continues(max_bytes), 1)
              .when(~continues(max_bytes - 1), 2).otherwise(3))
    cut = F.concat(F.decode(F.substring(raw, F.lit(1), F.lit(max_bytes) - broken), "UTF-8"),
                   F.repeat(F.lit("\ufffd"), broken), F.lit(TRUNCATION_MARKER))
    return F.when(F.octet_length(body) > max_bytes, cut).otherwise(body)


def log_level(status: Column) -> Column:
    """P10: ``error`` for status >= 400, else ``info``."""
    return F.when(status >= 400, "error").otherwise("info")


def log_message(status: Column) -> Column:
    """P10: completion message by status class."""
    return (F.when(status >= 500, "HTTP request failed")
            .when(status >= 400, "HTTP request client error")
            .otherwise("HTTP request completed"))


def error_code(status: Column) -> Column:
    return F.when(status >= 400, status)


def duration_ms(nanos: Column) -> Column:
    """Nanoseconds -> milliseconds as double."""
    return nanos.cast("double") / F.lit(1e6)


_KEYS = T.MapType(T.StringType(), T.VariantType())


def _text(m: Column, key: str) -> Column:
    """A non-empty JSON string under ``key``; numbers, booleans, objects and
    arrays are not ids."""
    v = m[key]
    return F.when(F.schema_of_variant(v) == "STRING", _nz(F.variant_get(v, "$", "string")))


def request_keys(body: Column) -> Column:
    """Business ids of a request body (only non-empty strings)."""
    m = F.from_json(body, _KEYS)
    return F.struct(*[_text(m, k).alias(k) for k in ("user_id", "order_id", "offer_id",
                                                     "scooter_id")])


def response_keys(body: Column) -> Column:
    """Ids of a response body.  ``id`` names an offer when the body has
    ``expires_at``, else an order -- unless ``order_id`` is present."""
    m = F.from_json(body, _KEYS)
    rid, oid = _text(m, "id"), _text(m, "order_id")
    is_offer = F.map_contains_key(m, "expires_at")
    order_id = F.when(rid.isNotNull(), F.when(oid.isNotNull(), oid)
                      .when(~is_offer, rid))
    offer_id = F.when(rid.isNotNull() & oid.isNull() & is_offer, rid)
    return F.struct(order_id.alias("order_id"), offer_id.alias("offer_id"),
                    _text(m, "user_id").alias("user_id"),
                    _text(m, "status").alias("order_status"))


def merged_keys(req: Column, resp: Column) -> Column:
    """Response keys override request keys (they are written later)."""
    return F.struct(
        F.coalesce(resp["user_id"], req["user_id"]).alias("user_id"),
        F.coalesce(resp["order_id"], req["order_id"]).alias("order_id"),
        F.coalesce(resp["offer_id"], req["offer_id"]).alias("offer_id"),
        req["scooter_id"].alias("scooter_id"),
        resp["order_status"].alias("order_status"))


def parse_rfc3339(s: Column) -> Column:
    """RFC 3339 text with up to nanosecond digits -> TIMESTAMP_NTZ in UTC
    (fraction truncated to microseconds; offset applied)."""
    m = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d+)?(Z|[+-]\d{2}:\d{2})?$", 0)
    base = F.concat(F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(" "),
                    F.regexp_extract(s, r"[T ](\d{2}:\d{2}:\d{2})", 1))
    frac = F.substring(F.concat(F.regexp_extract(s, r"\.(\d+)", 1), F.lit("000000")), 1, 6)
    local = F.try_to_timestamp(F.concat(base, F.lit("."), frac),
                               F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz")
    off = F.regexp_extract(s, r"([+-])(\d{2}):(\d{2})$", 0)
    sign = F.when(F.substring(off, 1, 1) == "-", F.lit(1)).otherwise(F.lit(-1))
    mins = (F.substring(off, 2, 2).cast("int") * 60 + F.substring(off, 5, 2).cast("int"))
    shift = F.make_dt_interval(F.lit(0), F.lit(0), (sign * F.coalesce(mins, F.lit(0))).cast("int"))
    return F.when(m != "", F.when(off == "", local).otherwise(local + shift))

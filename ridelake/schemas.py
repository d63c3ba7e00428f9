"""Fixed schemas of the rental data model (orders, ledger, offers, dimensions,
requests, logs).  Timestamps are stored without zone (TIMESTAMP_NTZ)."""

from pyspark.sql import types as T

S, I, L, D, B, TS = (T.StringType(), T.IntegerType(), T.LongType(),
                     T.DoubleType(), T.BooleanType(), T.TimestampNTZType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Enumerations checked by the storage constraints.
ORDER_STATUSES = ["ACTIVE", "FINISHED", "CANCELLED", "PAYMENT_FAILED"]
TXN_TYPES = ["HOLD", "CLEAR", "REFUND"]
TXN_STATUSES = ["SUCCESS", "FAILED", "PENDING"]

ORDERS = _struct(
    ("id", S, False), ("user_id", S, False), ("scooter_id", S, False),
    ("offer_id", S, False), ("price_per_minute", I, False), ("price_unlock", I, False),
    ("deposit", I, False), ("total_amount", I, False), ("status", S, False),
    ("start_time", TS, False), ("finish_time", TS, True), ("duration_seconds", I, True),
    ("created_at", TS, False), ("updated_at", TS, False),
)

PAYMENT_TRANSACTIONS = _struct(
    ("id", S, False), ("order_id", S, False), ("user_id", S, False),
    ("transaction_type", S, False), ("amount", I, False), ("status", S, False),
    ("external_transaction_id", S, True), ("error_message", S, True),
    ("created_at", TS, False),
)

OFFERS = _struct(
    ("id", S, False), ("user_id", S, False), ("scooter_id", S, False),
    ("zone_id", S, False), ("price_per_minute", I, False), ("price_unlock", I, False),
    ("deposit", I, False), ("created_at", TS, True), ("expires_at", TS, False),
)

# Order document as exposed by the read API (prices nullable, total as current_amount).
ORDER_DOC = _struct(
    ("id", S, False), ("user_id", S, False), ("scooter_id", S, False),
    ("offer_id", S, False), ("price_per_minute", I, True), ("price_unlock", I, True),
    ("deposit", I, True), ("current_amount", I, True), ("status", S, False),
    ("start_time", TS, False), ("finish_time", TS, True), ("duration_seconds", I, True),
)

SCOOTERS = _struct(("id", S, False), ("zone_id", S, False), ("charge", I, False))
ZONES = _struct(("id", S, False), ("price_per_minute", I, False),
                ("price_unlock", I, False), ("default_deposit", I, False))
USERS = _struct(("id", S, False), ("has_subscription", B, False), ("trusted", B, False))

CONFIGS = _struct(
    ("surge", D, True), ("low_charge_discount", D, True),
    ("low_charge_threshold_percent", I, True),
    ("incomplete_ride_threshold_seconds", I, True),
    ("extras", T.MapType(S, S), True),
)

OFFER_REQUEST = _struct(("request_id", S, False), ("user_id", S, True),
                        ("scooter_id", S, True), ("ts", TS, False))
ORDER_REQUEST = _struct(("order_id", S, True), ("offer_id", S, True),
                        ("user_id", S, True), ("requested_at", TS, False))
FINISH_REQUEST = _struct(("order_id", S, True), ("requested_at", TS, False))
PAYMENT_OUTCOME = _struct(("order_id", S, False), ("op", S, False),
                          ("success", B, False), ("transaction_id", S, True))

# Request bodies as decoded by the service (unknown fields ignored).
OFFER_BODY = _struct(("user_id", S, True), ("scooter_id", S, True))
ORDER_BODY = _struct(("order_id", S, True), ("offer_id", S, True), ("user_id", S, True))

REQUEST_COMPLETE_LOG = _struct(
    ("level", S, True), ("event", S, True), ("method", S, True), ("path", S, True),
    ("status_code", I, True), ("duration_ms", D, True), ("remote_addr", S, True),
    ("request_id", S, True), ("user_id", S, True), ("order_id", S, True),
    ("offer_id", S, True), ("scooter_id", S, True), ("order_status", S, True),
    ("error_code", I, True), ("error_response", S, True), ("time", S, True),
    ("message", S, True),
)

CONTAINER_ENVELOPE = _struct(("log", S, False), ("stream", S, True), ("time", S, True))

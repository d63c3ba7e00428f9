"""JSON rendering of order documents and log records.

The service renders documents with Go's encoder: keys in struct order, some
nullable fields written as ``null`` and others omitted, timestamps as
RFC 3339 with trailing zero fractions trimmed.  Spark's ``to_json`` drops or
keeps *all* nulls, so the document is assembled field by field with
``concat_ws`` (which skips omitted fields).  Timestamps are formatted from
their NTZ fields, independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .pricing import epoch_micros


# Escapes of the service's encoders beyond quote and backslash.
_CONTROL = {chr(c): f"\\u{c:04x}" for c in range(32)} | {
    "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
_HTML = {c: f"\\u{ord(c):04x}" for c in "<>&\u2028\u2029"}


def json_string(c: Column, html: bool = True) -> Column:
    """A JSON string literal: quotes, backslashes and control characters
    escaped and, in documents (``html``), ``<``, ``>``, ``&`` and the two
    Unicode line ends too."""
    escapes = {"\\": "\\\\", '"': '\\"'} | _CONTROL | (_HTML if html else {})
    esc = c
    for char, written in escapes.items():
        esc = F.replace(esc, F.lit(char), F.lit(written))
    special = "[\\x00-\\x1f\"\\\\" + ("<>&\\u2028\\u2029" if html else "") + "]"
    return F.concat(F.lit('"'), F.when(c.rlike(special), esc).otherwise(c), F.lit('"'))


def rfc3339(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.fraction]Z`` with the fraction's trailing zeros trimmed."""
    base = F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", F.year(ts), F.month(ts),
                           F.dayofmonth(ts), F.hour(ts), F.minute(ts),
                           F.floor(F.second(ts)).cast("int"))
    frac = F.regexp_replace(F.lpad(F.pmod(epoch_micros(ts), F.lit(1_000_000)).cast("string"),
                                   6, "0"), "0+$", "")
    return F.concat(base, F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
                    F.lit("Z"))


def _field(name: str, value: Column, omit_null: bool) -> Column:
    rendered = F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null")))
    return F.when(value.isNull(), F.lit(None)).otherwise(rendered) if omit_null else rendered


def order_json(current_amount, deposit, duration_seconds, finish_time, id_, offer_id,
               price_per_minute, price_unlock, scooter_id, start_time, status, user_id
               ) -> Column:
    """The order document; prices and deposit omitted when null, amount,
    duration and finish time written as null."""
    num = lambda c: c.cast("string")
    parts = [
        _field("current_amount", num(current_amount), False),
        _field("deposit", num(deposit), True),
        _field("duration_seconds", num(duration_seconds), False),
        _field("finish_time", F.when(finish_time.isNotNull(), json_string(rfc3339(finish_time))),
               False),
        _field("id", json_string(id_), False),
        _field("offer_id", json_string(offer_id), False),
        _field("price_per_minute", num(price_per_minute), True),
        _field("price_unlock", num(price_unlock), True),
        _field("scooter_id", json_string(scooter_id), False),
        _field("start_time", json_string(rfc3339(start_time)), False),
        _field("status", json_string(status), False),
        _field("user_id", json_string(user_id), False),
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

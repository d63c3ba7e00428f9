"""Outcome -> HTTP-style status code, per endpoint.

Fixed values: the status code the service answers for each outcome.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFER_STATUS = {
    "CREATED": 201,
    "REUSED": 201,
    "INVALID_BODY": 400,
    "USER_ID_REQUIRED": 400,
    "SCOOTER_ID_REQUIRED": 400,
    "SCOOTER_NOT_FOUND": 400,
    "SCOOTERS_UNAVAILABLE": 503,
    "ZONE_UNAVAILABLE": 503,
}

ORDER_CREATE_STATUS = {
    "CREATED": 201,
    "DUPLICATE": 201,
    "INVALID_BODY": 400,
    "ORDER_ID_REQUIRED": 400,
    "OFFER_ID_REQUIRED": 400,
    "USER_ID_REQUIRED": 400,
    "OFFER_NOT_FOUND": 400,
    "OFFER_EXPIRED": 400,
    "OFFER_ALREADY_USED": 400,
    "INVALID_USER": 400,
    "PAYMENT_HOLD_FAILED": 500,
    "PERSIST_FAILED": 500,
}

ORDER_READ_STATUS = {"FOUND": 200, "NOT_FOUND": 404, "ORDER_ID_REQUIRED": 400, "ERROR": 500}

FINISH_STATUS = {
    "FINISHED": 200,
    "PAYMENT_FAILED": 200,
    "ORDER_ID_REQUIRED": 400,
    "ORDER_NOT_FOUND": 400,
    "ORDER_NOT_ACTIVE": 409,
    "ERROR": 500,
}


def status_code(outcome: Column, mapping: dict[str, int]) -> Column:
    """Map an outcome column through a fixed table (null for unknown outcomes)."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(outcome == k, F.lit(v)) if expr is None
                else expr.when(outcome == k, F.lit(v)))
    return expr.cast("int")

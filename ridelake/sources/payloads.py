"""Decoding JSON documents and request bodies.

Documents are decoded with ``from_json`` and a fixed schema in PERMISSIVE
mode; a malformed document keeps its raw text in ``_corrupt_record`` and is
classified, never failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.logfmt import parse_rfc3339


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])


def decode_json(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Decode ``col``; null input = absent document (``_present`` false).  Times
    are RFC 3339 text (E15); one that is not makes its document malformed."""
    times = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in times else f for f in schema.fields])
    parsed = F.from_json(F.col(col), _with_corrupt(as_text),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    time = {n: parse_rfc3339(F.col(f"_doc.{n}")) for n in times}
    no_time = reduce(lambda a, b: a | b, [F.col(f"_doc.{n}").isNotNull() & time[n].isNull() for n in times], F.lit(False))
    return (df.withColumn("_doc", parsed)
            .select(*[c for c in df.columns if c != col],
                    F.col(col).isNotNull().alias("_present"),
                    *[time.get(f.name, F.col(f"_doc.{f.name}")).alias(f.name) for f in schema.fields],
                    F.when(F.col(col).isNotNull(), F.coalesce(F.col("_doc._corrupt_record"), F.when(no_time, F.col(col))))
                    .alias("_corrupt_record")))


def decode_offers(df: DataFrame, col: str = "value") -> DataFrame:
    """Offer documents."""
    return decode_json(df, col, schemas.OFFERS)


def decode_order_documents(df: DataFrame, col: str = "value") -> DataFrame:
    """Cached order documents."""
    return decode_json(df, col, schemas.ORDER_DOC)


def _decode_body(df: DataFrame, col: str, schema) -> DataFrame:
    """A request body must be one JSON object: an empty or missing body, or a
    JSON value that is not an object, is malformed just like unparsable text
    -- its text (or '') goes to ``_corrupt_record``."""
    not_object = F.col(col).isNull() | ~F.ltrim(F.col(col)).startswith("{")
    d = (df.withColumn("_not_obj", not_object)
         .withColumn("_raw", F.coalesce(F.col(col), F.lit(""))))
    return (decode_json(d, col, schema)
            .withColumn("_corrupt_record", F.when(F.col("_not_obj"), F.col("_raw"))
                        .otherwise(F.col("_corrupt_record")))
            .drop("_not_obj", "_raw", "_present"))


def decode_offer_requests(df: DataFrame, col: str = "body") -> DataFrame:
    """Offer request bodies; a malformed body keeps its text in
    ``_corrupt_record`` (-> INVALID_BODY in F01)."""
    return _decode_body(df, col, schemas.OFFER_BODY)


def decode_order_requests(df: DataFrame, col: str = "body") -> DataFrame:
    """Order request bodies (malformed -> INVALID_BODY in F02)."""
    return _decode_body(df, col, schemas.ORDER_BODY)

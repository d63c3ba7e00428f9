"""Sources S01-S04, S10: fact tables, reference dimensions and configs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Dynamic-config defaults used until a config document is seen.
DEFAULT_CONFIG = {
    "surge": 1.2,
    "low_charge_discount": 0.7,
    "low_charge_threshold_percent": 28,
    "incomplete_ride_threshold_seconds": 5,
}


# The key each fact table is spread on (unique or nearly so,
# and the key of its first join where there is one).
SPREAD_KEYS = {"events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey"}


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One driver test table (``{sf_dir}/{name}.parquet``).

    ``spread``: a fact table whose scan yields fewer splits than the cluster's
    parallelism (one small file with a single row group) is hash-partitioned on
    its key over ``defaultParallelism`` tasks, so the work before the first
    shuffle is not single-threaded (hash, not round-robin: no sort is needed
    for a deterministic retry, and a later join on the key reuses it).  Large
    inputs already have enough splits and are left untouched."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        par = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < max(2, par // 2):
            key = SPREAD_KEYS.get(name)
            df = df.repartition(par, key) if key else df.repartition(par)
    return df


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Orders snapshot with its fixed schema (no inference)."""
    return spark.read.schema(schemas.ORDERS).parquet(path)


def read_orders_jdbc(spark: SparkSession, url: str, predicates: list[str],
                     properties: dict[str, str]) -> DataFrame:
    """S01 alternate connector: one JDBC partition per predicate."""
    return spark.read.jdbc(url, "orders", predicates=predicates, properties=properties)


def read_payment_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Payment ledger."""
    return spark.read.schema(schemas.PAYMENT_TRANSACTIONS).parquet(path)


def read_dimension_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """A JSON document holding a top-level array of objects -> rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_configs_json(spark: SparkSession, path: str) -> DataFrame:
    """S04 input: the config document (a single JSON object)."""
    raw = spark.read.option("multiLine", True).json(path)
    cols = set(raw.columns)
    return raw.select(*[
        (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.CONFIGS.fields if f.name != "extras"
    ])


def default_configs(spark: SparkSession) -> DataFrame:
    """One-row config frame holding the built-in defaults."""
    return spark.range(1).select(
        F.lit(DEFAULT_CONFIG["surge"]).cast("double").alias("surge"),
        F.lit(DEFAULT_CONFIG["low_charge_discount"]).cast("double").alias("low_charge_discount"),
        F.lit(DEFAULT_CONFIG["low_charge_threshold_percent"]).cast("int")
        .alias("low_charge_threshold_percent"),
        F.lit(DEFAULT_CONFIG["incomplete_ride_threshold_seconds"]).cast("int")
        .alias("incomplete_ride_threshold_seconds"),
    )


def resolve_configs(configs: DataFrame | None, spark: SparkSession) -> dict:
    """The effective config values.

    The config document is one row by contract; a missing document (``None``
    or no rows) falls back to the defaults, and a missing key inside it to the
    default for that key.  At most two rows are read, so the driver never sees
    more than the single document.
    """
    values = dict(DEFAULT_CONFIG)
    if configs is None:
        return values
    rows = configs.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("config document must be a single row")
    if rows:
        for k in DEFAULT_CONFIG:
            v = rows[0].asDict().get(k)
            if v is not None:
                values[k] = v
    return values


ARCHIVE_PARTITIONS = ["batch", "yyyy", "mm", "dd", "hh"]


def read_archive(spark: SparkSession, root: str, schema) -> DataFrame:
    """Cold archive laid out as ``batch=/yyyy=/mm=/dd=/hh=`` gzip NDJSON.

    The partition columns are declared as zero-padded strings (no type
    inference), and filters on them prune directories before any file is
    opened (``PartitionFilters`` in the scan).
    """
    from pyspark.sql import types as T
    fields = [f for f in schema.fields if f.name not in ARCHIVE_PARTITIONS]
    full = T.StructType(fields + [T.StructField(c, T.StringType()) for c in ARCHIVE_PARTITIONS])
    return spark.read.schema(full).json(root)

"""Shared helpers of the operators: table access, written intermediates,
two-pass prefix sums and connected components."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir


# Rows and bytes handed to a Python worker at once where the session has Spark's
# defaults: documents are long, so a worker holds few of them.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Settings the operators' Python workers rely on: bounded Arrow batches
    and, in a local session, the place this package is imported from (on a
    cluster it is deployed as any job's package is)."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) in (None, str((1 << 63) - 1), "-1"):
        spark.conf.set(size, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to a fresh folder below the session's
    shared checkpoint folder, and read back: cuts the lineage, and a lost
    executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh place below the session's shared checkpoint folder."""
    return scratch_dir(spark, f"ridelake-llm-{name}-{uuid.uuid4().hex[:16]}")


def exclusive_prefix(totals: DataFrame, part: str, amount: str, out: str) -> DataFrame:
    """Second pass of a two-pass prefix sum.  ``totals`` has one row per
    partition (``part``, ``amount``); returns ``part`` and ``out``, the sum of
    ``amount`` over all smaller ``part``.  The window sees one row per
    partition of the first pass, never document rows."""
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(amount).over(w), F.lit(0)).cast("long").alias(out))


def text_hash(text: Column) -> Column:
    """Tie-break among rows with one id: a null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node reachable) for
    every node of the undirected ``edges`` (long columns ``a``, ``b``).

    Large-star / small-star: each round links every node to the least node
    next to it, so diameters shrink geometrically; a round is joins and
    aggregations with partial sums only, and its edges are written to the
    shared folder.  Ends when a round changes nothing."""
    e = written(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                .where("lo <> hi").distinct(), "cc")
    signature = None
    while True:
        # large star: neighbours above a node go to the least node near it
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct())
        # small star: neighbours below a node, and itself, go to the least of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        e = written(small.select(F.col("m").alias("lo"), F.col("hi"))
                    .union(small.select(F.col("m").alias("lo"), F.col("lo").alias("hi")))
                    .where("lo <> hi").distinct(), "cc")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())
        if now == signature or not now[0]:
            break
        signature = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()

"""Tables kept by partition, rewritten where touched.

A published table is a manifest: for every partition value the folder that
holds its rows.  A change writes new folders for the partitions its keys lie in
and a new manifest that names them beside the untouched old ones, last -- so
readers of the version before are never disturbed, and a batch that touches one
of thirty days writes one day's files.
"""

from __future__ import annotations

import json
import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Value of rows without a partition date, and the spans a partition can hold: a
# partition should fill some files, so small tables are kept by month.
NO_DATE = "none"
DAY, MONTH = "yyyy-MM-dd", "yyyy-MM"


def part_of(ts: str, span: str) -> Column:
    return F.coalesce(F.date_format(F.col(ts), span), F.lit(NO_DATE))


def part_at(at: datetime, span: str) -> str:
    """Partition of an instant; partitions sort as their spans do."""
    return at.strftime("%Y-%m-%d")[:len(span)]


def _write(rows: DataFrame, root: str, version: str, part: Column) -> dict[str, str]:
    """Write ``rows`` by partition under the version; returns their folders."""
    base = os.path.join(root, f"version={version}")
    named = rows.withColumn("part", part)
    (named.hint("rebalance", "part").sortWithinPartitions("part")
     .write.mode("overwrite").partitionBy("part").parquet(base))
    # bounded: one row per partition written
    parts = rows.sparkSession.read.schema(named.schema).parquet(base).select("part").distinct().collect()
    return {r["part"]: f"{base}/part={r['part']}" for r in parts}


def _commit(spark: SparkSession, root: str, version: str, folders: dict[str, str]) -> None:
    text = json.dumps({"version": version, "folders": folders}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(root, "manifests", f"version={version}"))


def folders_of(spark: SparkSession, root: str, version: str) -> dict[str, str]:
    row = spark.read.schema("value string").text(os.path.join(root, "manifests", f"version={version}")).first()
    return json.loads(row["value"])["folders"]


def publish(rows: DataFrame, root: str, version: str, ts: str, span: str = DAY) -> None:
    """The first version: all rows by the ``span`` of ``ts``."""
    _commit(rows.sparkSession, root, version, _write(rows, root, version, part_of(ts, span)))


def read(spark: SparkSession, root: str, version: str, schema: StructType,
         parts: list[str] | None = None) -> DataFrame:
    """Rows of a version, or of some of its partitions only."""
    folders = folders_of(spark, root, version)
    paths = [folders[d] for d in sorted(folders) if parts is None or d in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def touched(table: DataFrame, key: str, changed: DataFrame, changed_key: str, ts: str,
            span: str = DAY) -> list[str]:
    """Partitions of the rows whose key is among the changed ones; reads the key and
    time columns only."""
    ids = changed.select(F.col(changed_key).alias("_c")).distinct()
    # bounded: one row per partition
    return sorted(r["part"] for r in table.select(key, part_of(ts, span).alias("part"))
                  .join(ids, F.col(key) == F.col("_c"), "left_semi").select("part").distinct().collect())


def republish(spark: SparkSession, root: str, old: str, new: str, parts: list[str],
              rows: DataFrame, ts: str, span: str = DAY) -> list[str]:
    """Version ``new``: ``rows`` take the place of the ``parts`` of version
    ``old`` (those left without rows are gone), all others stay where they are.
    Returns the partitions written."""
    written = _write(rows, root, new, part_of(ts, span)) if parts else {}
    kept = {d: f for d, f in folders_of(spark, root, old).items() if d not in parts}
    extra = sorted(set(written) - set(parts))
    if extra:
        raise ValueError(f"rows of partitions that are not replaced: {extra}")
    _commit(spark, root, new, {**kept, **written})
    return sorted(written)

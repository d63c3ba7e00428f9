"""Lineage cuts as written tables in the shared checkpoint folder.

Iterative and multi-pass operators materialise intermediates so later passes
read them instead of recomputing the whole upstream plan, and so a lost
executor costs a re-read, not a recomputation from the raw input.  The table
goes to a fresh sub-folder of the folder the cluster names in
``spark.checkpoint.dir`` (never a machine-local path on a cluster, never a
path that is being read); it is written once as Parquet (one job, unlike an
eager RDD checkpoint which computes its input twice) and read back.

Once it is written nothing reads the shuffles behind it again, so they are
dropped then, not when the driver happens to collect garbage: of a job in
several steps the disk holds the written tables and the shuffles of one step.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir


# Spark removes the shuffle files of an execution at its end where this is set.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = scratch_dir(spark, f"ridelake-{name}-{uuid.uuid4().hex[:16]}")
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def has_rows(df: DataFrame) -> bool:
    with shuffles_dropped(df.sparkSession):
        return df.limit(1).count() > 0

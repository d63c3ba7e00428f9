"""Size-checked broadcast.

A side is broadcast only after a bounded probe proves it small: the probe
reads at most ``max_rows + 1`` rows (a ``limit`` stops the scan early), so it
stays cheap however large the table is.  Anything above the bound is joined
with the planner's shuffle strategy, where AQE can still switch to a broadcast
at runtime from measured shuffle sizes and split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows and bytes a side may have to be broadcast on an explicit hint: the rows
# are counted, their bytes measured on those rows.
DEFAULT_MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: strings and binaries as long as they are, nested values
    as their JSON text, anything else 8 bytes."""
    size = F.lit(16)
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            size = size + F.lit(8)
    return size


def _probe(df: DataFrame, max_rows: int) -> DataFrame:
    """Row count and bytes of at most ``max_rows + 1`` rows."""
    return df.select(_row_bytes(df).alias("_bytes")).limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"))


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    row = _probe(df, max_rows).first()
    return row["n"] <= max_rows and row["bytes"] <= MAX_BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it provably holds at most ``max_rows`` rows of
    at most ``MAX_BROADCAST_BYTES`` together."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def broadcast_all_if_small(dfs: list[DataFrame], max_rows: int = DEFAULT_MAX_BROADCAST_ROWS
                           ) -> list[DataFrame]:
    """Probe several sides in one job."""
    probe = None
    for i, df in enumerate(dfs):
        part = _probe(df, max_rows).withColumn("_side", F.lit(i))
        probe = part if probe is None else probe.unionByName(part)
    small = {r["_side"]: r["n"] <= max_rows and r["bytes"] <= MAX_BROADCAST_BYTES for r in probe.collect()}
    return [F.broadcast(df) if small[i] else df for i, df in enumerate(dfs)]

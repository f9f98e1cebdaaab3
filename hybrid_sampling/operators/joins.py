"""Joins to small tables: broadcast hinted only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: broadcast budget (rows, and bytes by a per-column width estimate)
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def row_width(schema: T.StructType) -> int:
    """Rough bytes per row: 8 per fixed-width value, 16 per decimal, 32 per
    string or binary, 64 per nested value (an estimate for budgeting only)."""
    w = 0
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            w += 32
        elif isinstance(t, T.DecimalType):
            w += 16
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            w += 64
        else:
            w += 8
    return max(w, 8)


def bounded_broadcast(
    small: DataFrame, row_bound: int | None = None, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Hint a broadcast of ``small`` only when ``row_bound`` proves it small.

    ``row_bound`` is an upper bound known from the job itself (for example
    sampling groups <= factor rows, range pieces <= partitions + groups); the
    hint is given when both the rows and rows x estimated row width fit the
    budget. Without a bound no hint is given: Spark's planner broadcasts only
    what its statistics show to be under ``spark.sql.autoBroadcastJoinThreshold``
    (exact for inline metadata tables, file sizes for scans) and AQE re-checks
    with run-time sizes; otherwise it plans a shuffle join. No table is counted
    just to decide.
    """
    if row_bound is not None and row_bound <= max_rows and row_bound * row_width(small.schema) <= max_bytes:
        return F.broadcast(small)
    return small


def count_bound(df: DataFrame) -> int:
    """Row count of a table that the caller has kept (one row per sampling
    group), reused as the bound of every broadcast keyed by group."""
    return df.count()

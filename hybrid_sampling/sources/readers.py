"""Readers (S1, S2). Filters written after these calls reach the scan:
Parquet gets PushedFilters / pruned ReadSchema, JDBC gets a WHERE clause."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A fact or dimension table stored as Parquet below ``root``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{name}")


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table_or_query: str,
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table or a ``(SELECT ...) t`` subquery over JDBC.

    ``options`` carries url, user, password and driver from the caller (no
    credentials live in this code). ``partition`` = (column, lower, upper,
    num_partitions) splits a large table over many tasks instead of one.
    Values belong in filters (pushed down as bound predicates), never spliced
    into the query text.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table_or_query)
    if partition is not None:
        col, lo, hi, n = partition
        reader = reader.option("partitionColumn", col).option("lowerBound", str(lo)).option("upperBound", str(hi)).option("numPartitions", str(n))
    return reader.load()


def local_table(spark: SparkSession, rows, columns: list[tuple[str, str]]) -> DataFrame:
    """A small metadata table from literal rows, planned as an inline table.

    Unlike a DataFrame built from a driver-side list (an RDD scan of unknown
    size), Spark sees this table's true size, so its planner broadcasts it in
    joins on its own and never shuffles the large side for it.
    ``columns``: (name, Spark SQL type) pairs.
    """
    from pyspark.sql import functions as F

    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))

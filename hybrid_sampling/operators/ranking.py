"""Population ranking (row number inside a sampling group) at any group size.

A keyed window (``row_number() over (partition by group ...)``) sends a whole
group to one task; one measure can hold a large share of all members, so the
rank is computed instead as:

1. range-partition all rows on (group keys, sort order) into P partitions and
   sort each partition: a large group is spread over many consecutive tasks;
2. tag each row with ``monotonically_increasing_id`` (increasing in sort order
   inside a partition) and its partition id, and write the tagged rows once as
   a staged Parquet table in the shared folder, so that both reads below see
   the same ids (two separate range shuffles could sample different bounds)
   and the lineage is cut;
3. aggregate a small table, one row per (partition, group) piece (at most
   P + G - 1 rows): piece size and first id, plus the running count of the
   group's earlier pieces (its offset) and the group's total size;
4. broadcast that table back: rank = offset + (id - first id) + 1.

The order is total (ids break ties), so ranks never depend on input order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hybrid_sampling.functions.order import population_order
from hybrid_sampling.operators.joins import bounded_broadcast
from hybrid_sampling.sources.staging import stage


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rank_population(
    df: DataFrame,
    group_cols: list[str],
    order: list[Column] | None = None,
    num_partitions: int | None = None,
    groups_bound: int | None = None,
    rank_col: str = "population_rank",
    size_col: str | None = "group_size",
    plan: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``rank_col`` (1..size, bigint) and optionally ``size_col`` per group.

    ``groups_bound`` is an upper bound on the number of groups (e.g. the number
    of planned samples); with it the piece table is broadcast without a count.
    ``plan`` adds columns to the piece table (group_cols and ``size_col``) that every row of
    the group is to carry: what depends on the group alone is computed there, not per row.
    """
    order = order if order is not None else population_order()
    n = _partitions(df, num_partitions)
    spec = [F.col(c).asc_nulls_first() for c in group_cols] + list(order)
    # an explicit count (default: spark.sql.shuffle.partitions, the configured
    # parallelism) keeps every core busy; AQE's coalescing would merge small
    # range partitions into a few tasks
    tagged = (
        df.repartitionByRange(n, *spec)
        .sortWithinPartitions(*spec)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    tagged = stage(tagged, "ranked")
    pieces = tagged.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    by_group = Window.partitionBy(*group_cols)
    earlier = by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "_pid",
        *group_cols,
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("bigint").alias("_offset"),
        F.sum("_n").over(by_group).cast("bigint").alias("_size"),
    )
    extra: list[str] = []
    if plan is not None:
        pieces = plan(pieces.withColumn(size_col, F.col("_size")))
        extra = [c for c in pieces.columns if c not in ("_pid", "_first", "_offset", "_size", size_col, *group_cols)]
    bound = None if groups_bound is None else n + int(groups_bound)
    # null-safe on the group keys: a null key is a group like any other
    renamed = pieces.select("_pid", *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], "_first", "_offset", "_size", *extra)
    cond = [tagged["_pid"] == renamed["_pid"]] + [tagged[c].eqNullSafe(renamed[f"_g{i}"]) for i, c in enumerate(group_cols)]
    joined = tagged.join(bounded_broadcast(renamed, bound), cond, "inner").drop(renamed["_pid"])
    joined = joined.drop(*[f"_g{i}" for i in range(len(group_cols))])
    out = joined.withColumn(rank_col, (F.col("_offset") + F.col("_mid") - F.col("_first") + 1).cast("bigint"))
    if size_col:
        out = out.withColumn(size_col, F.col("_size"))
    return out.drop("_pid", "_mid", "_first", "_offset", "_size")

"""Helpers shared by the operators: staged tables, skew-safe joins, text splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hybrid_sampling.session import scratch_path

#: Words: maximal runs of anything but the six ASCII white-space bytes (what ``bytes.split()`` splits at).
WORD = r"[^\x20\x09-\x0D]+"

#: A key is hot when it holds more than 1 / HOT_SHARE of all rows, so fewer than HOT_SHARE keys are.
HOT_SHARE = 512


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage is cut, any executor may go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct ``row`` beside the named columns, so no column of the input can clash."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *[c.alias(k) for k, c in columns.items()])


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def attach(rows: DataFrame, groups: DataFrame, key: str, n: str, spread: Column) -> DataFrame:
    """Left join ``groups`` (staged; one row a ``key``, ``n`` = its count of ``rows``) to ``rows``, whole at any skew.

    The keys with more than 1 / HOT_SHARE of the rows are fewer than HOT_SHARE: they are broadcast, a proven
    bound. The rest is joined by shuffle; rows that the broadcast has served are dealt out by ``spread`` there.
    ``key`` may be null on both sides (null matches null). Columns of ``groups`` other than ``key`` are added.
    """
    total = groups.agg(F.sum(n)).first()[0] or 0
    values = [c for c in groups.columns if c != key]
    side = groups.select(F.col(key).alias("_gk"), F.struct(*values).alias("_gv"))
    hot = F.col(f"_gv.{n}") > total // HOT_SHARE
    out = rows.join(F.broadcast(side.filter(hot)), F.col(key).eqNullSafe(F.col("_gk")), "left").drop("_gk")
    cold = side.filter(~hot)
    if not cold.isEmpty():
        cold = cold.select("_gk", F.col("_gv").alias("_cv"), F.lit(0).alias("_cs"))
        out = out.withColumn("_rs", F.when(F.col("_gv").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(spread), F.lit(65536)).cast("int")))
        out = out.join(cold, F.col(key).eqNullSafe(F.col("_gk")) & (F.col("_rs") == F.col("_cs")), "left")
        out = out.withColumn("_gv", F.coalesce("_gv", "_cv")).drop("_gk", "_cv", "_cs", "_rs")
    return out.select(*rows.columns, *[F.col(f"_gv.{c}").alias(c) for c in values])

"""Materialised intermediate tables in the shared folder.

Used where a result must be read twice and both reads must see identical rows
(ids assigned in sort order), and to cut long lineages. The folder comes from
``spark.checkpoint.dir`` (see ``session.shared_dir``); paths are never reused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from hybrid_sampling.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return the table read back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"stage-{name}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)

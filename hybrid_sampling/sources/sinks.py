"""Sinks (S4, S5, S6, S11). Each write is one job for all groups."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SAMPLE_PARTITIONS = ("domain_id", "measurement_year", "submission_id", "product_line", "measure_code")


def append_jdbc(df: DataFrame, options: dict[str, str], table: str, num_partitions: int | None = None) -> None:
    """Append rows to a database table (connections = ``num_partitions``)."""
    out = df if num_partitions is None else df.coalesce(num_partitions)
    out.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()


def write_sample(sample: DataFrame, root: str, partitions=SAMPLE_PARTITIONS) -> None:
    """The sample as Parquet partitioned by domain, year, submission, product
    line and measure. Dynamic partition overwrite: a rerun replaces only the partitions
    it writes. Rows are clustered by the partition keys first so each task
    writes few files, and stand in sample order within each (W7)."""
    (
        sample.repartition(*partitions).sortWithinPartitions(*partitions, "sample_order", "population_rank")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(root)
    )


def read_sample(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Read a stored sample back with its explicit schema (partition columns
    typed by the schema, not inferred from paths)."""
    return spark.read.schema(schema).parquet(root)


def read_if_any(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_ordered(df: DataFrame, path: str, keys: list[str], mode: str = "errorifexists", **options: str) -> None:
    """Parquet files that follow each other in the order of ``keys``, and rows in that order within each, so that
    the footers' least and greatest values let a reader of one key skip all other row groups."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).options(**options).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header (for review outside Spark)."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def freeze(base: DataFrame, path: str) -> DataFrame:
    """Write a snapshot once (``errorifexists``: a frozen path is never
    overwritten) and return the snapshot read back; sampling reads only this."""
    base.write.mode("errorifexists").parquet(path)
    return base.sparkSession.read.parquet(path)

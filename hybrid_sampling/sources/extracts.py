"""Raw extracts must be filled and sound before a year is sampled.

One pass over each extract reduces it to a row per year and key, so only distinct keys move;
known members are marked by one join, and the counts per year are compared with the extract's thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Extract:
    """``rows`` has the columns named by ``key`` and ``year``; thresholds are shares of a year's rows."""

    rows: DataFrame
    key: str = "patient_id"
    year: str = "measurement_year"
    min_rows: int = 1
    max_null_share: float = 0.0
    max_orphan_share: float = 0.0


def extract_metrics(extract: Extract, members: DataFrame, member_key: str = "patient_id") -> DataFrame:
    """Per year: n_rows, null_keys, orphan_keys (rows whose key no member has)."""
    keys = extract.rows.groupBy(F.col(extract.year).cast("int").alias("measurement_year"), F.col(extract.key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = members.select(F.col(member_key).alias("_key")).distinct().withColumn("_known", F.lit(True))
    j = keys.join(known, "_key", "left")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("bigint")
    return j.groupBy("measurement_year").agg(
        F.sum("_n").cast("bigint").alias("n_rows"), n(F.col("_key").isNull()).alias("null_keys"), n(F.col("_key").isNotNull() & F.col("_known").isNull()).alias("orphan_keys")
    )


def extract_checks(extracts: dict[str, Extract], members: DataFrame, years: DataFrame) -> DataFrame:
    """One row per extract and year of ``years`` (measurement_year): check_name, measurement_year, n_rows, null_keys,
    orphan_keys, passed. A year without rows has zeros, and passes only where none are asked for."""
    parts = []
    for name, x in sorted(extracts.items()):
        m = years.select("measurement_year").distinct().join(extract_metrics(x, members), "measurement_year", "left")
        m = m.select("measurement_year", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_rows", "null_keys", "orphan_keys")])
        ok = (F.col("n_rows") >= x.min_rows) & (F.col("null_keys") <= x.max_null_share * F.col("n_rows")) & (F.col("orphan_keys") <= x.max_orphan_share * F.col("n_rows"))
        parts.append(m.select(F.lit(f"extract:{name}").alias("check_name"), "measurement_year", "n_rows", "null_keys", "orphan_keys", ok.alias("passed")))
    return reduce(DataFrame.unionByName, parts)

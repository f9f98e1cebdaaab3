"""The frozen facts (S11): gate, then freeze, then publish, then read.

Only submission-years whose prerequisites have passed are frozen. Their rows are written to a
folder of the run and read back for a manifest (rows, a fingerprint that does not depend on
their order, the gate's checks and when it passed, the run); the manifest is published through a
ledger, and readers take what it names and nothing else. So a freeze that was lost half way
is invisible, a submission-year is frozen by the first run that publishes it, and its rows never change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from hybrid_sampling.operators.joins import bounded_broadcast, count_bound
from hybrid_sampling.sources.ledger import Ledger

KEYS = ["measurement_year", "submission_id"]
#: 13 hexadecimal digits of a digest are a whole number that a double holds, too.
_DIGITS = 13


def row_print(columns: list[str]):
    """A row as a number, from the digest of its columns as text in the order of their names."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(columns)])
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def fingerprints(rows: DataFrame, columns: list[str], keys=KEYS) -> DataFrame:
    """Per submission-year: n_rows and the sum of its rows' numbers (whatever their order or files)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row_print(columns).cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def gate_state(checks: DataFrame, status: DataFrame) -> DataFrame:
    """Per year that is ready: the checks it passed and, where the stages tell it, when the last of them did."""
    ready = checks.filter((F.col("check_name") == "ready") & F.col("passed")).select("measurement_year")
    names = checks.filter(F.col("passed") & (F.col("check_name") != "ready") & F.col("measurement_year").isNotNull())
    names = names.groupBy("measurement_year").agg(F.array_join(F.array_sort(F.collect_set("check_name")), ",").alias("gate"))
    when = F.col("completed_at").cast("timestamp") if "completed_at" in status.columns else F.lit(None).cast("timestamp")
    times = status.groupBy("measurement_year").agg(F.max(when).alias("gate_time"))
    return ready.join(names, "measurement_year").join(times, "measurement_year", "left")


class Snapshot:
    """Frozen submission-years below ``root``: data by run, year and submission, and the ledger of manifests."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ledger = Ledger(spark, f"{self.root}/manifest")

    def manifest(self) -> DataFrame | None:
        """One row a frozen submission-year: keys, n_rows, fingerprint, gate, gate_time, run_id."""
        return self.ledger.read()

    def _staged(self, base: DataFrame, wanted: DataFrame, run_id: str) -> DataFrame:
        """Write the rows of ``wanted`` below this run's folder; they are not yet part of the snapshot.

        A rebalance by key gives a submission-year as many tasks as its bytes ask for, and small ones one together."""
        part = base.join(wanted.select(*KEYS), KEYS, "left_semi").hint("rebalance", *[F.col(k) for k in KEYS])
        path = f"{self.root}/data/run_id={run_id}"
        part.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*KEYS).parquet(path)
        fields = [f for f in base.schema.fields if f.name not in KEYS] + [base.schema[k] for k in KEYS]
        return self.spark.read.schema(StructType(fields)).parquet(path)

    def freeze(self, base: DataFrame, scope: DataFrame, gate: DataFrame | None, run_id: str) -> None:
        """Freeze the submission-years of ``scope`` that are not frozen yet. ``scope`` must have passed the gate:
        with ``gate`` (from ``gate_state``) other years are left out. One with no facts is frozen with no rows."""
        wanted = scope.select(*KEYS).distinct().dropna()
        if gate is not None:
            wanted = wanted.join(gate, "measurement_year")
        else:
            wanted = wanted.withColumn("gate", F.lit(None).cast("string")).withColumn("gate_time", F.lit(None).cast("timestamp"))
        known = self.manifest()
        new = wanted if known is None else wanted.join(known, KEYS, "left_anti")
        if new.isEmpty():
            return
        staged = self._staged(base, new, run_id)
        rows = new.join(fingerprints(staged, base.columns), KEYS, "left").select(
            *KEYS, F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"), F.coalesce("fingerprint", F.lit("0")).alias("fingerprint"), "gate", "gate_time", F.lit(run_id).alias("run_id")
        )
        # another run may have frozen some of them meanwhile: those stay as it published them
        self.ledger.append(lambda known: rows if known is None else rows.join(known, KEYS, "left_anti"), run_id)

    def read(self, schema: StructType, scope: DataFrame | None = None) -> DataFrame:
        """The frozen rows (of the submission-years of ``scope``): the manifest prunes the partitions that are read."""
        known = self.manifest()
        if known is None:
            return self.spark.createDataFrame([], schema)
        named = known.filter(F.col("n_rows") > 0).select("run_id", *KEYS)  # a row a submission-year frozen
        if scope is not None:
            named = named.join(scope.select(*KEYS).distinct(), KEYS, "left_semi")
        fields = [f for f in schema.fields if f.name not in KEYS]
        stored = StructType(fields).add("run_id", StringType())
        for k in KEYS:
            stored = stored.add(schema[k])
        data = self.spark.read.schema(stored).parquet(f"{self.root}/data")
        return data.join(bounded_broadcast(named, count_bound(named)), ["run_id", *KEYS], "left_semi").select(*schema.names)

    def late(self, scope: DataFrame, gate: DataFrame) -> DataFrame:
        """The submission-years of ``scope`` frozen before the review of their year was last passed."""
        known = self.manifest()
        if known is None:
            return scope.select(*KEYS).limit(0)
        now = gate.select("measurement_year", F.col("gate_time").alias("_now"))
        old = known.join(now, "measurement_year").filter(F.col("gate_time").isNull() & F.col("_now").isNotNull() | (F.col("gate_time") < F.col("_now")))
        return scope.select(*KEYS).distinct().join(old.select(*KEYS), KEYS, "left_semi")

    def broken(self, schema: StructType) -> DataFrame:
        """Submission-years whose stored rows are not those of their manifest."""
        known = self.manifest()
        if known is None:
            return self.spark.createDataFrame([], "measurement_year int, submission_id long")
        found = fingerprints(self.read(schema), schema.names).withColumnRenamed("n_rows", "_n").withColumnRenamed("fingerprint", "_f")
        j = known.join(found, KEYS, "left")
        same = (F.coalesce("_n", F.lit(0)) == F.col("n_rows")) & (F.coalesce("_f", F.lit("0")) == F.col("fingerprint"))
        return j.filter(~same).select(*KEYS)

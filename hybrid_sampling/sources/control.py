"""Request control: which requests to run, their sources, prerequisites and
status after the run (S7-S10, S12, S13). All as DataFrames; the status update
produces a new version of the request table rather than updating in place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybrid_sampling.operators.joins import bounded_broadcast
from hybrid_sampling.sources.ledger import Ledger

# ---------------------------------------------------------------- fixed values
REQUEST_TYPE = "SAMPLING"
RECEIVED, PROCESSED, FAILED = "received", "PROCESSED", "FAILED"
REQUIRED_STAGES = ("MP", "PP", "FQR")
# ------------------------------------------------------------------------------


def open_requests(requests: DataFrame) -> DataFrame:
    """Sampling requests received and not yet processed (pushed to the scan)."""
    return requests.filter(
        (F.col("request_type") == REQUEST_TYPE) & (F.col("campaign_status") == RECEIVED) & (F.col("is_sampling_processed") == 0)
    )


def history_keys(sampled: DataFrame) -> list[str]:
    """Sampling runs once per submission and year; a history that names the
    product line says so per line (each line is a list of its own)."""
    return ["submission_id", "measurement_year"] + [c for c in ("product_line",) if c in sampled.columns]


def not_yet_sampled(requests: DataFrame, sampled: DataFrame, keys=("submission_id", "measurement_year")) -> DataFrame:
    """Sampling runs once per submission and year: drop requests whose
    keys already have a stored sample."""
    return requests.join(sampled.select(*keys).distinct(), list(keys), "left_anti")


def close_requests(requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """New request table version. ``outcomes``: correlation_id, succeeded.
    Success -> PROCESSED and flag 1; failure -> FAILED and flag 0; requests
    without an outcome keep their values."""
    o = outcomes.select("correlation_id", F.col("succeeded").alias("_ok"))
    j = requests.join(o, "correlation_id", "left")
    status = F.when(F.col("_ok"), F.lit(PROCESSED)).when(~F.col("_ok"), F.lit(FAILED)).otherwise(F.col("campaign_status"))
    flag = F.when(F.col("_ok"), F.lit(1)).when(~F.col("_ok"), F.lit(0)).otherwise(F.col("is_sampling_processed"))
    return j.withColumn("campaign_status", status).withColumn("is_sampling_processed", flag.cast("int")).drop("_ok")


def keep_processed(mine: DataFrame, published: DataFrame) -> DataFrame:
    """``mine`` on top of a version that another run published meanwhile: what is processed there stays so."""
    done = published.filter(F.col("campaign_status") == PROCESSED).select("correlation_id", F.lit(True).alias("_done"))
    j = mine.join(done, "correlation_id", "left")
    there = F.coalesce(F.col("_done"), F.lit(False))
    status, flag = F.when(there, F.lit(PROCESSED)).otherwise(F.col("campaign_status")), F.when(there, F.lit(1)).otherwise(F.col("is_sampling_processed"))
    return j.withColumn("campaign_status", status).withColumn("is_sampling_processed", flag.cast("int")).drop("_done").select(*mine.columns)


def claim_rows(groups: DataFrame, run_id: str, held: bool = True) -> DataFrame:
    """Rows of the claim ledger: sampling groups claimed by a run, or given back by it."""
    return groups.select("submission_id", "product_line", "measure_code", "measurement_year", F.lit(run_id).alias("run_id"), F.lit(held).alias("held"))


def standing_claims(ledger: DataFrame, measures: bool = False) -> DataFrame:
    """The submission-years and lines that are claimed and not given back, with their run (and measures)."""
    keys = ["submission_id", "product_line", "measure_code", "measurement_year", "run_id"]
    standing = ledger.groupBy(*keys).agg(F.bool_and("held").alias("held")).filter("held").drop("held")
    return standing if measures else standing.drop("measure_code").distinct()


def failure_rows(outcomes: DataFrame, process: str = "hybrid-sampling") -> DataFrame:
    """One error-log row per failed request."""
    return outcomes.filter(~F.col("succeeded")).select(
        "correlation_id", F.lit(process).alias("process_name"), F.coalesce(F.col("message"), F.lit("failed")).alias("error_message")
    )


def resolve_sources(requests: DataFrame, run_configuration: DataFrame, source_detail: DataFrame) -> DataFrame:
    """Run configuration -> source detail -> table name, per request."""
    j = requests.join(bounded_broadcast(run_configuration), "run_config_id", "inner")
    return j.join(bounded_broadcast(source_detail), "source_detail_id", "inner")


def source_errors(requests: DataFrame, run_configuration: DataFrame, source_detail: DataFrame) -> DataFrame:
    """Requests whose run configuration leads to no source table:
    correlation_id and error."""
    found = resolve_sources(requests.select("correlation_id", "run_config_id"), run_configuration, source_detail).select("correlation_id")
    missing = requests.select("correlation_id", "run_config_id").distinct().join(found, "correlation_id", "left_anti")
    return missing.select("correlation_id", F.concat(F.lit("no source table for run configuration "), F.coalesce(F.col("run_config_id").cast("string"), F.lit("(none)"))).alias("error"))


def no_gate_errors(requests: DataFrame) -> DataFrame:
    """Without stage statuses nothing tells that a year is ready, so no request of it may run."""
    return requests.select("correlation_id", F.concat(F.lit("year "), F.col("measurement_year").cast("string"), F.lit(" not ready: no stage status")).alias("error")).distinct()


def gate_errors(requests: DataFrame, checks: DataFrame) -> DataFrame:
    """Requests of a year that is not ready: correlation_id and error,
    naming the checks of the year, and the tables, that did not pass.
    ``checks`` comes from ``check_prerequisites``; a year it does not know is not ready."""
    failed = checks.filter(~F.col("passed") & (F.col("check_name") != "ready"))
    by_year = failed.filter(F.col("measurement_year").isNotNull()).groupBy("measurement_year").agg(F.array_sort(F.collect_set("check_name")).alias("_failed"))
    tables = failed.filter(F.col("measurement_year").isNull()).agg(F.array_sort(F.collect_set("check_name")).alias("t")).scalar()
    ready = checks.filter((F.col("check_name") == "ready") & F.col("passed")).select("measurement_year")
    late = requests.select("correlation_id", "measurement_year").distinct().join(bounded_broadcast(ready), "measurement_year", "left_anti")
    late = late.join(bounded_broadcast(by_year), "measurement_year", "left")
    why = F.concat(F.coalesce(F.col("_failed"), F.array().cast("array<string>")), F.coalesce(tables, F.array().cast("array<string>")))
    reason = F.when(F.size(why) > 0, F.array_join(why, ",")).otherwise(F.lit("no stage status"))
    return late.select("correlation_id", F.concat(F.lit("year "), F.col("measurement_year").cast("string"), F.lit(" not ready: "), reason).alias("error"))


def table_exists_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: is it non-empty (reads at most one row each)."""
    rows = [
        df.limit(1).agg((F.count(F.lit(1)) > 0).alias("passed")).select(
            F.lit(f"table:{name}").alias("check_name"), F.lit(None).cast("int").alias("measurement_year"), "passed"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def check_prerequisites(stage_status: DataFrame, tables: dict[str, DataFrame], stages=REQUIRED_STAGES, more: DataFrame | None = None) -> DataFrame:
    """Stage checks per year (MP, PP, FQR complete), table checks, and a
    ``ready`` row per year that is true only when everything passed. ``more``: further
    checks by year (check_name, measurement_year, passed), such as those of the raw extracts."""
    st = stage_status.filter(F.col("stage").isin(*stages)).select(
        F.col("stage").alias("check_name"), "measurement_year", F.col("is_complete").alias("passed")
    )
    tb = table_exists_checks(tables) if tables else None
    # the table verdict is one value: a scalar subquery, evaluated once (no join)
    tables_ok = F.lit(True) if tb is None else tb.agg(F.bool_and("passed")).scalar()
    own = F.col("check_name").isin(*stages)
    st = st if more is None else st.unionByName(more)
    per_year = st.groupBy("measurement_year").agg(F.bool_and("passed").alias("_stages_ok"), F.count_distinct(F.when(own, F.col("check_name"))).alias("_n"))
    ready = per_year.select(
        F.lit("ready").alias("check_name"),
        "measurement_year",
        (F.col("_stages_ok") & (F.col("_n") == len(stages)) & tables_ok).alias("passed"),
    )
    return (st if tb is None else st.unionByName(tb)).unionByName(ready)


def sampled_keys(sample: DataFrame, keys=("submission_id", "measurement_year")) -> DataFrame:
    """Submission-years that already have a stored sample."""
    return sample.select(*keys).distinct()


def read_current(spark, root: str) -> DataFrame:
    """The newest version: the last one published through the ledger, else the max version (a scalar subquery)."""
    published = Ledger(spark, f"{root}_ledger").read(last_only=True)
    if published is not None:
        return published
    t = spark.read.parquet(root)
    newest = t.agg(F.max("version")).scalar()
    return t.filter(F.col("version") == newest).drop("version")

"""Sample sizes: rate -> MRSS band, defaults, oversampling, FSS, RAND."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hybrid_sampling.functions.exact import final_size
from hybrid_sampling.operators.joins import bounded_broadcast

# ---------------------------------------------------------------- fixed values
DEFAULT_MRSS = 411
DEFAULT_OS_PCT = "10.00"
OS_CAP_PCT = "20.00"
# ------------------------------------------------------------------------------


def band_intervals(bands: DataFrame) -> DataFrame:
    """Each band as a half-open rate interval [rate_floor, next floor) per year
    and product line (the small table gets its upper bound from a window)."""
    w = Window.partitionBy("measurement_year", "product_line").orderBy("rate_floor")
    return bands.withColumn("rate_ceiling", F.lead("rate_floor").over(w))


def size_for_rate(factors: DataFrame, bands: DataFrame, rate_col: str = "rate", out_col: str = "mrss_band") -> DataFrame:
    """Sample size of the band with the greatest floor <= rate.

    An as-of lookup on a small table: equi-join on year and product line plus
    floor <= rate < next floor, so each factor matches at most one band and no
    aggregation or shuffle of the factors is needed (bands are broadcast).
    """
    b = band_intervals(bands).select(
        F.col("measurement_year").alias("_b_year"),
        F.col("product_line").alias("_b_line"),
        "rate_floor",
        "rate_ceiling",
        F.col("sample_size").alias(out_col),
    )
    r = F.col(rate_col)
    cond = (
        (F.col("measurement_year") == F.col("_b_year"))
        & (F.col("product_line") == F.col("_b_line"))
        & (F.col("rate_floor") <= r)
        & (F.col("rate_ceiling").isNull() | (r < F.col("rate_ceiling")))
    )
    return factors.join(bounded_broadcast(b), cond, "left").drop("_b_year", "_b_line", "rate_floor", "rate_ceiling")


def default_mrss(df: DataFrame, band_col: str = "mrss_band", info_col: str = "info_sample_size", default: int = DEFAULT_MRSS) -> DataFrame:
    """band size, else the metadata size, else 411."""
    return df.withColumn("mrss", F.coalesce(F.col(band_col), F.col(info_col), F.lit(default)).cast("bigint"))


def check_oversampling(
    df: DataFrame,
    approvals: DataFrame | None = None,
    request_col: str = "oversampling_rate",
    info_col: str = "info_os_pct",
    keys=("submission_id", "measure_code"),
) -> DataFrame:
    """F8: oversampling percent = request value, else metadata, else 10; above 20
    only with an approval row for (submission, measure), otherwise capped at 20
    and flagged."""
    os_in = F.coalesce(F.col(request_col), F.col(info_col), F.lit(DEFAULT_OS_PCT).cast("decimal(5,2)")).cast("decimal(5,2)")
    out = df.withColumn("os_requested", os_in)
    if approvals is not None:
        a = approvals.select(*keys).distinct().withColumn("_approved", F.lit(True))
        out = out.join(a, list(keys), "left")
    else:
        out = out.withColumn("_approved", F.lit(None).cast("boolean"))
    cap = F.lit(OS_CAP_PCT).cast("decimal(5,2)")
    capped = (F.col("os_requested") > cap) & ~F.coalesce(F.col("_approved"), F.lit(False))
    out = out.withColumn("os_capped", capped)
    out = out.withColumn("os_pct", F.when(capped, cap).otherwise(F.col("os_requested")).cast("decimal(5,2)"))
    return out.drop("_approved")


def final_sizes(df: DataFrame, mrss_col: str = "mrss", os_col: str = "os_pct") -> DataFrame:
    """FSS = ceil(MRSS * (1 + os%)) in integers (no float error, D18)."""
    return df.withColumn("fss", final_size(F.col(mrss_col), F.col(os_col)))


def attach_rand(df: DataFrame, rand_values: DataFrame, default: str | None = None) -> DataFrame:
    """RAND by measure and year; missing stays null (an error downstream)
    unless a default is opted in."""
    # one value per key even if the table repeats a key (never fan factors out)
    r = rand_values.groupBy("measure_code", "measurement_year").agg(F.min(F.col("rand").cast("decimal(9,6)")).alias("rand"))
    out = df.join(bounded_broadcast(r), ["measure_code", "measurement_year"], "left")
    if default is not None:
        out = out.withColumn("rand", F.coalesce(F.col("rand"), F.lit(default).cast("decimal(9,6)")))
    return out

"""Rate resolution: request sub-measure rates -> one rate per measure.

Rates stay ``decimal(5,2)`` throughout (D11): a string-typed null branch would
make ``min`` compare text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hybrid_sampling.operators.joins import bounded_broadcast

# ---------------------------------------------------------------- fixed values
INVERSE_SUBMEASURES = ("HBD2", "GSD2")
DROPPED_SUBMEASURES = ("HBD1", "GSD1", "BPD")
DROPPED_PRODUCT_LINES = ("Exchange",)
PYR_ONLY_MEASURES = ("TRC",)
# ------------------------------------------------------------------------------

FACTOR_KEYS = [
    "correlation_id",
    "product_line",
    "measure_code",
    "oversampling_rate",
    "measurement_year",
    "submission_id",
    "organization_id",
    "run_config_id",
    "exclude_emp",
]


def invert_rates(df: DataFrame, codes=INVERSE_SUBMEASURES) -> DataFrame:
    """100 - rate for inverse sub-measures (null stays null)."""
    inv = F.col("clinical_measure_id").isin(*codes)
    out = df
    for c in ("cyar", "pyr"):
        out = out.withColumn(c, F.when(inv & F.col(c).isNotNull(), (F.lit(100) - F.col(c)).cast("decimal(5,2)")).otherwise(F.col(c)))
    return out


def drop_submeasures(df: DataFrame, codes=DROPPED_SUBMEASURES) -> DataFrame:
    """Drop listed sub-measures and, explicitly, rows without an id."""
    return df.filter(F.col("clinical_measure_id").isNotNull() & ~F.col("clinical_measure_id").isin(*codes))


def drop_product_lines(df: DataFrame, lines=DROPPED_PRODUCT_LINES) -> DataFrame:
    """Drop excluded product lines (Exchange)."""
    return df.filter(~F.coalesce(F.col("product_line").isin(*lines), F.lit(False)))


def attach_size_info(req: DataFrame, info: DataFrame) -> DataFrame:
    """Left join size metadata on measure, product line and year."""
    i = info.select(
        "measure_code",
        "product_line",
        "measurement_year",
        F.col("sample_size").alias("info_sample_size"),
        F.col("oversampling_rate").alias("info_os_pct"),
        F.col("cyar").alias("cyar_flag"),
        F.col("pyr").alias("pyr_flag"),
    )
    return req.join(bounded_broadcast(i), ["measure_code", "product_line", "measurement_year"], "left")


def attach_product_category(req: DataFrame, categories: DataFrame) -> DataFrame:
    """Keep requests whose submission and year have the product category
    that the request names; a semi join cannot fan rows out."""
    keys = ["submission_id", "measurement_year"]
    cat = categories.select(*keys, F.col("product_category").alias("product_line")).distinct()
    return req.join(cat, [*keys, "product_line"], "left_semi")


def gate_rates(df: DataFrame, pyr_only=PYR_ONLY_MEASURES) -> DataFrame:
    """metadata text flags pick which rate counts; some measures use PYR only."""
    cy = F.when((F.col("cyar_flag") == "CYAR") & ~F.col("measure_code").isin(*pyr_only), F.col("cyar"))
    py = F.when(F.col("pyr_flag") == "PYR", F.col("pyr"))
    return df.withColumn("cyar_used", cy.cast("decimal(5,2)")).withColumn("pyr_used", py.cast("decimal(5,2)"))


def combine_rates(min_cyar, min_pyr, mode: str = "least"):
    """lowest of the two (null-skipping) or the first non-null (CYAR first)."""
    if mode == "least":
        return F.least(min_cyar, min_pyr)
    if mode == "coalesce":
        return F.coalesce(min_cyar, min_pyr)
    raise ValueError(f"unknown rate mode {mode!r}")


def resolve_factors(gated: DataFrame, mode: str = "least", keys: list[str] = FACTOR_KEYS) -> DataFrame:
    """A3 + F3: lowest CYAR and PYR over a measure's sub-measures, then one rate."""
    agg = gated.groupBy(*keys).agg(
        F.min("cyar_used").alias("min_cyar"),
        F.min("pyr_used").alias("min_pyr"),
        F.max("info_sample_size").alias("info_sample_size"),
        F.max("info_os_pct").alias("info_os_pct"),
        *[F.max(c).alias(c) for c in ("domain_id", "campaign_id", "shared_sample_group") if c in gated.columns],
    )
    return agg.withColumn("rate", combine_rates(F.col("min_cyar"), F.col("min_pyr"), mode).cast("decimal(5,2)"))


def shared_rate(factors: DataFrame, groups: DataFrame, key: str = "correlation_id") -> DataFrame:
    """A5: a measure in a shared-sample group takes the lowest rate of its group
    (within the same request); other measures keep their own rate. Groups come
    from ``groups`` (metadata) unless the request lists its own
    (``shared_sample_group``), named by its sorted codes joined with '+'."""
    f = factors.join(bounded_broadcast(groups.select("measure_code", "shared_group")), "measure_code", "left")
    if "shared_sample_group" in f.columns:
        # a request that names its shared group overrides the metadata groups
        req = F.col("shared_sample_group")
        chosen = F.when(F.array_contains(req, F.col("measure_code")), F.array_join(F.array_sort(req), "+"))
        f = f.withColumn("shared_group", F.when(req.isNotNull(), chosen).otherwise(F.col("shared_group")))
    # one shuffle; a window partition holds one request's measures of one group
    group_low = F.min("rate").over(Window.partitionBy(key, "shared_group"))
    return f.withColumn("shared_rate", F.when(F.col("shared_group").isNull(), F.col("rate")).otherwise(group_low))


def split_conflicts(factors: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Factor rows that alone stand for their sampling group, and per request the
    measures that more than one row asks for: (factors, conflicts with
    correlation_id and error). Nothing is picked: each claimant is reported."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    counted = factors.withColumn("_claims", n)
    clash = counted.filter("_claims > 1").groupBy("correlation_id").agg(
        F.concat(F.lit("conflicting factors for "), F.array_join(F.array_sort(F.collect_set("measure_code")), ",")).alias("error")
    )
    return counted.filter("_claims = 1").drop("_claims"), clash


def sampling_factors(
    requests_flat: DataFrame,
    info: DataFrame,
    categories: DataFrame,
    mode: str = "least",
    inverse=INVERSE_SUBMEASURES,
    dropped=DROPPED_SUBMEASURES,
) -> DataFrame:
    """request rows -> resolved factors, one row per request and measure.
    ``inverse`` / ``dropped`` are the sub-measure sets (D12, D13)."""
    r = drop_product_lines(drop_submeasures(invert_rates(requests_flat, inverse), dropped))
    r = attach_product_category(attach_size_info(r, info), categories)
    return resolve_factors(gate_rates(r), mode)

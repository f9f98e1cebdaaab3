"""After the draw: exclusions, replacement from the auxiliary list, shared
samples, output columns and counts (R1-R6, A5, A6, U2). The draw labels both
lists in one pass (U1), so no union is needed.

Windows here are keyed by sampling group over the *drawn* sample, which holds
at most FSS rows per group (a metadata-bounded size), never the population.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hybrid_sampling.operators.draw import AUXILIARY, PRIMARY
from hybrid_sampling.operators.joins import bounded_broadcast

EXCLUDED = "Excluded"


def replace_excluded(flagged: DataFrame, group_cols: list[str], order_col: str = "sample_order") -> DataFrame:
    """R2: the k-th excluded Primary (in sample order) is replaced by the k-th
    valid Auxiliary. Adds final_list (Primary / Auxiliary / Excluded),
    replaces_order (sample order of the replaced primary) and, per group,
    shortfall = excluded primaries that found no valid auxiliary.

    Windows over the drawn sample (partitioned by group, at most FSS rows each): running counts
    number the holes and the valid auxiliaries, and rows of the same group and number
    meet in a second window that shares the shuffle. No row carries a list of the others, and
    nothing is joined, so the sample is read once.
    """
    g = Window.partitionBy(*group_cols).orderBy(order_col)
    whole = g.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = g.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hole = (F.col("list_type") == PRIMARY) & F.col("is_excluded")
    fill = (F.col("list_type") == AUXILIARY) & ~F.col("is_excluded")
    number = F.when(hole, F.count_if(hole).over(running)).when(fill, F.count_if(fill).over(running))
    f = flagged.withColumns({"_k": number, "_n_aux": F.count_if(fill).over(whole), "_n_holes": F.count_if(hole).over(whole)})
    pair = Window.partitionBy(*group_cols, "_k")
    out = f.withColumn("replaces_order", F.when(fill, F.max(F.when(hole, F.col(order_col))).over(pair)))
    final = (
        F.when(F.col("is_excluded"), EXCLUDED)
        .when(F.col("list_type") == PRIMARY, PRIMARY)
        .when(F.col("replaces_order").isNotNull(), PRIMARY)
        .otherwise(AUXILIARY)
    )
    out = out.withColumn("final_list", final)
    out = out.withColumn("shortfall", F.greatest(F.col("_n_holes") - F.col("_n_aux"), F.lit(0)).cast("bigint"))
    return out.drop("_k", "_n_holes", "_n_aux")


def spread_exclusions(invalid: DataFrame, groups: DataFrame) -> DataFrame:
    """A measure-specific exclusion applies to every measure of its shared
    group; exclusions without a measure (all measures) pass through."""
    g = groups.filter(F.col("shared_group").isNotNull()).select("measure_code", "shared_group")
    g_b = bounded_broadcast(g)
    with_group = invalid.join(g_b, "measure_code", "left")
    siblings = g_b.select(F.col("shared_group"), F.col("measure_code").alias("_sibling"))
    spread = with_group.join(siblings, "shared_group", "left")
    return spread.select("patient_id", F.coalesce(F.col("_sibling"), F.col("measure_code")).alias("measure_code"), "reason").distinct()


def shared_sizes(factors: DataFrame, group_cols: list[str]) -> DataFrame:
    """One size row per shared group: the member measure with the largest
    MRSS (the lowest rate), then the larger oversampling, then the first code."""
    # a measure without a size cannot set the group's size (nulls would sort first)
    f = factors.filter(F.col("shared_group").isNotNull() & F.col("mrss").isNotNull())
    pick = F.min(F.struct(-F.col("mrss"), -F.col("os_pct"), F.col("measure_code"), F.col("mrss").alias("m"), F.col("os_pct").alias("o"), F.col("rand").alias("r")))
    agg = f.groupBy(*group_cols).agg(pick.alias("_p"))
    return agg.select(*group_cols, F.col("_p.m").alias("mrss"), F.col("_p.o").alias("os_pct"), F.col("_p.r").alias("rand"))


def shared_population(population: DataFrame, group_cols: list[str], attrs=("last_name", "first_name", "date_of_birth")) -> DataFrame:
    """Distinct members eligible for any measure of a shared group
    (member grain; earliest event date over the group's measures)."""
    p = population.filter(F.col("shared_group").isNotNull())
    return p.groupBy(*group_cols, "patient_id", *attrs).agg(F.min("event_date").alias("event_date")).withColumn("visit_id", F.lit(None).cast("bigint"))


def emit_for_measures(shared_sample: DataFrame, groups: DataFrame) -> DataFrame:
    """The one shared list, emitted once for every measure of its group."""
    g = groups.filter(F.col("shared_group").isNotNull()).select("shared_group", "measure_code")
    return shared_sample.join(bounded_broadcast(g), "shared_group", "inner")


def to_output(final: DataFrame, domain: str = "HEDIS") -> DataFrame:
    """Output columns with their audit fields. Campaign and domain come
    from the request when it names them, else CMP-<submission>-<year> and
    ``domain``."""
    default_campaign = F.concat(F.lit("CMP-"), F.col("submission_id").cast("string"), F.lit("-"), F.col("measurement_year").cast("string"))
    campaign = F.coalesce(F.col("campaign_id"), default_campaign) if "campaign_id" in final.columns else default_campaign
    dom = F.coalesce(F.col("domain_id"), F.lit(domain)) if "domain_id" in final.columns else F.lit(domain)
    return final.select(
        "submission_id",
        campaign.alias("campaign_id"),
        "run_config_id",
        dom.alias("domain_id"),
        "product_line",
        "measure_code",
        F.col("patient_id").alias("member_id"),
        "visit_id",
        "measurement_year",
        "population_rank",
        "sample_order",
        F.col("rand").cast("decimal(9,6)").alias("rand"),
        "list_type",
        (F.col("final_list") == PRIMARY).alias("is_primary"),
        "is_excluded",
        "exclusion_reason",
        "mrss_actual",
    )


def sample_summary(final: DataFrame, group_cols: list[str]) -> DataFrame:
    """Counts per group as data (no printing)."""
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return final.groupBy(*group_cols).agg(
        F.max("em").alias("em"),
        F.max("mrss_actual").alias("mrss_actual"),
        F.max("os_actual").alias("os_actual"),
        F.count(F.lit(1)).cast("bigint").alias("drawn"),
        n(F.col("list_type") == PRIMARY).alias("primary_drawn"),
        n(F.col("list_type") == AUXILIARY).alias("auxiliary_drawn"),
        n(F.col("is_excluded")).alias("excluded"),
        n(F.col("replaces_order").isNotNull()).alias("replaced"),
        n(F.col("final_list") == PRIMARY).alias("final_primary"),
        F.max("shortfall").alias("shortfall"),
    )

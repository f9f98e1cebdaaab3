"""Sample planning and the systematic draw (scenarios A, B, C).

Per sampling group, with EM eligible units, MRSS, FSS = ceil(MRSS * (1 + os%)):
  A  EM <= MRSS         every unit, all Primary
  B  MRSS < EM <= FSS   every unit; the first MRSS by rank are Primary
  C  EM > FSS           FSS systematic picks; the first MRSS picks are Primary
All arithmetic is exact (see ``functions.exact``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybrid_sampling.functions.exact import draw_index, final_size, interval_n, position_of, start_position
from hybrid_sampling.operators.joins import bounded_broadcast
from hybrid_sampling.operators.ranking import rank_population

PRIMARY, AUXILIARY = "Primary", "Auxiliary"


def plan_samples(
    counts: DataFrame, sizes: DataFrame, group_cols: list[str], size_keys: list[str] | None = None, sizes_bound: int | None = None
) -> DataFrame:
    """One row per group: em, mrss, os_pct, fss, scenario, n_interval, start_pos,
    rand, mrss_actual, os_actual, sample_total, plan_error.

    ``counts``: group_cols + em. ``sizes``: size_keys + mrss, os_pct, rand.
    ``sizes`` has one row per ``size_keys``. A group without a usable size row
    keeps nulls and gets ``plan_error``.
    """
    size_keys = size_keys or group_cols
    # what follows from the sizes alone is computed on their side of the join, a row a group asked for
    mrss = F.col("mrss").cast("bigint")
    fss = F.when(mrss > 0, final_size(mrss, F.col("os_pct")))
    sz = sizes.select(*size_keys, mrss.alias("mrss"), "os_pct", "rand", size_error(mrss, F.col("rand")).alias("_error"), fss.alias("_fss"))
    p = counts.join(bounded_broadcast(sz, sizes_bound), size_keys, "left")
    em, mrss, rand = F.col("em").cast("bigint"), F.col("mrss"), F.col("rand")
    p = p.withColumn("plan_error", F.when(mrss.isNull(), F.lit("missing sample size")).when(F.col("_fss").isNull() | (em > F.col("_fss")), F.col("_error")))
    # a group in error gets no numbers at all: nothing below divides by its sizes
    p = p.withColumn("fss", F.when(F.col("plan_error").isNull(), F.col("_fss"))).drop("_error", "_fss")
    mrss = F.when(F.col("plan_error").isNull(), mrss)
    p = p.withColumn("scenario", F.when(em <= mrss, "A").when(em <= F.col("fss"), "B").when(F.col("fss").isNotNull(), "C"))
    is_c = F.col("scenario") == "C"
    p = p.withColumn("n_interval", F.when(is_c, interval_n(em, F.when(is_c, F.col("fss")))))
    p = p.withColumn("start_pos", F.when(is_c, start_position(rand, F.col("n_interval"))))
    p = p.withColumn("mrss_actual", F.least(mrss, em))
    p = p.withColumn(
        "os_actual",
        F.when(F.col("scenario") == "A", F.lit(0).cast("bigint"))
        .when(F.col("scenario") == "B", em - mrss)
        .when(is_c, F.col("fss") - mrss),
    )
    p = p.withColumn("sample_total", F.when(is_c, F.col("fss")).when(F.col("scenario").isNotNull(), em))
    return p.withColumn("em", em).withColumn("mrss", F.col("mrss").cast("bigint"))


def size_error(mrss, rand):
    """What is wrong with a group's sizes, or null: the sample size must be
    positive and RAND, where it is needed, in [0, 1]."""
    return (
        F.when(mrss.isNull(), F.lit("missing sample size"))
        .when(mrss <= 0, F.lit("sample size not positive"))
        .when(rand.isNull(), F.lit("missing RAND"))
        .when((rand < 0) | (rand > 1), F.lit("RAND outside 0 to 1"))
    )


def draw_population(units: DataFrame, sizes: DataFrame, group_cols: list[str], num_partitions: int | None = None, sizes_bound: int | None = None) -> DataFrame:
    """Rank, plan and draw: the plan of a group is made on the rank's table of pieces (a row for each range of a
    group), and a unit meets only the finished plan with the test whether its rank is picked."""
    plan = lambda pieces: plan_samples(pieces, sizes, group_cols, sizes_bound=sizes_bound)
    ranked = rank_population(units, group_cols, num_partitions=num_partitions, groups_bound=sizes_bound, size_col="em", plan=plan)
    return select_sample(ranked)


def sample_positions(plans: DataFrame, group_cols: list[str]) -> DataFrame:
    """Audit list of scenario-C pick positions: pick_index, sample_order, position."""
    c = plans.filter((F.col("scenario") == "C") & F.col("start_pos").isNotNull())
    c = c.select(*group_cols, "em", "fss", "start_pos", F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("fss") - 1)).alias("pick_index", "_v"))
    return c.select(
        *group_cols,
        F.col("pick_index").cast("bigint").alias("pick_index"),
        (F.col("pick_index") + 1).cast("bigint").alias("sample_order"),
        position_of(F.col("pick_index"), F.col("em"), F.col("fss"), F.col("start_pos")).alias("position"),
    )


def select_sample(planned: DataFrame, rank_col: str = "population_rank") -> DataFrame:
    """Keep the drawn units of ranked rows that carry their group's plan columns;
    adds sample_order and list_type. Narrow per-row test, no index list."""
    p = planned.filter(F.col("plan_error").isNull())
    r = F.col(rank_col)
    pick = draw_index(r, F.col("em"), F.col("fss"), F.col("start_pos"))
    order = F.when(F.col("scenario") == "C", pick + 1).otherwise(r)
    p = p.withColumn("sample_order", order.cast("bigint")).filter(F.col("sample_order").isNotNull())
    return p.withColumn("list_type", F.when(F.col("sample_order") <= F.col("mrss_actual"), PRIMARY).otherwise(AUXILIARY))

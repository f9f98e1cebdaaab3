"""The sampling chain over the proxy submission: population -> rank -> plan ->
draw -> exclusions -> replacement, and the shared-group draw.

A ``Run`` holds one query's inputs: the factor table (one row per sampling
group, request metadata of known size) and that size as the proven bound for
every broadcast keyed by group.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from hybrid_sampling.operators import draw as D
from hybrid_sampling.operators import eligibility as E
from hybrid_sampling.operators import replacement as R
from hybrid_sampling.operators.ranking import rank_population
from hybrid_sampling.plans import proxy as P

GROUP = P.GROUP
UNIT = ["patient_id", "visit_id"]
SHARED = ["submission_id", "product_line", "shared_group", "measurement_year"]


class Run:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def factors(self) -> DataFrame:
        return P.sampling_factors(self.spark, self.sf_dir)

    @property
    def groups_bound(self) -> int:
        # one group per measure and year of the facts
        return len(P.MEASURE_META) * len(P.years(self.spark, self.sf_dir))


def population(run: Run) -> DataFrame:
    """Eligible units of every measure and year of the proxy submission."""
    s, d = run.spark, run.sf_dir
    return E.eligible_population(
        P.facts(s, d),
        run.factors,
        P.reporting_periods(s, d),
        P.measure_classification(s),
        P.enrollment(s, d),
        P.members(s, d),
        GROUP,
        factors_bound=run.groups_bound,
    )


def ranked(run: Run, num_partitions: int | None = None) -> DataFrame:
    return rank_population(population(run), GROUP, num_partitions=num_partitions, groups_bound=run.groups_bound, size_col="em")


def plans(run: Run) -> DataFrame:
    counts = E.eligible_counts(population(run), GROUP)
    return D.plan_samples(counts, run.factors, GROUP, sizes_bound=run.groups_bound)


def drawn(run: Run, num_partitions: int | None = None) -> DataFrame:
    """The drawn sample: the rank knows each group's size, so its plan is made
    there and no second pass over the population is needed."""
    return D.draw_population(population(run), run.factors, GROUP, num_partitions, run.groups_bound)


def final(run: Run) -> DataFrame:
    """Drawn sample -> exclusions flagged -> replacements."""
    flagged = E.flag_exclusions(drawn(run), P.invalid_members(run.spark, run.sf_dir))
    return R.replace_excluded(flagged, GROUP)


def shared_drawn(run: Run) -> DataFrame:
    """One draw per shared group over the union of its measures' members,
    emitted for every measure of the group."""
    pop = R.shared_population(population(run), SHARED)
    sizes = R.shared_sizes(run.factors, SHARED)
    d = D.draw_population(pop, sizes, SHARED, sizes_bound=run.groups_bound)
    return R.emit_for_measures(d, P.measure_meta(run.spark))

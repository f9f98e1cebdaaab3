"""The criteria catalogue (G1-G6, E15, E16): who may be sampled for a measure, as stored tables.

``measure_criteria`` has a row per measure (a null measure: all that have no row of their own):
min_age, max_age, gender, min_months, allowed_gaps, event_type, needs_association. A null asks for nothing. The catalogue compiles
to one pass over the eligible units: predicates on the small rule row of each measure, and one join for each table that
some measure asks for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybrid_sampling.operators import eligibility as E
from hybrid_sampling.operators.joins import bounded_broadcast

# fixed values: the catalogue's columns
RULE_COLUMNS = ("measure_code", "min_age", "max_age", "gender", "min_months", "allowed_gaps", "event_type", "needs_association")


@dataclass
class Catalogue:
    """``rules`` are ``measure_criteria``; the others hold what they ask about. ``members``: patient_id, gender,
    organization_id; ``spans``: enrollment; ``events``: patient_id, measurement_year, event_type; ``associations``:
    organization_id; ``invalid``: patient_id, measure_code (null: all), reason; ``lines``: product_line."""

    rules: DataFrame
    members: DataFrame | None = None
    spans: DataFrame | None = None
    events: DataFrame | None = None
    associations: DataFrame | None = None
    invalid: DataFrame | None = None
    lines: DataFrame | None = None

    #: the column of the rules that asks for each table
    ASKED = {"members": "gender", "spans": "min_months", "events": "event_type", "associations": "needs_association"}

    def missing(self) -> list[str]:
        """Tables that a rule asks for and that are not there: the run must not go on without them."""
        asked = self.rules.agg(*[F.count_if(F.col(c).isNotNull() if c != "needs_association" else F.col(c)).alias(t) for t, c in self.ASKED.items()]).first()
        lack = [t for t in self.ASKED if asked[t] and getattr(self, t) is None]
        return lack + ["members"] if asked["associations"] and self.members is None and "members" not in lack else lack


def apply_catalogue(units: DataFrame, c: Catalogue, years: tuple[int, ...], rules_bound: int | None = None) -> DataFrame:
    """Eligible units that meet every criterion of their measure, before anything is counted or ranked."""
    lack = c.missing()
    if lack:
        raise ValueError(f"criteria ask for tables that are missing: {', '.join(lack)}")
    out = units
    if c.lines is not None:
        out = out.join(bounded_broadcast(c.lines.select("product_line").distinct()), "product_line", "left_semi")
    else:
        out = E.valid_product_line(out)
    rules = _with_columns(c.rules)
    out = out.join(bounded_broadcast(rules.filter(F.col("_r_measure").isNotNull()), rules_bound), F.col("measure_code") == F.col("_r_measure"), "left")
    general = _with_columns(c.rules).filter(F.col("_r_measure").isNull()).agg(F.first(F.struct(*[f"_r_{x}" for x in RULE_COLUMNS[1:]])).alias("g"))
    out = out.withColumn("_g", general.scalar())
    for x in RULE_COLUMNS[1:]:  # a measure's own row as a whole, else the general one
        out = out.withColumn(f"_r_{x}", F.when(F.col("_r_measure").isNotNull(), F.col(f"_r_{x}")).otherwise(F.col(f"_g._r_{x}")))
    age = E.age_at_year_end()
    out = out.filter((F.col("_r_min_age").isNull() | (age >= F.col("_r_min_age"))) & (F.col("_r_max_age").isNull() | (age <= F.col("_r_max_age"))))
    if c.invalid is not None:
        out = E.exclude(out, c.invalid)
    if c.members is not None:
        who = c.members.select("patient_id", F.col("gender").alias("_gender"), F.col("organization_id").alias("_org"))
        out = out.join(who, "patient_id", "left").filter(F.col("_r_gender").isNull() | (F.col("_gender") == F.col("_r_gender")))
    if c.associations is not None:
        valid = c.associations.select(F.col("organization_id").alias("_org")).distinct().withColumn("_valid", F.lit(True))
        out = out.join(valid, "_org", "left").filter(~F.coalesce("_r_needs_association", F.lit(False)) | F.col("_valid"))
    if c.spans is not None:
        months = E.enrolled_months(c.spans, years).select("patient_id", "measurement_year", F.col("covered_months").alias("_months"), F.col("island_count").alias("_islands"))
        out = out.join(months, ["patient_id", "measurement_year"], "left")
        gaps = F.coalesce("_r_allowed_gaps", F.lit(0))
        out = out.filter(F.col("_r_min_months").isNull() | (F.col("_months") >= F.col("_r_min_months")) & (F.col("_islands") <= gaps + 1))
    if c.events is not None:
        seen = c.events.select("patient_id", "measurement_year", F.col("event_type").alias("_r_event_type")).distinct().withColumn("_event", F.lit(True))
        out = out.join(seen, ["patient_id", "measurement_year", "_r_event_type"], "left").filter(F.col("_r_event_type").isNull() | F.col("_event"))
    return out.select(*units.columns)


def _with_columns(rules: DataFrame) -> DataFrame:
    return rules.select(F.col("measure_code").alias("_r_measure"), *[F.col(x).alias(f"_r_{x}") for x in RULE_COLUMNS[1:]])

"""Eligible population: filters, dimension joins and the documented criteria.

Everything is a DataFrame -> DataFrame step; small sides (factors, periods,
classification, rules) go through ``bounded_broadcast`` (a hint only with a
proven bound, otherwise Spark's size statistics decide), dimension and fact
sides join by shuffle. Facts are reduced to the sampling grain (member or
visit) before they meet the patient dimension.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hybrid_sampling.operators.episodes import to_episodes
from hybrid_sampling.operators.joins import bounded_broadcast

# ---------------------------------------------------------------- fixed values
ELIGIBLE_STATUS = (1, 6, 15)
VALID_PRODUCT_LINES = ("Commercial", "Medicaid", "Medicare")
# exclusion reasons in priority order (the first one found is kept)
EXCLUSION_PRIORITY = ("deceased", "hospice", "employee", "duplicate", "data error")
# ------------------------------------------------------------------------------

SCOPE_KEYS = ["run_config_id", "organization_id", "submission_id", "measure_code", "measurement_year"]


def filter_status(df: DataFrame, codes=ELIGIBLE_STATUS) -> DataFrame:
    """Clinical status in the eligible set."""
    return df.filter(F.col("clinical_status_code").isin(*codes))


def filter_live(df: DataFrame) -> DataFrame:
    """Not deleted."""
    return df.filter(F.col("is_deleted") == 0)


def non_empty_measure(df: DataFrame, col: str = "measure_code") -> DataFrame:
    """P10: measure present and non-empty."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def scope(base: DataFrame, factors: DataFrame, keys: list[str] = SCOPE_KEYS, carry: list[str] | None = None, factors_bound: int | None = None) -> DataFrame:
    """Keep fact rows of the requested run, organization, submission,
    measure and year, for all measures at once; carries factor columns along.

    Facts that name their product line meet only the factors of that line; others
    meet those of every requested line, and the member's line decides (see
    ``eligible_population``). ``factors`` holds one row per line and ``keys``
    (``factors.split_conflicts`` takes the rest out and reports it)."""
    keys = keys + [c for c in ("product_line",) if c in base.columns and c in factors.columns]
    carry = carry if carry is not None else [c for c in factors.columns if c not in keys and c not in base.columns]
    f = factors.select(*keys, *[c for c in carry if c not in keys])
    return base.join(bounded_broadcast(f, factors_bound), keys, "inner")


def requested_only(base: DataFrame, requested: DataFrame, key: str = "measure_code") -> DataFrame:
    """Measure named in the request (IN-subquery as a semi join)."""
    return base.join(bounded_broadcast(requested.select(key).distinct()), key, "left_semi")


def hybrid_only(base: DataFrame, classification: DataFrame, value: str = "Hybrid") -> DataFrame:
    """Clinical measure classified as hybrid."""
    h = classification.filter(F.col("classification_value") == value).select("clinical_measure_id")
    return base.join(bounded_broadcast(h), "clinical_measure_id", "left_semi")


def attach_measure(df: DataFrame, meta: DataFrame, how: str = "inner") -> DataFrame:
    """Measure metadata (grain, shared group)."""
    return df.join(bounded_broadcast(meta), "measure_code", how)


def filter_period(df: DataFrame, periods: DataFrame, mode: str = "exact", year_col: str = "measurement_year") -> DataFrame:
    """Reporting period of the measurement year.

    exact: period is exactly the calendar year; contains: period covers the
    year; start_year: period starts in the year.
    """
    j = df.join(bounded_broadcast(periods), "reporting_period_id", "inner")
    y = F.col(year_col)
    first, last = F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(31))
    if mode == "exact":
        cond = (F.col("period_start") == first) & (F.col("period_end") == last)
    elif mode == "contains":
        cond = (F.col("period_start") <= first) & (F.col("period_end") >= last)
    elif mode == "start_year":
        cond = F.year("period_start") == y
    else:
        raise ValueError(f"unknown period mode {mode!r}")
    return j.filter(cond).drop("period_start", "period_end")


def employees(enrollment: DataFrame, keys=("patient_id", "submission_id")) -> DataFrame:
    """Members with an employee span (E3, D25): the flag is pushed into the scan, so only employees move."""
    return enrollment.filter(F.col("is_employee") == 1).select(*keys).distinct()


def filter_employee(df: DataFrame, enrollment: DataFrame, flag_col: str = "exclude_emp", keys=("patient_id", "submission_id")) -> DataFrame:
    """With the exclude flag set, keep non-employees (null counts as 0);
    without it keep everyone."""
    e = employees(enrollment, keys).select(*[F.col(k).alias(f"_e_{k}") for k in keys])
    hit = F.coalesce(F.col(flag_col), F.lit(False))
    for k in keys:
        hit = hit & (F.col(k) == F.col(f"_e_{k}"))
    return df.join(e, hit, "left_anti")


def to_grain(df: DataFrame, group_cols: list[str], grain_col: str = "grain", carry=()) -> DataFrame:
    """One row per member (member grain) or per visit (visit grain),
    with the earliest event date. Partial aggregation before the shuffle.
    ``carry`` are columns fixed per group (from the factors) kept alongside."""
    unit_visit = F.when(F.col(grain_col) == "visit", F.col("visit_id"))
    return df.groupBy(*group_cols, *carry, grain_col, "patient_id", unit_visit.alias("visit_id")).agg(F.min("event_date").alias("event_date"))


def attach_patient(df: DataFrame, patients: DataFrame, cols=("last_name", "first_name", "date_of_birth")) -> DataFrame:
    """Names and birth date from the patient dimension."""
    return df.join(patients.select("patient_id", *cols), "patient_id", "inner")


def attach_visit(df: DataFrame, visits: DataFrame, cols=("facility_id",)) -> DataFrame:
    """Columns of the visit dimension, left-joined (a unit without a visit, or
    a visit the dimension lacks, keeps nulls). ``visits`` has one row per visit."""
    return df.join(visits.select("visit_id", *cols), "visit_id", "left")


def attach_event_date(df: DataFrame, dates: DataFrame, key: str = "visit_id", date_col: str = "event_date", keep_own: bool = False) -> DataFrame:
    """Earliest visit / discharge date per visit, left-joined; with
    ``keep_own`` a visit without one keeps its own date."""
    d = dates.groupBy(key).agg(F.min(date_col).alias("_first_date"))
    j = df.join(d, key, "left")
    date = F.coalesce(F.col("_first_date"), F.col(date_col)) if keep_own else F.col("_first_date")
    return j.withColumn(date_col, date).drop("_first_date")


def eligible_population(
    base: DataFrame,
    factors: DataFrame,
    periods: DataFrame,
    classification: DataFrame,
    enrollment: DataFrame,
    patients: DataFrame,
    group_cols: list[str],
    status_codes=ELIGIBLE_STATUS,
    period_mode: str = "exact",
    carry=("run_config_id", "organization_id", "shared_group"),
    factors_bound: int | None = None,
    derive: dict | None = None,
    visit_dates: DataFrame | None = None,
    episodes: DataFrame | None = None,
) -> DataFrame:
    """G7 + G8: eligible units (member or visit grain by measure) with their sort attributes.

    ``derive`` adds columns (name -> Column over fact and factor columns)
    before the grain reduction, so a derived key in ``group_cols`` (e.g. a
    shared sampling unit replacing the measure) is reduced in the same pass.
    ``visit_dates`` (visit_id, event_date; e.g. discharge dates) gives the
    event date used in the sort: the earliest per visit, else the fact's own.
    ``episodes`` (from ``episodes.visit_episodes``) makes one unit of each delivery or discharge
    for the measures whose factors name that ``anchor``.
    """
    b = non_empty_measure(filter_live(filter_status(base, status_codes)))
    b = hybrid_only(b, classification)
    # only the factor columns the population needs travel with the broadcast
    needed = [c for c in ("product_line", "exclude_emp", "grain", "anchor", *carry) if c in factors.columns and c not in SCOPE_KEYS and c not in b.columns]
    b = scope(b, factors, carry=list(dict.fromkeys(needed)), factors_bound=factors_bound)
    b = filter_period(b, periods, period_mode)
    if visit_dates is not None:
        b = attach_event_date(b, visit_dates, keep_own=True)
    if episodes is not None and "anchor" in b.columns:
        b = to_episodes(b, episodes)
    for name, col in (derive or {}).items():
        b = b.withColumn(name, col)
    # reduce to the grain first: the employee rule and the patient dimension
    # then join units, not every fact row
    keep = [c for c in list(carry) + ["exclude_emp"] if c not in group_cols and c in b.columns]
    g = to_grain(b, group_cols, carry=keep)
    g = filter_employee(g, enrollment)
    if "product_line" not in patients.columns or "product_line" in base.columns:
        return attach_patient(g, patients)
    # the member's own line: each line of a submission draws its members only
    own = patients.withColumnRenamed("product_line", "_member_line")
    cols = ("last_name", "first_name", "date_of_birth", "_member_line")
    return attach_patient(g, own, cols).filter(F.col("_member_line") == F.col("product_line")).drop("_member_line")


@dataclass
class Criteria:
    """Who may be sampled at all (G1-G6, E15): a criterion that is None is not applied.

    ``rules`` (measure_code, min_age, max_age, rule_gender) goes with ``members``
    (patient_id, gender); ``spans`` are enrollment spans; ``events`` have
    ``event_keys``; ``associations`` are the valid ``member_org`` values, with
    ``members`` naming each member's; ``invalid`` (patient_id, measure_code,
    reason) are members known to be invalid before the draw.
    """

    lines: tuple[str, ...] | None = VALID_PRODUCT_LINES
    members: DataFrame | None = None
    rules: DataFrame | None = None
    spans: DataFrame | None = None
    years: tuple[int, ...] = ()
    min_months: int = 11
    allowed_gaps: int = 0
    events: DataFrame | None = None
    event_keys: tuple[str, ...] = ("patient_id", "measurement_year")
    associations: DataFrame | None = None
    invalid: DataFrame | None = None


def apply_criteria(units: DataFrame, c: Criteria) -> DataFrame:
    """G1-G5 and E15 on eligible units, before anything is counted or ranked."""
    out = units
    if c.lines is not None:
        out = valid_product_line(out, c.lines)
    if c.invalid is not None:
        out = exclude(out, c.invalid)
    if c.members is not None:
        out = out.join(c.members, "patient_id", "inner")
        if c.rules is not None:
            out = age_gender(out, c.rules)
        if c.associations is not None:
            out = with_association(out, c.associations, "member_org")
    if c.spans is not None:
        months = enrolled_months(c.spans, c.years, min_months=c.min_months, allowed_gaps=c.allowed_gaps)
        out = out.join(months.filter("is_enrolled").select("patient_id", "measurement_year"), ["patient_id", "measurement_year"], "left_semi")
    if c.events is not None:
        out = with_event(out, c.events, c.event_keys)
    return out.select(*units.columns)


def eligible_counts(population: DataFrame, group_cols: list[str]) -> DataFrame:
    """Eligible units per group (members or visits, per the grain)."""
    return population.groupBy(*group_cols).agg(F.count(F.lit(1)).cast("bigint").alias("em"))


# ------------------------------------------------------------- documented criteria

def valid_product_line(df: DataFrame, lines=VALID_PRODUCT_LINES) -> DataFrame:
    """G1: product line in the valid set."""
    return df.filter(F.col("product_line").isin(*lines))


def age_at_year_end(dob_col: str = "date_of_birth", year_col: str = "measurement_year"):
    """Age on 31 December of the measurement year (birthday already passed)."""
    return (F.col(year_col) - F.year(dob_col)).cast("int")


def age_gender(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Keep rows inside the measure's age band and gender (null = any).
    ``rules``: measure_code, min_age, max_age, gender."""
    j = df.join(bounded_broadcast(rules), "measure_code", "inner")
    age = age_at_year_end()
    ok = (age >= F.col("min_age")) & (age <= F.col("max_age")) & (F.col("rule_gender").isNull() | (F.col("rule_gender") == F.col("gender")))
    return j.withColumn("age", age).filter(ok).drop("min_age", "max_age", "rule_gender")


def enrolled_months(spans: DataFrame, years, key_cols=("patient_id",), min_months: int = 11, allowed_gaps: int = 0) -> DataFrame:
    """Continuous enrollment per member and measurement year, for the ``years`` asked.

    A span without an end is open. Spans are cut to each year they meet (a row
    per asked year, whatever the span's length), reduced to one span per start
    day (so a member-year has at most 366 rows), merged into islands
    (gaps-and-islands: a span starting after the running maximum end + 1 day
    opens a new island), and the full calendar months inside each island are
    counted. Enrolled: at least ``min_months`` of them, in at most
    ``allowed_gaps`` + 1 islands.
    Output: key_cols, measurement_year, island_count, covered_days,
    covered_months, is_enrolled.
    """
    keys = list(key_cols)
    s = spans.withColumn("span_end", F.coalesce(F.col("span_end"), F.lit("9999-12-31").cast("date")))
    s = s.filter(F.col("span_start").isNotNull() & (F.col("span_end") >= F.col("span_start")))
    asked = F.array(*[F.lit(int(y)) for y in sorted(set(years))]).cast("array<int>")
    met = F.filter(asked, lambda y: (y >= F.year("span_start")) & (y <= F.year("span_end")))
    s = s.withColumn("measurement_year", F.explode(met))
    y = F.col("measurement_year")
    s = s.select(
        *keys,
        y.cast("int").alias("measurement_year"),
        F.greatest(F.col("span_start"), F.make_date(y, F.lit(1), F.lit(1))).alias("s"),
        F.least(F.col("span_end"), F.make_date(y, F.lit(12), F.lit(31))).alias("e"),
    )
    s = s.groupBy(*keys, "measurement_year", "s").agg(F.max("e").alias("e"))
    part = keys + ["measurement_year"]
    w = Window.partitionBy(*part).orderBy("s")
    prev_end = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = s.withColumn("_new", F.when(prev_end.isNull() | (F.col("s") > F.date_add(prev_end, 1)), 1).otherwise(0))
    s = s.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    isl = s.groupBy(*part, "_island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    first_full = F.when(F.dayofmonth("s") == 1, F.col("s")).otherwise(F.add_months(F.trunc("s", "month"), 1))
    last_full = F.when(F.col("e") == F.last_day("e"), F.col("e")).otherwise(F.date_sub(F.trunc("e", "month"), 1))
    months = (F.year(last_full) * 12 + F.month(last_full)) - (F.year(first_full) * 12 + F.month(first_full)) + 1
    isl = isl.withColumn("_months", F.greatest(months, F.lit(0))).withColumn("_days", F.datediff("e", "s") + 1)
    out = isl.groupBy(*part).agg(
        F.count(F.lit(1)).cast("bigint").alias("island_count"),
        F.sum("_days").cast("bigint").alias("covered_days"),
        F.sum("_months").cast("bigint").alias("covered_months"),
    )
    return out.withColumn("is_enrolled", (F.col("covered_months") >= min_months) & (F.col("island_count") <= allowed_gaps + 1))


def with_event(df: DataFrame, events: DataFrame, keys=("patient_id",)) -> DataFrame:
    """A qualifying event exists (semi join; e.g. keys patient + year)."""
    return df.join(events.select(*keys), list(keys), "left_semi")


def with_association(df: DataFrame, associations: DataFrame, key: str) -> DataFrame:
    """A valid provider or plan association exists."""
    return df.join(associations.select(key).distinct(), key, "left_semi")


def reason_priority(col: str = "reason", priority=EXCLUSION_PRIORITY):
    """Position of a reason in the priority list (unknown reasons last)."""
    rank = None
    for i, r in enumerate(priority):
        rank = F.when(F.col(col) == r, i) if rank is None else rank.when(F.col(col) == r, i)
    return rank.otherwise(len(priority))


def duplicate_members(members: DataFrame, identity: list[str]) -> DataFrame:
    """Members that share their whole identity with one of a smaller id, as
    invalid rows (patient_id, no measure, reason ``duplicate``). A null in the
    identity matches nothing."""
    known = members.select("patient_id", *identity).dropna(subset=identity)
    first = known.groupBy(*identity).agg(F.min("patient_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    twice = known.join(first, identity, "inner").filter(F.col("patient_id") > F.col("_first"))
    return twice.select("patient_id", F.lit(None).cast("string").alias("measure_code"), F.lit("duplicate").alias("reason"))


def flag_exclusions(units: DataFrame, invalid: DataFrame) -> DataFrame:
    """First exclusion reason per unit, and ``is_excluded``.

    ``invalid`` rows with a null measure apply to every measure of the member,
    the others to their own measure only. Units (one row each) meet the rows of
    their member once; the first reason by priority is a min over a struct, so
    neither kind of row is aggregated before it is known to matter.
    """
    i = invalid.select(F.col("patient_id").alias("_i_patient"), F.col("measure_code").alias("_i_measure"), F.col("reason").alias("_i_reason"))
    hit = (F.col("patient_id") == F.col("_i_patient")) & (F.col("_i_measure").isNull() | (F.col("_i_measure") == F.col("measure_code")))
    j = units.join(i, hit, "left")
    best = F.min(F.when(F.col("_i_reason").isNotNull(), F.struct(reason_priority("_i_reason").alias("p"), F.col("_i_reason").alias("r"))))
    out = j.groupBy(*units.columns).agg(best.alias("_best"))
    return out.select(*units.columns, F.col("_best.r").alias("exclusion_reason"), F.col("_best").isNotNull().alias("is_excluded"))


def exclude(df: DataFrame, invalid: DataFrame) -> DataFrame:
    """Drop invalid units (the anti-join form)."""
    return flag_exclusions(df, invalid).filter(~F.col("is_excluded")).drop("exclusion_reason", "is_excluded")
